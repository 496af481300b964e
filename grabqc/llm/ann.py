"""Nearest neighbours by cosine, through vantage-point trees.

Vectors are taken at unit length, where the straight distance orders as the cosine does. Each belongs to the
nearest of up to ``pivots`` pivots, a sample bounded by that number; the rows of a pivot are dealt into
shards of about ``shard_rows``, and each shard becomes one tree. A node splits its rows at the median
distance to a vantage point. A search leaves out what the triangle inequality puts farther than
``factor`` times the distance of the query's k-th nearest so far; with a factor of one nothing nearer
is ever left out, with less more is, at some recall.

Queries stand in blocks of about ``query_rows``. Each first searches one shard of its own pivot. The distance of
the k-th nearest found there is carried along, and the shards of all pivots whose rows can lie within
it are searched next; those of the others never meet the query. The k best are ranked in the end. Scores are
computed from the original vectors.

Nulls: rows with a null id, and vectors that are null, empty, zero or hold null or non-finite
components, take no part. Only vectors of equal length are compared. Rows that share an id are rows
each: every one asks, and every one may be found. Ties go to the smaller id. Empty tables give no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.llm.common import keep

SLACK = 1e-9  # of cosines, for rounding
NEAR = 1e-6  # of distances: the root of what rounding leaves of a cosine of one


def usable(vector):
    """The vector as doubles, or None if it takes no part."""
    if vector is None or not len(vector) or any(v is None for v in vector):
        return None
    out = np.array(vector, dtype=np.float64)
    with np.errstate(over="ignore"):
        norm = np.sqrt((out * out).sum())
    return out if np.isfinite(out).all() and np.isfinite(norm) and norm > 0 else None


def measure(a, b):
    """Cosines of the rows of a with the rows of b, one for one. Equal rows give equal results."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def to_unit(vectors):
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def distance(a, b):
    """Distances of the rows of a to those of b, all of unit length."""
    return radius(a @ b.T)


def radius(cosine):
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


class Tree:
    """Vantage-point tree as flat arrays: rows, their ids and vectors in tree order, and one line for each node.

    A node holds rows start to end; its vantage point is row ``start``, its near side the rows up to
    ``split``. ``bounds`` has the least and greatest distance of either side to the vantage point.
    """

    def __init__(self, rows, ids, vectors, nodes, bounds):
        self.rows, self.ids, self.vectors, self.nodes, self.bounds = rows, ids, vectors, nodes, bounds
        self.unit = to_unit(vectors)

    @classmethod
    def build(cls, rows, ids, vectors, leaf=256):
        unit = to_unit(vectors)
        order, nodes, bounds = np.arange(len(ids)), [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            number = len(nodes)
            if parent >= 0:
                nodes[parent][3 + side] = number
            nodes.append([start, end, -1, -1, -1])
            bounds.append([0.0] * 4)
            if end - start <= leaf:
                continue
            own = order[start:end]
            far = distance(unit[own], unit[own[:1]])[:, 0].argmax()  # a point at the edge
            own[[0, far]] = own[[far, 0]]
            away = distance(unit[own[1:]], unit[own[:1]])[:, 0]
            sort = np.argsort(away, kind="stable")
            order[start:end] = np.concatenate([own[:1], own[1:][sort]])
            away = away[sort]
            half = len(away) // 2
            nodes[number][2] = start + 1 + half
            bounds[number] = [away[0], away[half - 1], away[half], away[-1]]
            todo += [(start + 1 + half, end, number, 1), (start + 1, start + 1 + half, number, 0)]
        return cls(rows[order], ids[order], vectors[order], np.array(nodes, np.int64).reshape(-1, 5), np.array(bounds).reshape(-1, 4))

    def blob(self):
        head = np.array([len(self.ids), self.vectors.shape[1], len(self.nodes)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.rows, self.ids, self.vectors, self.nodes, self.bounds))

    @classmethod
    def read(cls, blob):
        rows, width, nodes = np.frombuffer(blob, np.int64, 3).tolist()
        at, out = 24, []
        for kind, shape in ((np.int64, (rows,)), (np.int64, (rows,)), (np.float64, (rows, width)), (np.int64, (nodes, 5)), (np.float64, (nodes, 4))):
            n = int(np.prod(shape))
            out.append(np.frombuffer(blob, kind, n, at).reshape(shape))
            at += 8 * n
        return cls(*out)

    def search(self, rows, vectors, k, factor, floor=None):
        """(ids, scores) of the k nearest of each query, nearest first; -inf where there are fewer.

        A query's own row is not found. ``floor`` has, for each query, a cosine that k rows elsewhere reach.
        """
        unit = to_unit(vectors)
        best_id = np.full((len(rows), k), -1)
        best = np.full((len(rows), k), -np.inf)
        floor = np.full(len(rows), -np.inf) if floor is None else floor

        def offer(own, start, end):
            """Hold rows start to end of the tree against the queries."""
            near = unit[own] @ self.unit[start:end].T
            near[rows[own][:, None] == self.rows[start:end]] = -np.inf
            q, r = np.nonzero(near >= np.maximum(best[own, -1], floor[own])[:, None] - SLACK)
            score = np.full(near.shape, -np.inf)
            score[q, r] = measure(vectors[own[q]], self.vectors[start + r])
            score[near == -np.inf] = -np.inf
            touched = np.unique(q)
            if not len(touched):
                return
            lines = own[touched]
            scores = np.concatenate([best[lines], score[touched]], axis=1)
            names = np.concatenate([best_id[lines], np.where(score[touched] > -np.inf, self.ids[start:end], -1)], axis=1)
            first = np.lexsort((names, -scores), axis=1)[:, :k]
            best[lines], best_id[lines] = np.take_along_axis(scores, first, 1), np.take_along_axis(names, first, 1)

        todo = [(0, np.arange(len(rows)), None, None)] if len(self.nodes) else []
        while todo:
            node, own, low, high = todo.pop()
            if low is not None:  # what has been found since may rule this side out
                reach = factor * radius(np.maximum(best[own, -1], floor[own])) + NEAR
                own = own[(low <= reach) & (high <= reach)]
            if not len(own):
                continue
            start, end, split, near, far = self.nodes[node].tolist()
            if split < 0:
                offer(own, start, end)
                continue
            offer(own, start, start + 1)
            away = distance(unit[own], self.unit[start:start + 1])[:, 0]
            a, b, c, d = self.bounds[node]
            sides = [(near, a - away, away - b), (far, c - away, away - d)]
            if np.count_nonzero(away <= (b + c) / 2) * 2 > len(own):  # the side of most queries is searched first
                sides.reverse()
            todo += [(child, own, low, high) for child, low, high in sides]
        return best_id, best


def _vectors(data, width):
    return np.frombuffer(b"".join(data), np.float64).reshape(-1, width)


class Pivots:
    """The pivots of each vector length, a bounded number in all; lengths without one have pivot -1."""

    def __init__(self, found):
        self.of = {}
        for number, (width, data) in enumerate(found):
            self.of.setdefault(width, []).append((number, data))
        self.of = {w: (np.array([n for n, _ in own]), to_unit(_vectors([d for _, d in own], w))) for w, own in self.of.items()}

    def nearest(self, widths, data):
        """The number of the nearest pivot of each vector."""
        out = np.full(len(widths), -1)
        for width, (numbers, points) in self.of.items():
            own = np.nonzero(widths == width)[0]
            for at in range(0, len(own), 1024):
                some = own[at:at + 1024]
                out[some] = numbers[(to_unit(_vectors([data[i] for i in some], width)) @ points.T).argmax(1)]
        return out


PLACED = "row long, vec_id long, width long, data binary, pivot long"
BLOCK = "width long, pivot long, part long, rows binary, ids binary, queries binary, floor binary, home binary"


def nearest(vectors, queries, id_col="vec_id", vector_col="embedding", k=5, factor=1.0, shard_rows=4096, query_rows=4096, pivots=256):
    """query_id, rank, vec_id, score of the k nearest other rows of each row that ``queries`` selects.

    ``queries`` is a condition on the column ``vec_id``.
    """
    rows, points, cells, trees = index(vectors, id_col, vector_col, shard_rows, pivots)
    best = _found(rows, points, cells, trees, queries, k, factor, query_rows)[0]
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def index(vectors, id_col="vec_id", vector_col="embedding", shard_rows=4096, pivots=256):
    """The rows that take part, their pivots, the number of shards of each pivot, and the shards' trees."""
    schema = pa.schema([("vec_id", pa.int64()), ("width", pa.int64()), ("data", pa.binary())])

    def clean(batches):
        for batch in batches:
            rows = [(i, usable(v)) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            rows = [{"vec_id": i, "width": len(v), "data": v.tobytes()} for i, v in rows if i is not None and v is not None]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).mapInArrow(clean, "vec_id long, width long, data binary")
    rows = keep(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    some = min(pivots, rows.count() // shard_rows + 1)
    points = Pivots([(r.width, bytes(r.data)) for r in rows.orderBy(F.xxhash64("row"), "row").limit(some).select("width", "data").collect()])
    placed = _place(rows, points)
    cells = keep(placed.groupBy("width", "pivot").agg(F.expr(f"count(*) div {shard_rows} + 1").alias("shards")), "cells")

    def build(table):
        width, pivot, shard = (table.column(c)[0].as_py() for c in ("width", "pivot", "shard"))
        data = _vectors(table.column("data").to_pylist(), width)
        tree = Tree.build(*(table.column(c).to_numpy() for c in ("row", "vec_id")), data)
        near = far = 0.0
        if pivot >= 0:
            numbers, all_points = points.of[width]
            away = distance(tree.unit, all_points[numbers == pivot])
            near, far = float(away.min()), float(away.max())
        return pa.table({"width": [width], "pivot": [pivot], "shard": [shard], "near": [near], "far": [far], "tree": [tree.blob()]})

    shard = F.pmod(F.xxhash64("row"), F.coalesce("shards", F.lit(1)))
    trees = (placed.join(cells, ["width", "pivot"], "left").withColumn("shard", shard).drop("shards").groupBy("width", "pivot", "shard")
             .applyInArrow(build, "width long, pivot long, shard long, near double, far double, tree binary"))
    return rows, points, cells, keep(trees, "trees")


def _place(rows, points):
    def place(batches):
        for batch in batches:
            pivot = points.nearest(batch.column(2).to_numpy(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot, pa.int64())], names=[*batch.schema.names, "pivot"])

    return rows.select("row", "vec_id", "width", "data").mapInArrow(place, PLACED)


def _found(rows, points, cells, trees, queries, k, factor, query_rows):
    """row, query_id, vec_id, score of the nearest met by each query, and the blocks of the second step (before their shards)."""
    asked = rows.where(queries)
    parts = asked.count() // query_rows + 1
    names = [field.split()[0] for field in BLOCK.split(", ")]

    def block(width, pivot, part, *arrays):
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i < 3 else pa.binary()) for i, v in enumerate(
            [width, pivot, part, *[np.ascontiguousarray(a).tobytes() for a in arrays]])], names=names)

    def opened(line):
        """Rows, ids, vectors, floors and first shards (pivot, shard) of a block's queries."""
        kinds = np.int64, np.int64, np.float64, np.float64, np.int64
        rows, ids, data, floor, home = (np.frombuffer(line[n], kind) for n, kind in zip(names[3:], kinds))
        return rows, ids, data.reshape(-1, line["width"]), floor, home.reshape(-1, 2)

    def gather(table):
        width, pivot, part, shard = (table.column(c)[0].as_py() for c in ("width", "pivot", "part", "shard"))
        rows, ids, floor = (table.column(c).to_numpy() for c in ("row", "vec_id", "floor"))
        home = np.tile(np.array([pivot, shard]), (len(rows), 1))
        return pa.Table.from_batches([block(width, pivot, part, rows, ids, _vectors(table.column("data").to_pylist(), width), floor, home)])

    def search(again):
        def run(batches):
            for batch in batches:
                for line in batch.to_pylist():
                    rows, ids, data, floor, home = opened(line)
                    own = np.nonzero((home != (line["pivot"], line["shard"])).any(1) == again)[0]
                    found, scores = Tree.read(line["tree"]).search(rows[own], data[own], k, factor, floor[own])
                    line, place = np.nonzero(scores > -np.inf)
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (rows[own[line]], ids[own[line]], found[line, place], scores[line, place])],
                                                     names=["row", "query_id", "vec_id", "score"])
        return run

    pairs = "row long, query_id long, vec_id long, score double"
    key = ["width", "pivot", "shard"]
    shard = F.pmod("part", F.coalesce("shards", F.lit(1)))
    lowest = F.lit(float("-inf"))
    asked = keep(_place(asked, points).join(cells, ["width", "pivot"], "left").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
                 .withColumn("shard", shard).drop("shards"), "queries")

    def gathered(asked):
        return asked.groupBy("width", "pivot", "part", "shard").applyInArrow(gather, BLOCK)

    first = gathered(asked.withColumn("floor", lowest))
    own = first.join(cells, ["width", "pivot"], "left").withColumn("shard", shard).drop("shards").join(trees.select(*key, "tree"), key)
    nearest_own = keep(own.select(*names, "shard", "tree").mapInArrow(search(False), pairs), "nearest-own")

    # the cosine that k rows reach, for queries that have found as many; others reach everywhere
    bound = nearest_own.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k).select("row", "floor")
    reach = {}
    for r in trees.where("pivot >= 0").groupBy("width", "pivot").agg(F.min("near"), F.max("far")).collect():  # at most one row for each pivot
        reach.setdefault(r[0], []).append(tuple(r[1:]))

    def spread(batches):
        """A block's queries once more for each pivot whose rows they can reach."""
        for batch in batches:
            for line in batch.to_pylist():
                width, part = line["width"], line["part"]
                rows, ids, data, floor, home = opened(line)
                if width not in points.of:
                    yield block(width, -1, part, rows, ids, data, floor, home)
                    continue
                numbers, all_points = points.of[width]
                away = distance(to_unit(data), all_points)
                for number, near, far in reach.get(width, ()):
                    to = away[:, np.nonzero(numbers == number)[0][0]]
                    some = np.maximum(near - to, to - far) <= factor * radius(floor) + NEAR
                    if some.any():
                        yield block(width, number, part, rows[some], ids[some], data[some], floor[some], home[some])

    def together(table):
        """The blocks of one part that go to the same pivot as one."""
        lines = table.to_pylist()
        width, pivot, part = (lines[0][c] for c in names[:3])
        return pa.Table.from_batches([block(width, pivot, part, *[np.concatenate(a) for a in zip(*map(opened, lines))])])

    again = (gathered(asked.join(bound, "row", "left").withColumn("floor", F.coalesce("floor", lowest))).mapInArrow(spread, BLOCK)
             .groupBy("width", "pivot", "part").applyInArrow(together, BLOCK))
    again = keep(again, "queries-again")
    met = (again.join(cells, ["width", "pivot"]).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).drop("shards")
           .join(trees.select(*key, "tree"), key))
    return nearest_own.unionByName(met.select(*names, "shard", "tree").mapInArrow(search(True), pairs)), again
