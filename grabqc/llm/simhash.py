"""SimHash near-duplicates: fingerprints linked through BK-trees.

A fingerprint has one bit for each of the 64 bits of its shingles' hashes. Two fingerprints are
linked when they differ in at most ``radius`` bits, and groups are the connected components.

Equal fingerprints meet by aggregation before anything else, so exact copies cost one row each.
Distinct fingerprints are cut into ``radius + 2`` blocks; of two linked ones at least two blocks
agree, so they share a shard keyed by two blocks. Each shard becomes one BK-tree, and only edges
within the radius of a node's distance are followed. A shard with more than ``tree_limit``
fingerprints is cut again by the bits it does not fix. With a radius of 2 such a shard fixes 48
bits and so holds at most 65,536 distinct fingerprints, whatever the input: the bound of a tree.
A tree meets its queries by a shuffle on the shard and not by a broadcast, because all trees
together grow with the corpus.

Nulls: a null text is an empty text, with fingerprint zero. A row with a null id gets its
fingerprint and its group's id, but does not lend an id to the group. Repeated rows are kept.
An empty table gives an empty result.
"""

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grabqc.llm.common import free_name, keep, utf8

SEED = 42


def fingerprint(text, shingle):
    """Fingerprint of a text as an unsigned integer; zero for a text without words."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        starts = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    total = np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 4096):
        bits = np.unpackbits(values[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += np.add.reduce(bits, axis=0, dtype=np.uint16)
    set_bits = np.packbits(2 * total > len(values), bitorder="little")
    return int(set_bits.view("<u8")[0])


def with_fingerprints(docs, text_col, name, shingle):
    """All columns of ``docs`` and, last, the fingerprint as a signed long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType(), False)])
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def tree_links(values, radius):
    """Spanning links (value, root) of the groups that a BK-tree of distinct values shows."""
    children = [{}]
    group = [0]

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for new in range(1, len(values)):
        value = values[new]
        todo, near = [0], []
        while todo:
            node = todo.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                near.append(node)
            edges = children[node]
            for edge in range(max(distance - radius, 0), distance + radius + 1):
                if edge in edges:
                    todo.append(edges[edge])
        node = 0
        while True:
            distance = (values[node] ^ value).bit_count()
            following = children[node].get(distance)
            if following is None:
                children[node][distance] = new
                break
            node = following
        children.append({})
        group.append(new)
        for other in near:
            a, b = root(other), root(new)
            group[max(a, b)] = min(a, b)
    return [(values[i], values[root(i)]) for i in range(len(values)) if root(i) != i]


def _blocks(width, parts):
    """(shift, width) of ``parts`` runs that make up ``width`` bits."""
    cuts = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(column, runs):
    """The given runs of bits of a long, joined into one long."""
    out = F.lit(0).cast("long")
    for shift, width in runs:
        out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << width) - 1)))
    return out


def _shards(prints, radius, tree_limit):
    """(shard, fp): each linked pair shares a shard, and no shard is without a bound."""
    runs = _blocks(64, radius + 2)
    pairs = list(combinations(range(radius + 2), 2))
    first = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pair"), _bits(F.col("fp"), [runs[a], runs[b]]).alias("fixed")) for i, (a, b) in enumerate(pairs)])).alias("k")
    ).select("fp", "k.*")
    sizes = first.groupBy("pair", "fixed").agg(F.count("*").alias("size")).where("size > 1")
    first = first.join(sizes, ["pair", "fixed"])
    none = F.lit(-1).cast("long")
    small = first.where(F.col("size") <= tree_limit).select(F.struct("pair", "fixed", F.lit(-1).alias("pair2"), none.alias("fixed2")).alias("shard"), "fp")
    # what a crowded shard leaves open is cut once more, into as many blocks again
    second = []
    for i, (a, b) in enumerate(pairs):
        open_runs = [run for j, run in enumerate(runs) if j not in (a, b)]
        pieces = [(shift + s, w) for shift, width in open_runs for s, w in _blocks(width, 2)]
        chosen = list(combinations(range(len(pieces)), len(pieces) - radius))
        for j, choice in enumerate(chosen):
            second.append(F.when(F.col("pair") == i, F.struct(F.lit(j).alias("pair2"), _bits(F.col("fp"), [pieces[c] for c in choice]).alias("fixed2"))))
    crowded = (first.where(F.col("size") > tree_limit)
               .select("pair", "fixed", "fp", F.explode(F.filter(F.array(*second), lambda s: s.isNotNull())).alias("k"))
               .select(F.struct("pair", "fixed", "k.pair2", "k.fixed2").alias("shard"), "fp"))
    return small.unionByName(crowded)


def links(prints, radius, tree_limit=4096):
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` of each other."""
    if radius == 0:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    shards = _shards(prints, radius, tree_limit)
    schema = "a long, b long"

    def run(batches):
        mask = (1 << 64) - 1
        current, members = None, []

        def done():
            found = tree_links(members, radius) if len(members) > 1 else []
            return np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)

        for batch in batches:
            out = []
            keys = zip(*[batch.column(i).to_pylist() for i in range(4)])
            for key, value in zip(keys, batch.column(4).to_pylist()):
                if key != current:
                    out.append(done())
                    current, members = key, []
                members.append(value & mask)
            rows = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"])
        rows = done()
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"])

    keys = ["shard.pair", "shard.fixed", "shard.pair2", "shard.fixed2"]
    flat = shards.select(*[F.col(k).alias(k[6:]) for k in keys], "fp")
    names = [k[6:] for k in keys]
    return flat.repartition(*names).sortWithinPartitions(*names, "fp").mapInArrow(run, schema)


def connected(edges):
    """Star edges (a, b): each node that is not the smallest of its component, and that smallest.

    Alternates between tying larger neighbours and smaller neighbours to a node's smallest
    neighbour. Every step is a join and a grouping on one node, so a node with many links is
    aggregated in parts; each round is written, so the plan does not grow.
    """
    def state(df):
        row = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    stars = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = state(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = keep(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        stars = keep(small, "small-star")
        now = state(stars)
        if now == seen:
            break
        seen = now
    return stars


def near_duplicates(docs, id_col="doc_id", text_col="text", shingle=3, radius=2, tree_limit=4096):
    """Each row's id, fingerprint as 16 hex digits and component_id, the smallest id of its group."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = keep(with_fingerprints(rows, "text", "fp", shingle).drop("text"), "fingerprints")
    return _grouped(rows, radius, tree_limit).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(rows, radius, tree_limit):
    prints = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    stars = connected(links(prints.select("fp"), radius, tree_limit))
    labelled = prints.join(stars.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(labelled.join(ids, "root").select("fp", "component_id"), "fp")


def drop_near_duplicates(docs, id_col="doc_id", text_col="text", shingle=3, radius=2, tree_limit=4096):
    """The rows of ``docs`` without all but one of each group: the row with the smallest id.

    Rows that share that id, or have none, are told apart by their place in a written copy. Null and
    empty texts have fingerprint zero and count as copies of each other. Columns stay as they are.
    """
    place, print_ = free_name(docs.columns, "near_dup_row"), free_name(docs.columns, "near_dup_print")
    marked = docs.withColumn(place, F.monotonically_increasing_id())
    marked = keep(with_fingerprints(marked, text_col, print_, shingle), "fingerprinted")
    rows = marked.select(F.col(place).alias("row"), F.col(id_col).alias("doc_id"), F.col(print_).alias("fp"))
    prints = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"))
    prints = keep(prints, "distinct-fingerprints")
    stars = connected(links(prints.select("fp"), radius, tree_limit))
    labelled = prints.join(stars.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        F.coalesce("root", "fp").alias("root"), "least")
    kept = labelled.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias(place))
    return marked.join(kept, place, "left_semi").select(*docs.columns)
