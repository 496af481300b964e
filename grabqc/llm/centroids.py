"""Centroid clustering in whole numbers, with bounds that are loosened by the norm of the sum.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound of the
distance to each other, with the round in which each was last evaluated. The history of the centroids
is kept, so a bound is loosened by the norm of the total displacement since that round, which is
never more than the sum of the drifts of the rounds between. Where the loosened bounds cannot
rule a centroid out, the distance is taken again exactly, and only there.

Vectors stand in blocks of ``block_rows``. One pass over the blocks of a round writes those of the
next, with the sums of each block beside them; only these sums, one for each cluster and component,
are added up and brought to the driver. No vector is shuffled.

Nulls: a vector that is null, of another length, or holds a null or non-finite component takes no
part, nor does one with a component beyond ``LARGEST`` after scaling, as distances would not fit a
long. A row with a null id is clustered, but starts no centroid. Rows that share an id are vectors
of their own; in the choice of the first centroids they stand by their components. Ties in distance go to
the smaller number. With fewer vectors than ``k`` there are fewer centroids; an empty table gives
empty results. Other columns are not read.
"""

from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from grabqc.llm.common import keep, narrow, whole_vectors

LARGEST = 1 << 27
SLACK = 1e-9

#: ``assigned``: vec_id, cluster, distance. ``centroids``: one tuple of components for each.
#: ``scanned``: exact distances taken in each round, the last assignment included.
Clustering = namedtuple("Clustering", "assigned centroids scanned")

STATE = "ids array<long>, kind string, data binary, cluster binary, upper binary, upper_at binary, lower binary, lower_at binary, distance array<long>, sums array<long>"
FIELDS = pa.schema([("ids", pa.list_(pa.int64())), ("kind", pa.string()), ("data", pa.binary()), ("cluster", pa.binary()), ("upper", pa.binary()), ("upper_at", pa.binary()),
                    ("lower", pa.binary()), ("lower_at", pa.binary()), ("distance", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64()))])


def squares(vectors, centroid):
    """Exact squared distances of whole vectors to one centroid."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def _up(squared):
    return np.nextafter(np.sqrt(squared.astype(np.float64)).astype(np.float32), np.float32(np.inf))


def _down(squared):
    return np.nextafter(np.sqrt(squared.astype(np.float64)).astype(np.float32), np.float32(-np.inf))


class Bounds:
    """Cluster and bounds of the vectors of a block; ``scanned`` counts the exact distances taken."""

    def __init__(self, vectors, cluster, upper, upper_at, lower, lower_at):
        self.vectors, self.cluster, self.upper, self.upper_at, self.lower, self.lower_at = vectors, cluster, upper, upper_at, lower, lower_at
        self.scanned = 0

    @classmethod
    def first(cls, vectors, centroids):
        """Every distance, in round 0."""
        every = np.stack([squares(vectors, c) for c in centroids], axis=1)
        cluster = every.argmin(axis=1)
        own = every[np.arange(len(vectors)), cluster]
        out = cls(vectors, cluster, _up(own), np.zeros(len(vectors), np.uint8), _down(every), np.zeros(every.shape, np.uint8))
        out.scanned = every.size
        return out

    def move(self, history):
        """Assign to the last centroids of the history."""
        now, k = len(history) - 1, len(history[0])
        moved = np.sqrt(((history[-1] - history).astype(np.float64) ** 2).sum(2)) * (1 + SLACK)
        line = np.arange(len(self.vectors))
        upper = self.upper.astype(np.float64) + moved[self.upper_at, self.cluster]
        lower = self.lower.astype(np.float64) - moved[self.lower_at, np.arange(k)]
        lower[line, self.cluster] = np.inf
        rows = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        # the distance to the own centroid, taken anew, may be enough
        before = self.cluster[rows]
        own = squares(self.vectors[rows], history[-1][before])
        self.upper[rows], self.upper_at[rows] = _up(own), now
        failed = lower[rows] <= self.upper[rows].astype(np.float64)[:, None]
        self.scanned = len(rows) + int(failed.sum())
        best, nearest = own.copy(), before.copy()
        for j in range(k):
            at = np.flatnonzero(failed[:, j])
            if len(at):
                found = squares(self.vectors[rows[at]], history[-1][j])
                self.lower[rows[at], j], self.lower_at[rows[at], j] = _down(found), now
                nearer = (found < best[at]) | ((found == best[at]) & (j < nearest[at]))
                best[at[nearer]], nearest[at[nearer]] = found[nearer], j
        left = np.flatnonzero(nearest != before)
        self.lower[rows[left], before[left]], self.lower_at[rows[left], before[left]] = _down(own[left]), now
        self.cluster[rows[left]] = nearest[left]
        self.upper[rows[left]] = _up(best[left])

    def sums(self, k):
        """Sums of the components of each cluster, their counts, and the distances taken."""
        out = np.zeros((k, self.vectors.shape[1] + 1), np.int64)
        order = np.argsort(self.cluster, kind="stable")
        counts = np.bincount(self.cluster, minlength=k)
        filled = np.flatnonzero(counts)
        first = (np.cumsum(counts) - counts)[filled]
        if len(filled):
            out[filled, :-1] = np.add.reduceat(self.vectors[order], first, axis=0)
        out[:, -1] = counts
        return np.append(out.ravel(), self.scanned)


def _row(ids, bounds, k, centroids=None):
    vectors = bounds.vectors
    distance = squares(vectors, centroids[bounds.cluster]).tolist() if centroids is not None else []
    kind, data = narrow(vectors)
    blobs = (data, bounds.cluster.astype(np.uint16), bounds.upper, bounds.upper_at, bounds.lower, bounds.lower_at)
    values = [ids, kind, *[b.tobytes() for b in blobs], distance, bounds.sums(k).tolist()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, FIELDS)], schema=FIELDS)


def _read(batch, k, dims):
    """(ids, bounds) of each block of a batch."""
    for r in batch.to_pylist():
        vectors = np.frombuffer(r["data"], r["kind"]).reshape(-1, dims).astype(np.int64)
        yield r["ids"], Bounds(vectors, np.frombuffer(r["cluster"], np.uint16).astype(np.int64), np.frombuffer(r["upper"], np.float32).copy(), np.frombuffer(r["upper_at"], np.uint8).copy(),
                               np.frombuffer(r["lower"], np.float32).reshape(-1, k).copy(), np.frombuffer(r["lower_at"], np.uint8).reshape(-1, k).copy())


def starts(rows, k, dims, scale, seed):
    """The ``k`` vectors with the smallest digests of their ids, as whole numbers.

    ``k`` rows come to the driver, by a top-k that each task takes of its own rows first.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    ok = (F.size("vector") == dims) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * scale >= LARGEST))
    first = (rows.where(F.col("vec_id").isNotNull() & ok).select(digest.alias("digest"), F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("whole"))
             .orderBy("digest", "whole").limit(k).collect())
    return np.array([r["whole"] for r in first], np.int64).reshape(len(first), dims)


def cluster(vectors, id_col="vec_id", vector_col="embedding", dims=64, scale=64, k=16, rounds=3, seed="1", block_rows=8192):
    """``Clustering`` of the vectors' components times ``scale``, rounded down.

    The history of the centroids, ``k * dims * (rounds + 1)`` numbers, goes to the tasks with the code.
    """
    if not 0 < rounds < 250 or not 0 < k < 1 << 16:
        raise ValueError("rounds must be under 250, k under 65,536")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    centroids = starts(rows, k, dims, scale, seed)
    if not len(centroids):
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [])
    k = len(centroids)
    history = centroids[None]

    def begin(batches):
        ids, parts, size = [], [], 0
        for batch in batches:
            own, whole = whole_vectors(batch, dims, scale, LARGEST)
            for start in range(0, len(whole), block_rows):
                ids += own[start:start + block_rows]
                parts.append(whole[start:start + block_rows])
                size += len(parts[-1])
                if size >= block_rows:
                    yield _row(ids, Bounds.first(np.concatenate(parts), centroids), k)
                    ids, parts, size = [], [], 0
        if size:
            yield _row(ids, Bounds.first(np.concatenate(parts), centroids), k)

    def again(history, last):
        def run(batches):
            for batch in batches:
                for ids, bounds in _read(batch, k, dims):
                    bounds.move(history)
                    yield _row(ids, bounds, k, history[-1] if last else None)
        return run

    state, scanned = keep(rows.mapInArrow(begin, STATE), "assigned-0"), []
    for number in range(1, rounds + 1):
        places = state.select(F.posexplode("sums").alias("place", "part")).groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        totals = {r["place"]: int(r["total"]) for r in places.collect()}
        scanned.append(totals[k * (dims + 1)])
        moved = history[-1].copy()
        for j in range(k):
            count = totals[j * (dims + 1) + dims]
            if count:
                moved[j] = [totals[j * (dims + 1) + d] // count for d in range(dims)]
        history = np.concatenate([history, moved[None]])
        picked = state.select("ids", "kind", "data", "cluster", "upper", "upper_at", "lower", "lower_at")
        state = keep(picked.mapInArrow(again(history, number == rounds), STATE), f"assigned-{number}")
    scanned.append(state.agg(F.sum(F.element_at("sums", -1))).first()[0])

    def lines(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(np.frombuffer(r["cluster"], np.uint16).astype(np.int32)), pa.array(r["distance"], pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    assigned = state.select("ids", "cluster", "distance").mapInArrow(lines, "vec_id long, cluster int, distance long")
    return Clustering(assigned, [tuple(c) for c in history[-1].tolist()], scanned)


def report(clustering):
    """Each vector with its distance, the inertia of its cluster and of all, and its centroid's digest.

    An inertia that does not fit a long is null. One row for each cluster is joined to the vectors.
    """
    assigned = clustering.assigned
    spark = assigned.sparkSession
    if not clustering.centroids:
        return assigned.select("*", *[F.lit(None).cast(t).alias(n) for n, t in (("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def fits(total):
        return total if total < 1 << 63 else None

    known = spark.createDataFrame([(i, fits(inertia.get(i, 0)), fits(sum(inertia.values())), ",".join(map(str, c))) for i, c in enumerate(clustering.centroids)],
                                  "cluster int, cluster_inertia long, inertia long, text string")
    known = known.select("cluster", "cluster_inertia", "inertia", F.sha2("text", 256).alias("centroid_sha256"))
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
