"""Vector codes by parts, with codebooks fitted and applied along tries of the distinct parts.

Vectors of whole numbers are cut into equal parts; the parts at each place have a codebook of their own.
Vectors stand in blocks, written once: for each place the block's distinct parts in lexicographic
order, which is a trie, how often each occurs, and which one each vector has. A trie is walked
depth first. A node holds the distances of its prefix to the prefixes of all entries, so parts that begin
alike share them; its children add one dimension each. At a leaf the entry with the least distance is the
code of the part, and the part counts for that entry as often as it occurs. Under a node with at
most ``SUBTREE`` leaves the levels are taken at once, as arrays; what is held at a time is bounded
by that and the depth. Copies of a vector are one leaf, however many a block holds.

A round reads the blocks and adds up one array for each task; entries, places and components bound what
comes to the driver. No part is shuffled. The same codebooks follow from any cut into blocks, as all
sums are of whole numbers.

Nulls: a vector that is null, empty, or holds a null or non-finite component takes no part. Vectors
must be of one length, a multiple of the number of parts: the length that most have, the smaller in a tie;
others take no part, nor do those with a component beyond ``LARGEST`` after scaling. A row with a
null id is coded, but starts no entry. Rows that share an id are vectors of their own; among the first
entries they stand by their components. Ties go to the smaller entry. With fewer vectors than entries there are
fewer entries; an empty table gives an empty result. Other columns are not read.
"""

from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from grabqc.llm.common import keep, narrow, whole_vectors

LARGEST = 1 << 27
SUBTREE = 4096

#: ``coded``: vec_id, label, code, error. ``codebooks``: whole numbers by place, entry and component.
Coding = namedtuple("Coding", "coded codebooks")

BLOCK = "ids array<long>, labels array<{}>, kind string, sizes binary, parts binary, counts binary, which binary"


def trie(parts):
    """Distinct parts in lexicographic order, how often each occurs, and which one each row has."""
    order = np.lexsort(parts.T[::-1])
    rows = parts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    which = np.empty(len(rows), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return rows[first], np.diff(np.append(first, len(rows))), which


def walk(leaves, entries, most=SUBTREE):
    """(entry, distance) of the nearest entry of each leaf; leaves are distinct and in order."""
    count, depth = leaves.shape
    code, error = np.zeros(count, np.int64), np.zeros(count, np.int64)
    # new[d]: where a prefix of d + 1 dimensions differs from that of the leaf before
    new = np.ones((depth, count), bool)
    new[:, 1:] = np.logical_or.accumulate((leaves[1:] != leaves[:-1]).T, axis=0)
    todo = [(0, count, 0, np.zeros(len(entries), np.int64))] if count else []
    while todo:
        start, end, level, shared = todo.pop()
        if level < depth and end - start > most:
            cuts = start + np.append(np.flatnonzero(new[level, start:end]), end - start)
            cuts[0] = start
            for a, b in zip(cuts[-2::-1].tolist(), cuts[:0:-1].tolist()):  # the first child is walked first
                todo.append((a, b, level + 1, shared + (leaves[a, level] - entries[:, level]) ** 2))
            continue
        distances, above = shared[None], np.zeros(end - start, np.int64)
        for d in range(level, depth):
            begins = new[d, start:end].copy()
            begins[0] = True
            at = np.flatnonzero(begins)
            distances = distances[above[at]] + (leaves[start + at, d][:, None] - entries[:, d]) ** 2
            above = np.cumsum(begins) - 1
        nearest = distances.argmin(axis=1)
        code[start:end] = nearest[above]
        error[start:end] = distances[np.arange(len(nearest)), nearest][above]
    return code, error


def weigh(leaves, counts, code, entries):
    """Sums of the components of each entry's parts, and how many there are."""
    out = np.zeros((entries, leaves.shape[1] + 1), np.int64)
    order = np.argsort(code, kind="stable")
    met, first = np.unique(code[order], return_index=True)
    if len(met):
        out[met, :-1] = np.add.reduceat((leaves * counts[:, None])[order], first, axis=0)
        out[met, -1] = np.add.reduceat(counts[order], first)
    return out


def _tries(row, parts, width):
    """(leaves, counts, which) at each place of a block."""
    sizes = np.frombuffer(row["sizes"], np.int64)
    leaves = np.frombuffer(row["parts"], row["kind"]).reshape(-1, width)
    counts = np.frombuffer(row["counts"], np.uint32)
    which = np.frombuffer(row["which"], np.uint32).reshape(parts, -1)
    ends = np.cumsum(sizes)
    for place, (start, end) in enumerate(zip(ends - sizes, ends)):
        yield leaves[start:end].astype(np.int64), counts[start:end].astype(np.int64), which[place]


def _hexadecimal(codes):
    """One text for each row of codes, two digits for each."""
    digits = np.array([f"{i:02x}".encode() for i in range(256)], "S2")
    text = np.ascontiguousarray(digits[codes])
    size = 2 * codes.shape[1]
    return pa.Array.from_buffers(pa.string(), len(codes), [None, pa.py_buffer((np.arange(len(codes) + 1) * size).astype(np.int32)), pa.py_buffer(text)])


def encode(vectors, id_col="vec_id", vector_col="embedding", label_col="label", parts=16, entries=64, rounds=2, scale=256, block_rows=16384):
    """``Coding`` of the vectors' components times ``scale``, rounded down.

    The codebooks start from the vectors with the smallest ids. ``entries`` may be 256 at most.
    """
    if not 0 < entries <= 256 or parts < 1:
        raise ValueError("entries must be 1 to 256, parts at least 1")
    spark = vectors.sparkSession
    label = F.col(label_col)
    kind = vectors.select(label).schema[0].dataType
    empty = f"vec_id long, label {kind.simpleString()}, code string, error long"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), label.alias("label"))
    ok = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * scale >= LARGEST))
    fit = rows.where(F.col("vector").isNotNull() & ok & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    length = fit.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    if length is None:
        return Coding(spark.createDataFrame([], empty), np.zeros((parts, 0, 0), np.int64))
    dims = length["n"]
    width = dims // parts
    first = (fit.where((F.size("vector") == dims) & F.col("vec_id").isNotNull()).select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("whole"))
             .orderBy("vec_id", "whole").limit(entries).collect())
    if not first:  # all ids are null: nothing to start from
        return Coding(spark.createDataFrame([], empty), np.zeros((parts, 0, width), np.int64))
    books = np.array([r["whole"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    entries = len(first)

    def pack(batches):
        """Blocks of about ``block_rows`` vectors as tries."""
        def row(chunks):
            whole = np.concatenate([c[1] for c in chunks]).reshape(-1, parts, width)
            made = [trie(whole[:, p]) for p in range(parts)]
            kind, leaves = narrow(np.concatenate([m[0] for m in made]))
            labels = pa.concat_arrays([c[2] for c in chunks])
            listed = pa.ListArray.from_arrays(pa.array([0, len(labels)], pa.int32()), labels)
            values = [pa.array([sum((c[0] for c in chunks), [])], pa.list_(pa.int64())), listed, pa.array([kind])]
            blobs = (np.array([len(m[0]) for m in made], np.int64), leaves, np.concatenate([m[1] for m in made]).astype(np.uint32), np.concatenate([m[2] for m in made]).astype(np.uint32))
            return pa.RecordBatch.from_arrays(values + [pa.array([b.tobytes()], pa.binary()) for b in blobs], names=["ids", "labels", "kind", "sizes", "parts", "counts", "which"])

        chunks, size = [], 0
        for batch in batches:
            own, whole, kept = whole_vectors(batch, dims, scale, LARGEST, ["label"])
            for start in range(0, len(whole), block_rows):
                end = min(start + block_rows, len(whole))
                chunks.append((own[start:end], whole[start:end], kept[0].slice(start, end - start)))
                size += end - start
                if size >= block_rows:
                    yield row(chunks)
                    chunks, size = [], 0
        if size:
            yield row(chunks)

    blocks = keep(rows.mapInArrow(pack, BLOCK.format(kind.simpleString())), "tries")

    def fitted(books):
        def run(batches):
            total = np.zeros((parts, entries, width + 1), np.int64)
            for batch in batches:
                for r in batch.to_pylist():
                    for place, (leaves, counts, _) in enumerate(_tries(r, parts, width)):
                        total[place] += weigh(leaves, counts, walk(leaves, books[place])[0], entries)
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], names=["sums"])
        return run

    for _ in range(rounds):
        sums = blocks.select("kind", "sizes", "parts", "counts", "which").mapInArrow(fitted(books), "sums array<long>")
        sums = sums.select(F.posexplode("sums").alias("place", "part")).groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        totals = np.zeros(parts * entries * (width + 1), object)
        for r in sums.collect():
            totals[r["place"]] = int(r["total"])
        totals = totals.reshape(parts, entries, width + 1)
        moved = books.copy()
        for p in range(parts):
            for e in range(entries):
                if totals[p, e, -1]:
                    moved[p, e] = [v // totals[p, e, -1] for v in totals[p, e, :-1]]
        books = moved

    def final(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1)
                row = r.select(["kind", "sizes", "parts", "counts", "which"]).to_pylist()[0]
                codes, error = [], 0
                for place, (leaves, _, which) in enumerate(_tries(row, parts, width)):
                    code, far = walk(leaves, books[place])
                    codes.append(code[which].astype(np.uint8))
                    error = error + far[which]
                yield pa.RecordBatch.from_arrays([r.column("ids").flatten(), r.column("labels").flatten(), _hexadecimal(np.stack(codes, axis=1)), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    return Coding(blocks.mapInArrow(final, empty), books)


def report(coding):
    """Each vector with its code and error, the errors of its label together, and the codebooks' digest.

    Errors of a label that do not fit a long together are null. Labels are joined as rows, not
    broadcast by order: there may be many. Equal labels are added up before they are shuffled.
    """
    coded = keep(coding.coded, "coded")
    text = ",".join(map(str, coding.codebooks.ravel().tolist()))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of")
            .select("vec_id", "code", "error", "label_error", F.sha2(F.lit(text), 256).alias("codebooks_sha256")))
