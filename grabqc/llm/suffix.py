"""Suffix-array dedup: bytes covered by strings that an earlier document holds too.

A byte goes if some string of ``length`` bytes that covers it also starts in a document with a
smaller id. Only suffixes that can share such a string with another document are sorted:

1. Documents are packed into blocks of bytes, written once, bucketed by block, so that what the
   blocks learn later comes to them and they do not move. Documents that equal one with a
   smaller id, told by a 128-bit digest, go whole and take no part in the rest.
2. Each block names its anchors: of every ``length`` bytes, the ``anchor``-byte string in them
   with the least hash. Equal strings of ``length`` bytes have equal anchors at equal places, so
   suffixes that share one meet under an anchor. Hashes in one document only are ruled out.
3. The surroundings of the other anchors, once per block, meet by hash range. Under each anchor
   the suffixes that begin at it, and the reversed text before it, are sorted by merging; prefix
   polynomial hashes and binary search give the common extension of two of them, so a comparison
   takes logarithmic time. The extensions of neighbours are verified byte by byte, so a collision
   of hashes does no harm. They tell which strings around the anchor are equal; each class of
   equal strings learns its smallest document.
4. Each block marks the bytes that its classes cover and cuts them out.

Anchors with more distinct surroundings than one sort should hold (``crowd``, summed over blocks)
are not met as one group, so no sort grows with the corpus: each string around them stands by itself
under its own hash, and equal ones are aggregated in their block first.

Nulls: a null text is empty. A null id counts as larger than any other and stays null; rows that
share an id, or have none, do not remove bytes from each other. Texts of any length are cut
whole; an empty table gives an empty result. Cutting is by bytes; ``drop_repeats`` leaves out a
character that lost some of its bytes.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from grabqc.llm.common import keep, utf8
from grabqc.session import scratch_path

NO_ID = np.iinfo(np.int64).max
BASE = np.uint64(0x9E3779B97F4A7C55)
CHUNK = 1 << 17


def _powers(base, n):
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(h):
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def string_hashes(data, length):
    """Mixed polynomial hash of each string of ``length`` bytes, through prefix sums."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = _powers(BASE, min(len(data), CHUNK + length)), _powers(inverse, CHUNK)
    out = []
    for start in range(0, len(data) - length + 1, CHUNK):
        part = data[start:start + CHUNK + length - 1].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)])])
        n = len(part) - length + 1
        out.append(_mix((sums[length:] - sums[:n]) * down[:n]))
    return np.concatenate(out)


def _sliding(values, width, of):
    """Least or greatest of each run of ``width`` values, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = of(values[:-step], values[step:])
        size += step
    return values


def anchors(data, ends, length, anchor):
    """Places and 48-bit hashes of the anchors of documents that end at ``ends``."""
    hashes = string_hashes(data, anchor)
    width = length - anchor + 1
    never = np.uint64(0xFFFFFFFFFFFFFFFF)
    for end in ends[:-1].tolist():  # no string crosses from one document to the next
        hashes[max(end - anchor + 1, 0):end] = never
    places = []
    for start in range(0, max(len(hashes) - width + 1, 0), CHUNK):
        part = hashes[start:start + CHUNK + width - 1]
        least = _sliding(part, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        greatest = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
        places.append(start + np.flatnonzero((greatest == part) & (part != never)))
    places = np.sort(np.concatenate(places)) if places else np.zeros(0, np.int64)
    places = places[np.diff(places, prepend=-1) > 0]  # stretches overlap
    return places, hashes[places] >> np.uint64(16)


def pack(*arrays):
    """Arrays as one compressed string of bytes; bytes of equal weight stand together."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).reshape(len(a), -1).view(np.uint8)
        parts.append(np.array([len(a)], np.int64).tobytes() + (planes.T if a.ndim == 1 else planes).tobytes())
    return zstandard.ZstdCompressor(1).compress(b"".join(parts))


def unpack(blob, *kinds):
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        kind, width = kind if isinstance(kind, tuple) else (kind, None)
        n = int(np.frombuffer(data, np.int64, 1, at)[0])
        size = np.dtype(kind).itemsize if width is None else width
        raw = np.frombuffer(data, np.uint8, n * size, at + 8)
        out.append(np.ascontiguousarray(raw.reshape(size, n).T).view(kind).reshape(n) if width is None else raw.reshape(n, width))
        at += 8 + n * size
    return out


class Sorter:
    """Sorts the rows of ``texts``, suffixes cut at a common width, within groups."""

    def __init__(self, texts):
        self.texts = texts
        n, self.width = texts.shape
        self.power = _powers(BASE, self.width + 1)
        self.prefix = np.zeros((n, self.width + 1), np.uint64)
        for i in range(self.width):
            self.prefix[:, i + 1] = self.prefix[:, i] * BASE + texts[:, i].astype(np.uint64) + np.uint64(1)

    def common(self, a, b):
        """Length of the common start of rows a and b, by binary search over prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        for _ in range(self.width.bit_length()):
            middle = (low + high + 1) // 2
            same = self.prefix[a, middle] == self.prefix[b, middle]
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def order(self, group):
        """Rows by group and content. Groups stand together; runs of 1, 2, 4, ... rows are merged."""
        order = np.arange(len(group))
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(first, len(group)))
        begin, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        width = 1
        while width < sizes.max(initial=0):
            at = np.flatnonzero(size > width)
            start = begin[at] + (at - begin[at]) // (2 * width) * (2 * width)  # of the two runs merged
            left = at < start + width
            end = np.minimum(start + 2 * width, begin[at] + size[at])
            low = np.where(left, np.minimum(start + width, end), start)
            high = np.where(left, end, start + width)
            other, item = low.copy(), order[at]
            todo = np.flatnonzero(low < high)
            while len(todo):
                middle = (low[todo] + high[todo]) // 2
                mine, theirs = item[todo], order[middle]
                n = self.common(theirs, mine)
                last = np.minimum(n, self.width - 1)
                before = np.where(n == self.width, ~left[todo], self.texts[theirs, last] < self.texts[mine, last])  # equal: the left run first
                low[todo] = np.where(before, middle + 1, low[todo])
                high[todo] = np.where(before, high[todo], middle)
                todo = todo[low[todo] < high[todo]]
            merged = order.copy()
            merged[np.where(left, at, at - width) + low - other] = item
            order, width = merged, 2 * width
        return order

    def neighbours(self, group):
        """Order, and the verified common extension of each row with the one before (-1: other group)."""
        order = self.order(group)
        a, b = order[:-1], order[1:]
        common = self.common(a, b)
        agree = self.texts[a] == self.texts[b]
        wrong = np.flatnonzero(~(agree | (np.arange(self.width) >= common[:, None])).all(1))  # equal hashes, other bytes
        common[wrong] = agree[wrong].argmin(1)
        return order, np.concatenate([[-1], np.where(group[a] == group[b], common, -1)])


class Block:
    """Documents joined to one array of bytes."""

    def __init__(self, row, length, anchor):
        self.ids, self.sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.length, self.anchor = length, anchor
        self.copy = np.zeros(len(self.ids), bool)
        self.copy[row["copies"] or []] = True

    def anchors(self):
        """Places and hashes of the anchors of documents that are no copies."""
        places, hashes = anchors(self.data, self.ends, self.length, self.anchor)
        own = ~self.copy[self.document(places)]
        return places[own], hashes[own]

    def document(self, places):
        return np.searchsorted(self.ends, places, side="right")

    def extent(self, places):
        """Bytes before and from each place that its surroundings hold, cut where its document ends."""
        document = self.document(places)
        start, end = (self.ends - self.sizes)[document], self.ends[document]
        return np.minimum(self.length - self.anchor, places - start), np.minimum(self.length, end - places)

    def marks(self, places):
        """Hashes of the surroundings of sorted places."""
        before = self.length - self.anchor
        left, right = self.extent(places)
        most = min(len(self.data), CHUNK + before + self.length) + 1
        up, down = _powers(BASE, most), _powers(np.uint64(pow(int(BASE), -1, 1 << 64)), most)
        out = np.zeros(len(places), np.uint64)
        for at in range(0, len(self.data), CHUNK):
            own = slice(*np.searchsorted(places, (at, at + CHUNK)))
            base = max(at - before, 0)
            part = self.data[base:at + CHUNK + self.length].astype(np.uint64) + np.uint64(1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)])])
            low, high = places[own] - left[own] - base, places[own] + right[own] - base
            out[own] = _mix((sums[high] - sums[low]) * down[low]) + left[own].astype(np.uint64)
        return out

    def anchor_hashes(self):
        """Sorted distinct hashes of the block, whether several documents hold each, and how many distinct surroundings it has."""
        places, hashes = self.anchors()
        if not len(hashes):
            return hashes, np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        order = np.argsort(hashes, kind="stable")
        marks, hashes, document = self.marks(places)[order], hashes[order], self.document(places)[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        several = np.maximum.reduceat(document, first) > np.minimum.reduceat(document, first)
        times = np.diff(np.append(first, len(hashes)))
        kinds = np.ones(len(first), np.uint32)
        group = np.repeat(np.flatnonzero(times > 1), times[times > 1])
        marks = marks[np.repeat(times > 1, times)]
        order = np.lexsort((marks, group))
        group, marks = group[order], marks[order]
        np.add.at(kinds, group[1:][(group[1:] == group[:-1]) & (marks[1:] != marks[:-1])], 1)
        return hashes[first], several.astype(np.uint8), kinds

    def surroundings(self, shared, crowded):
        """Occurrences and distinct surroundings of shared anchors, sorted by hash.

        Of a crowded anchor each string of ``length`` bytes around it is an anchor of its own.
        """
        before = self.length - self.anchor
        places, hashes = self.anchors()
        own = _found(shared, hashes)
        places, hashes = places[own], hashes[own]
        left, right = self.extent(places)
        dense = _found(crowded, hashes)
        if dense.any():
            edges = np.zeros(len(self.data) + 1, np.int32)
            np.add.at(edges, np.maximum(places[dense] - before, 0), 1)
            np.add.at(edges, places[dense] + 1, -1)
            windows = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
            doc = self.document(windows)
            windows = windows[windows + self.length <= self.ends[np.minimum(doc, len(self.ends) - 1)]]
            marks = _mix(string_hashes(self.data, self.length)[windows]) >> np.uint64(16)
            places = np.concatenate([places[~dense], windows])
            hashes = np.concatenate([hashes[~dense], marks])
            left = np.concatenate([left[~dense], np.zeros(len(windows), np.int64)])
            right = np.concatenate([right[~dense], np.full(len(windows), self.length)])
        useful = left + right >= self.length
        places, hashes, left, right = places[useful], hashes[useful], left[useful], right[useful]
        kinds, which = self.distinct(places, hashes, left, right)
        rows = kinds.view(np.uint8).reshape(len(kinds), -1) if len(kinds) else np.zeros((0, 10 + before + self.length), np.uint8)
        ids = self.ids[self.document(places)]
        least, most = np.full(len(kinds), NO_ID), np.full(len(kinds), np.iinfo(np.int64).min)
        np.minimum.at(least, which, ids)
        np.maximum.at(most, which, ids)
        return places, which, ids, rows, least, most

    def distinct(self, places, hashes, left, right):
        """Sorted distinct surroundings as rows of bytes, and the number of each place's; some places at a time."""
        span = np.arange(self.anchor - self.length, self.length)
        order, kinds, which, known = np.argsort(hashes, kind="stable"), [], np.zeros(len(places), np.int64), 0
        for at in range(0, len(order), CHUNK):
            part = order[at:at + CHUNK]
            inside = (span >= -left[part, None]) & (span < right[part, None])
            texts = np.where(inside, self.data[np.clip(places[part, None] + span, 0, len(self.data) - 1)], 0)
            rows = np.concatenate([hashes[part].byteswap().view(np.uint8).reshape(-1, 8), left[part, None].astype(np.uint8), right[part, None].astype(np.uint8), texts], axis=1)
            own, number = np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel(), return_inverse=True)
            kinds.append(own)
            which[part] = number.ravel() + known
            known += len(own)
        if len(kinds) < 2:
            return (kinds or [np.zeros(0, "V1")])[0], which
        every, number = np.unique(np.concatenate(kinds), return_inverse=True)
        return every, number.ravel()[which]


def _found(known, values):
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _range(hashes, ranges):
    return ((hashes >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)


def _by_range(hashes, ranges):
    """(range, start, end) of sorted hashes."""
    of = _range(hashes, ranges).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return [(int(of[a]), int(a), int(b)) for a, b in zip(first, np.append(first[1:], len(of)))]


def _least_by_offset(texts, group, low, high, least, length, anchor):
    """Entry (row, j): least id of the group's rows with the same string from j bytes before the anchor.

    Strings agree if what precedes the anchor agrees on j bytes and what begins at the anchor on
    the rest, so the suffixes at the anchor and the reversed text before it are sorted.
    """
    before = length - anchor
    sides = [Sorter(side).neighbours(group) for side in (np.ascontiguousarray(texts[:, :before][:, ::-1]), np.ascontiguousarray(texts[:, before:]))]
    found = np.full((len(texts), before + 1), NO_ID)
    kind = [np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)]
    for j in range(before + 1):
        own = np.flatnonzero((low <= j) & (j <= high))
        if len(own):
            for (order, common), classes, n in zip(sides, kind, (j, length - j)):
                classes[order] = np.cumsum(common < n)
            _, which = np.unique(kind[0][own] * (len(texts) + 1) + kind[1][own], return_inverse=True)
            lowest = np.full(int(which.max()) + 1, NO_ID)
            np.minimum.at(lowest, which, least[own])
            found[own, j] = lowest[which]
    return found


def _runs(rows, found, low, high):
    """Runs (row, first j, last j, id) of equal entries between low and high."""
    counts = np.maximum(high - low + 1, 0)
    row = np.repeat(np.arange(len(rows)), counts)
    j = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + low[row]
    ids = found[row, j]
    begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])])[:len(row)])
    end = np.append(begin[1:], len(row))[:len(begin)] - 1
    return np.stack([rows[row[begin]], j[begin], j[end], ids[begin]], axis=1)


def least_documents(rows, least, length, anchor):
    """Runs (row, first j, last j, id): the string that starts j bytes before a row's anchor occurs
    first in document ``id``. Rows are sorted distinct surroundings with the least id of each."""
    before = length - anchor
    left, right, texts = rows[:, 8].astype(np.int64), rows[:, 9].astype(np.int64), rows[:, 10:]
    hashes = np.ascontiguousarray(rows[:, :8]).view(">u8").ravel()
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(hashes)))
    low, high = np.maximum(0, length - right), np.minimum(before, left)
    alone = np.repeat(sizes == 1, sizes)
    out = [np.stack([np.flatnonzero(alone), low[alone], high[alone], least[alone]], axis=1)]
    group = np.repeat(np.arange(len(first)), sizes)
    met = np.flatnonzero(~alone)
    cuts, size = [0], 0
    for i, n in zip(np.flatnonzero(sizes > 1), sizes[sizes > 1]):  # whole groups, some at a time
        size += n
        if size >= 16_000:
            cuts.append(cuts[-1] + size)
            size = 0
    cuts.append(len(met))
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            part = met[a:b]
            out.append(_runs(part, _least_by_offset(texts[part], group[part], low[part], high[part], least[part], length, anchor), low[part], high[part]))
    return np.concatenate(out)


def _blocks(docs, id_col, text_col, block_bytes, extra=()):
    """Documents packed in blocks. ``extra`` columns are kept as one Arrow table per block."""
    picked = docs.select(F.col(id_col).cast("long").alias("c0"), F.col(text_col).alias("c1"), *extra)
    schema = "block long, bytes long, ids binary, sizes binary, digests binary, data binary, extra binary"
    names, extra = ["block", "bytes", "ids", "sizes", "digests", "data", "extra"], bool(extra)

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        ids, texts, rows, size = [], [], [], 0
        packer = zstandard.ZstdCompressor(1)

        def row():
            stream = b""
            if extra:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows[0].schema) as writer:
                    for r in rows:
                        writer.write_batch(r)
                stream = packer.compress(sink.getvalue().to_pybytes())
            sizes = np.array([len(t) for t in texts], np.int64)
            known = np.array([NO_ID if i is None else i for i in ids], np.int64)
            values = [number, int(sizes.sum()), known.tobytes(), sizes.tobytes(), b"".join(hashlib.sha256(t).digest()[:16] for t in texts), packer.compress(b"".join(texts)), stream]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i < 2 else pa.binary()) for i, v in enumerate(values)], names=names)

        for batch in batches:
            start = 0
            for i, (own, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                ids.append(own)
                texts.append(utf8(text))
                size += len(texts[-1])
                if size >= block_bytes or len(ids) >= MOST_DOCUMENTS:
                    rows.append(batch.select(range(2, batch.num_columns)).slice(start, i + 1 - start) if extra else None)
                    yield row()
                    number, ids, texts, rows, size, start = number + 1, [], [], [], 0, i + 1
            if start < batch.num_rows and extra:
                rows.append(batch.select(range(2, batch.num_columns)).slice(start))
        if ids:
            yield row()

    return picked.mapInArrow(run, schema)


MOST_DOCUMENTS = 1 << 16  # in a block, however short

BLOCK = ["ids", "sizes", "data", "copies"]


def _copies(blocks):
    """block, copies: numbers of the documents of a block that equal one with a smaller id."""
    schema = pa.schema([("block", pa.int64()), ("number", pa.int32()), ("id", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), r["block"])), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids),
                                                  pa.array([r["digests"][16 * i:16 * i + 16] for i in range(len(ids))], pa.binary())], schema=schema)

    rows = keep(blocks.select("block", "ids", "digests").mapInArrow(run, "block long, number int, id long, digest binary"), "digests")
    first = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("digest", "least")
    return keep(rows.join(first, "digest").where("id > least").groupBy("block").agg(F.collect_list("number").alias("copies")), "copies")


def _marked(blocks, length, anchor, crowd, range_bytes):
    """Blocks with ``shared``, the hashes of their shared anchors, and ``runs``, what these cover."""
    spark = blocks.sparkSession
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    blocks = blocks.join(_copies(blocks), "block", "left")
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // range_bytes + 1)

    def name_anchors(batches):
        for b in batches:
            for r in b.to_pylist():
                hashes, several, kinds = Block(r, length, anchor).anchor_hashes()
                rows = [{"range": of, "block": r["block"], "blob": pack(np.diff(hashes[x:y], prepend=np.uint64(0)), several[x:y], kinds[x:y])}
                        for of, x, y in _by_range(hashes, ranges)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=named)

    named = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])
    found = blocks.select("block", *BLOCK).mapInArrow(name_anchors, "range long, block long, blob binary")

    def find_shared(table):
        of = table.column("block").to_pylist()
        parts = [unpack(b, np.uint64, np.uint8, np.uint32) for b in table.column("blob").to_pylist()]
        hashes = [np.cumsum(p[0]) for p in parts]
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        times = np.add.reduceat(np.concatenate([p[1] for p in parts])[order].astype(np.int64) + 1, first)
        kinds = np.add.reduceat(np.concatenate([p[2] for p in parts])[order].astype(np.int64), first)
        shared, dense = every[first[times > 1]], every[first[(times > 1) & (kinds >= crowd)]]
        rows = []
        for block, own in zip(of, hashes):
            own = own[_found(shared, own)]
            if len(own):
                rows.append({"block": block, "blob": pack(np.diff(own, prepend=np.uint64(0)), _found(dense, own).astype(np.uint8))})
        return pa.Table.from_pylist(rows, schema=answered)

    answered = pa.schema([("block", pa.int64()), ("blob", pa.binary())])
    shared = (found.groupBy("range").applyInArrow(find_shared, "block long, blob binary")
              .groupBy("block").agg(F.sort_array(F.collect_list("blob")).alias("shared")))
    shared = keep(shared, "shared-anchors")
    joined = blocks.join(shared, "block")

    def name_surroundings(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r, length, anchor)
                _, _, _, rows, least, most = block.surroundings(*_hashes(r["shared"]))
                hashes = np.ascontiguousarray(rows[:, :8]).view(">u8").ravel().astype(np.uint64)
                out = [{"range": of, "block": r["block"], "blob": pack(rows[x:y], least[x:y], most[x:y])} for of, x, y in _by_range(hashes, ranges)]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=named)

    met = joined.select("block", *BLOCK, "shared").mapInArrow(name_surroundings, "range long, block long, blob binary")
    width = 10 + 2 * length - anchor

    def sort_suffixes(table):
        parts = [unpack(b, (np.uint8, width), np.int64, np.int64) for b in table.column("blob").to_pylist()]
        rows = np.concatenate([p[0] for p in parts])
        kinds, which = np.unique(np.ascontiguousarray(rows).view(f"V{width}").ravel(), return_inverse=True)
        least = np.full(len(kinds), NO_ID)
        np.minimum.at(least, which.ravel(), np.concatenate([p[1] for p in parts]))
        runs = least_documents(kinds.view(np.uint8).reshape(len(kinds), width), least, length, anchor)
        runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
        first = np.searchsorted(runs[:, 0], np.arange(len(kinds) + 1))
        out, at = [], 0
        for block, (own, _, most) in zip(table.column("block").to_pylist(), parts):
            kind = which.ravel()[at:at + len(own)]
            at += len(own)
            counts = first[kind + 1] - first[kind]
            row = np.repeat(np.arange(len(own)), counts)
            index = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[kind][row]
            useful = runs[index, 3] < most[row]
            row, index = row[useful], index[useful]
            if len(row):
                ends = np.cumsum(np.bincount(row, minlength=len(own)))
                out.append({"block": block, "blob": pack(np.diff(ends, prepend=0), runs[index, 1].astype(np.uint8), runs[index, 2].astype(np.uint8), runs[index, 3]),
                            "range": int(_range(np.ascontiguousarray(own[:1, :8]).view(">u8").ravel().astype(np.uint64), ranges)[0])})
        return pa.Table.from_pylist(out, schema=covered)

    covered = pa.schema([("block", pa.int64()), ("range", pa.int64()), ("blob", pa.binary())])
    runs = (met.groupBy("range").applyInArrow(sort_suffixes, "block long, range long, blob binary")
            .groupBy("block").agg(F.collect_list(F.struct("range", "blob")).alias("runs")))
    return blocks.join(shared.join(keep(runs, "covered"), "block"), "block", "left"), ranges


def _hashes(blobs):
    """Sorted shared hashes of a block, and those of crowded anchors."""
    parts = [unpack(b, np.uint64, np.uint8) for b in blobs or ()]
    hashes = np.concatenate([np.zeros(0, np.uint64)] + [np.cumsum(d) for d, _ in parts])
    dense = np.concatenate([np.zeros(0, np.uint8)] + [c for _, c in parts])
    order = np.argsort(hashes)
    return hashes[order], hashes[order][dense[order] > 0]


def removed(block, shared, runs, ranges):
    """Whether each byte of a block goes."""
    edges = np.zeros(len(block.data) + 1, np.int64)
    for document in np.flatnonzero(block.copy & (block.sizes >= block.length)):
        edges[block.ends[document] - block.sizes[document]] += 1
        edges[block.ends[document]] -= 1
    if runs:
        places, which, ids, rows, _, _ = block.surroundings(*_hashes(shared))
        hashes = np.ascontiguousarray(rows[:, :8]).view(">u8").ravel().astype(np.uint64)
        start = {of: a for of, a, _ in _by_range(hashes, ranges)}
        order = np.argsort(which, kind="stable")
        first = np.searchsorted(which[order], np.arange(len(rows) + 1))
        for r in runs:
            counts, low, high, least = unpack(r["blob"], np.int64, np.uint8, np.uint8, np.int64)
            kind = start[r["range"]] + np.repeat(np.arange(len(counts)), counts)
            times = first[kind + 1] - first[kind]
            run = np.repeat(np.arange(len(kind)), times)
            at = order[np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times) + first[kind][run]]
            useful = least[run] < ids[at]
            run, at = run[useful], places[at[useful]]
            np.add.at(edges, at - high[run], 1)
            np.add.at(edges, at - low[run] + block.length, -1)
    return np.cumsum(edges[:-1]) > 0


def _prepared(docs, id_col, text_col, length, anchor, crowd, block_bytes, range_bytes, extra=(), bucket_bytes=32 << 20):
    """Blocks stored in buckets, whose number follows the bytes of the texts. The catalog forgets the table at once."""
    spark = docs.sparkSession
    path = scratch_path(spark, "blocks")
    name = "grabqc_blocks_" + path.rsplit("-", 1)[1]
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // bucket_bytes + 1)
    (_blocks(docs, id_col, text_col, block_bytes, extra).write.bucketBy(buckets, "block")
     .option("compression", "uncompressed").option("path", path).format("parquet").saveAsTable(name))
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return _marked(stored, length, anchor, crowd, range_bytes)


def repeats(docs, id_col="doc_id", text_col="text", length=50, anchor=26, crowd=16_000, block_bytes=4 << 20, range_bytes=4 << 20):
    """Per row: id, bytes, bytes and runs removed, and the digest of the bytes that stay."""
    marked, ranges = _prepared(docs, id_col, text_col, length, anchor, crowd, block_bytes, range_bytes)
    fields = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r, length, anchor)
                gone = removed(block, r["shared"], r["runs"], ranges)
                rows = []
                for own, size, end in zip(block.ids.tolist(), block.sizes.tolist(), block.ends.tolist()):
                    part = gone[end - size:end]
                    spans = int(part[:1].sum() + (part[1:] & ~part[:-1]).sum())
                    rows.append({"doc_id": None if own == NO_ID else own, "n_bytes": size, "n_removed": int(part.sum()), "n_spans": spans,
                                 "kept_sha256": hashlib.sha256(block.data[end - size:end][~part].tobytes()).hexdigest()})
                yield pa.RecordBatch.from_pylist(rows, schema=fields)

    return marked.select(*BLOCK, "shared", "runs").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs, id_col="doc_id", text_col="text", length_col="n_chars", length=50, anchor=26, crowd=16_000, block_bytes=4 << 20, range_bytes=4 << 20):
    """All rows and columns of ``docs``, with what is left of the text and its new length."""
    names = [f"e{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    at_id, at_text = docs.columns.index(id_col), docs.columns.index(text_col)
    at_length = docs.columns.index(length_col) if length_col in docs.columns else None
    others = [n for i, n in enumerate(names) if i not in (at_text, at_length)]
    marked, ranges = _prepared(renamed, names[at_id], names[at_text], length, anchor, crowd, block_bytes, range_bytes,
                               [*map(F.col, others), F.col(names[at_text]).isNull().alias("was_null")])
    schema = renamed.schema
    fields = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r, length, anchor)
                gone = removed(block, r["shared"], r["runs"], ranges)
                stream = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(r["extra"]))
                table = stream.read_all().combine_chunks()
                empty = table.column("was_null").to_pylist()
                texts = [None if none else block.data[end - size:end][~gone[end - size:end]].tobytes().decode("utf-8", "ignore")
                         for size, end, none in zip(block.sizes.tolist(), block.ends.tolist(), empty)]
                columns = []
                for i, field in enumerate(fields):
                    if i == at_text:
                        columns.append(pa.array(texts, field.type))
                    elif i == at_length:
                        columns.append(pa.array([None if t is None else len(t) for t in texts], field.type))
                    else:
                        columns.append(table.column(field.name).combine_chunks().cast(field.type))
                yield from pa.Table.from_arrays(columns, schema=fields).to_batches()

    out = marked.select(*BLOCK, "extra", "shared", "runs").mapInArrow(run, schema)
    return out.toDF(*docs.columns)
