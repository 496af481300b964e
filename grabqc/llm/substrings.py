"""Repeated runs of words, found level by level at doubled lengths.

A word goes if some window of ``window`` words that covers it also starts in a document with a smaller
id. Windows are looked for at ``start`` words first. Only where windows of one length repeat in
another document are they extended to twice that length: the longer window needs both its halves
among them. The last step is cut to ``window``, its halves overlapping. The search ends there, as longer
windows cover no further word, or as soon as no candidates survive; a block left without any drops out before.

1. Documents are packed into blocks of bytes, written once and bucketed by block, so that what the
   blocks learn comes to them and they do not move.
2. At each level a block names the digests of its candidates, each once. They meet by range of the digest;
   the block gets back one bit for each: whether it occurs in another document too. A digest in one document only is no candidate any more.
3. At the last length digests are 128 bits wide and meet with the smallest id in each block. A block gets
   back the smallest id of all for those that occur in a document before its own.
4. Each block marks the words its windows cover and takes them out.

A window's digest is made from those of its halves, a word's from its bytes; words are not altered. Windows
count as equal by 128 bits of digest; their texts are not compared. At shorter lengths 64 bits are enough, as
there an accident only leaves a candidate for longer. A group holds ``range_bytes`` of digests, and one digest once for each block
it is in: a passage in a third of all rows weighs as much as there are blocks, not rows.

Nulls: a null text has no words. A null id counts as larger than any other and stays null; rows that
share an id, or have none, do not remove words from each other. Texts of any length are cut whole,
an empty table gives an empty result. Other columns are not read.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from grabqc.llm.common import keep
from grabqc.session import scratch_path

NO_ID = np.iinfo(np.int64).max
MOST_DOCUMENTS = 1 << 16  # in a block, however short


def lengths(window, start):
    """Lengths of the levels: doubled from ``start``, the last cut to ``window``."""
    out = [min(start, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def mix(a, b):
    """Digest of two digests in order, 64 bits each."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of a block of documents, and the digests of their windows."""

    def __init__(self, ids, sizes, data):
        self.ids, self.data = ids, data
        ends = np.cumsum(sizes)
        word = ~((data == 32) | ((data >= 9) & (data <= 13)))
        filled = sizes > 0
        edge = np.zeros(len(data) + 1, bool)  # where a document begins or the data ends
        edge[(ends - sizes)[filled]] = True
        edge[-1] = True
        apart = ~word
        self.begin = np.flatnonzero(word & (np.concatenate([[True], apart[:-1]]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
        end = np.flatnonzero(word & (np.concatenate([apart[1:], [True]]) | edge[1:])) + 1 if len(data) else np.zeros(0, np.int64)
        self.size = end - self.begin
        self.document = np.searchsorted(ends, self.begin, side="right")
        self.counts = np.bincount(self.document, minlength=len(ids)).astype(np.int64)
        self.text = data[word]
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        # words of the same document from each one on
        self.left = np.repeat(np.cumsum(self.counts), self.counts) - np.arange(len(self.begin))

    def digests(self):
        """128 bits for each word, as two rows."""
        words = pa.Array.from_buffers(pa.large_binary(), len(self.begin), [None, pa.py_buffer(self.at), pa.py_buffer(self.text)])
        coded = words.dictionary_encode()
        known = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist()), np.uint64).reshape(-1, 2).T
        return known[:, coded.indices.to_numpy(zero_copy_only=False)]

    def first_level(self, length, lanes):
        """Places of all windows of ``length`` words, and their digests in each lane."""
        at = np.flatnonzero(self.left >= length)
        now, of = self.digests()[:lanes], 1
        while of < length:
            longer = min(2 * of, length)
            step = longer - of
            now, of = mix(now[:, :now.shape[1] - step], now[:, step:]), longer
        return at, now[:, at]

    def extend(self, at, digests, length, longer):
        """Windows of ``longer`` words both of whose halves are among those at ``at``."""
        step = longer - length
        half = np.searchsorted(at, at + step)
        half[half == len(at)] = 0
        both = (at[half] == at + step) & (self.left[at] >= longer) if len(at) else np.zeros(0, bool)
        return at[both], mix(digests[:, both], digests[:, half[both]])

    def candidates(self, levels, bits, lanes):
        """(places, digests) of the windows at the last of ``levels`` that the levels before it leave."""
        at, digests = self.first_level(levels[0], lanes)
        for known, length, longer in zip(bits, levels, levels[1:]):
            kinds, which = np.unique(digests[0], return_inverse=True)
            alive = np.unpackbits(known, count=len(kinds)).astype(bool)[which]
            at, digests = self.extend(at[alive], digests[:, alive], length, longer)
        return at, digests

    def cut(self, gone):
        """Per document: how many words go, begins and ends of the runs that go, and the text that stays."""
        kept = np.flatnonzero(~gone)
        size, document = self.size[kept], self.document[kept]
        more = np.append(document[1:] == document[:-1], False) if len(kept) else np.zeros(0, bool)
        ends = np.cumsum(size + more)
        text = np.full(ends[-1] if len(ends) else 0, 32, np.uint8)
        from_, to = np.repeat(self.at[kept], size), np.repeat(ends - size - more, size)
        inside = np.arange(len(from_)) - np.repeat(np.cumsum(size) - size, size)
        text[to + inside] = self.text[from_ + inside]
        bytes_ = np.zeros(len(self.ids), np.int64)
        np.add.at(bytes_, document, size + more)
        first = np.cumsum(self.counts) - self.counts
        number = np.arange(len(gone)) - first[self.document]
        same = np.append(self.document[1:] == self.document[:-1], False) if len(gone) else np.zeros(0, bool)
        begins = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & same[:-1]])) if len(gone) else np.zeros(0, np.int64)
        last = np.flatnonzero(gone & ~(np.append(gone[1:], False) & same)) if len(gone) else np.zeros(0, np.int64)
        runs = np.bincount(self.document[begins], minlength=len(self.ids))
        return np.bincount(self.document[gone], minlength=len(self.ids)), runs, number[begins], number[last] + 1, bytes_, text


def read(row):
    """The words of a stored block."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), np.uint8)
    return Words(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64), data)


def _blocks(docs, id_col, text_col, block_bytes):
    """Documents packed into blocks of about ``block_bytes``, or one longer text."""
    picked = docs.select(F.col(id_col).cast("long").alias("c0"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("c1"))

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        ids, texts, size = [], [], 0
        packer = zstandard.ZstdCompressor(1)

        def row():
            sizes = np.array([len(t) for t in texts], np.int64)
            known = np.array([NO_ID if i is None else i for i in ids], np.int64)
            values = [number, int(sizes.sum()), known.tobytes(), sizes.tobytes(), packer.compress(b"".join(texts))]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i < 2 else pa.binary()) for i, v in enumerate(values)], names=["block", "bytes", "ids", "sizes", "data"])

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(own)
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size >= block_bytes or len(ids) >= MOST_DOCUMENTS:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield row()

    return picked.mapInArrow(run, "block long, bytes long, ids binary, sizes binary, data binary")


def _stored(blocks, buckets):
    """Blocks written once in buckets. The catalog forgets the table at once; its files stay in the scratch folder."""
    spark = blocks.sparkSession
    path = scratch_path(spark, "word-blocks")
    name = "grabqc_" + path.rsplit("-", 1)[1]
    blocks.write.bucketBy(buckets, "block").option("compression", "uncompressed").option("path", path).format("parquet").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def _by_range(digests, ranges):
    """(range, start, end) of the runs of sorted digests that fall into one range."""
    of = ((digests >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return list(zip(of[first].tolist(), first.tolist(), np.append(first[1:], len(of)).tolist()))


NAMED = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("blob", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("first", pa.int64()), ("alive", pa.int64()), ("blob", pa.binary())])


def _met(found, meet):
    """What the ranges answer, one row for each block they leave something: an array of (first, blob), in order."""
    return (found.groupBy("range").applyInArrow(meet, "block long, first long, alive long, blob binary")
            .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("first", "blob"))).alias("answers"), F.sum("alive").alias("alive"))
            .where("alive > 0").select("block", "answers"))


def _repeated(blocks, levels, ranges):
    """Per block: for each digest of its candidates at the last of ``levels``, one bit, whether another document has it."""
    def name(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words = read(r)
                at, digests = words.candidates(levels, _bits(r), 1)
                order = np.argsort(digests[0], kind="stable")
                kinds, owner = digests[0][order], words.document[at[order]]
                first = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]])) if len(kinds) else np.zeros(0, np.int64)
                last = np.append(first[1:], len(kinds))[:len(first)] - 1
                several, kinds = (owner[first] != owner[last]).astype(np.uint8), kinds[first]
                rows = [{"range": of, "block": r["block"], "first": a,
                         "blob": zstandard.compress(np.diff(kinds[a:b], prepend=np.uint64(0)).tobytes() + several[a:b].tobytes(), 1)} for of, a, b in _by_range(kinds, ranges)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=NAMED)

    def meet(table):
        parts = [np.frombuffer(zstandard.decompress(b), np.uint8) for b in table.column("blob").to_pylist()]
        sizes = [len(p) // 9 for p in parts]
        every = np.concatenate([np.cumsum(p[:8 * n].view(np.uint64)) for p, n in zip(parts, sizes)])
        several = np.concatenate([p[8 * n:] for p, n in zip(parts, sizes)])
        order = np.argsort(every, kind="stable")
        sorted_ = every[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        times = np.add.reduceat(several[order].astype(np.int64) + 1, first)
        shared = np.empty(len(every), bool)
        shared[order] = np.repeat(times > 1, np.diff(np.append(first, len(every))))
        ends = np.cumsum(sizes)
        own = [shared[e - n:e] for e, n in zip(ends, sizes)]
        return pa.table({"block": table.column("block"), "first": table.column("first"), "alive": pa.array([int(bits.sum()) for bits in own], pa.int64()),
                         "blob": pa.array([zstandard.compress(bits.astype(np.uint8).tobytes(), 1) for bits in own], pa.binary())}, schema=ANSWER)

    return _met(blocks.mapInArrow(name, "range long, block long, first long, blob binary"), meet)


def _bits(row):
    """The bits of each level a block has been told of, packed."""
    return [np.packbits(np.frombuffer(b"".join(zstandard.decompress(a["blob"]) for a in answers), np.uint8)) for answers in row["levels"] or []]


def _earliest(blocks, levels, ranges):
    """Per block: the smallest id of each window digest that also starts in a document before the block's own."""
    def name(batches):
        for batch in batches:
            for r in batch.to_pylist():
                kinds, least, most, _, _ = _windows(read(r), levels, _bits(r))
                rows = [{"range": of, "block": r["block"], "first": a, "blob": zstandard.compress(kinds[a:b].tobytes() + least[a:b].tobytes() + most[a:b].tobytes(), 1)}
                        for of, a, b in _by_range(kinds["a"], ranges)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=NAMED)

    def meet(table):
        parts = [zstandard.decompress(b) for b in table.column("blob").to_pylist()]
        sizes = [len(p) // 32 for p in parts]
        kinds = np.concatenate([np.frombuffer(p, KIND, n) for p, n in zip(parts, sizes)])
        least = np.concatenate([np.frombuffer(p, np.int64, n, 16 * n) for p, n in zip(parts, sizes)])
        most = np.concatenate([np.frombuffer(p, np.int64, n, 24 * n) for p, n in zip(parts, sizes)])
        order = np.lexsort((kinds["b"], kinds["a"]))
        sorted_ = kinds[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        all_ = np.empty(len(kinds), np.int64)
        all_[order] = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.append(first, len(kinds))))
        rows, end = [], 0
        for block, at, n in zip(table.column("block").to_pylist(), table.column("first").to_pylist(), sizes):
            own, end = slice(end, end + n), end + n
            told = np.flatnonzero(all_[own] < most[own])
            if len(told):
                rows.append({"block": block, "first": at, "alive": len(told), "blob": zstandard.compress((at + told).tobytes() + all_[own][told].tobytes(), 1)})
        return pa.Table.from_pylist(rows, schema=ANSWER)

    return _met(blocks.mapInArrow(name, "range long, block long, first long, blob binary"), meet)


KIND = np.dtype([("a", np.uint64), ("b", np.uint64)])


def _windows(words, levels, bits):
    """Distinct digests of a block's candidates at the last level with their smallest and largest id; places and digest numbers of the candidates."""
    at, digests = words.candidates(levels, bits, 2)
    order = np.lexsort((digests[1], digests[0]))
    kinds = np.empty(len(at), KIND)
    kinds["a"], kinds["b"] = digests[0][order], digests[1][order]
    new = np.concatenate([[True], kinds[1:] != kinds[:-1]])[:len(kinds)]
    first = np.flatnonzero(new)
    which = np.empty(len(at), np.int64)
    which[order] = np.cumsum(new) - 1
    ids = words.ids[words.document[at]][order]
    least, most = (f.reduceat(ids, first) if len(first) else np.zeros(0, np.int64) for f in (np.minimum, np.maximum))
    return kinds[first], least, most, at, which


def cut_repeats(docs, id_col="doc_id", text_col="text", window=13, start=None, block_bytes=4 << 20, range_bytes=16 << 20, bucket_bytes=32 << 20):
    """Per row: doc_id, n_words, n_removed, ``spans`` of the words that go, and the words that stay, ``kept``.

    ``start`` is the length of the first level, by default half the window rounded up. The number of
    buckets and ranges follows the bytes of the texts.
    """
    if window < 1:
        raise ValueError("a window holds a word at least")
    spark = docs.sparkSession
    levels = lengths(window, start or -(-window // 2))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = _stored(_blocks(docs, id_col, text_col, block_bytes), max(partitions, total // bucket_bytes + 1))
    ranges = max(2 * partitions, total // range_bytes + 1)
    told = blocks.select("block", "ids", "sizes", "data", F.lit(None).cast("array<array<struct<first:long,blob:binary>>>").alias("levels"))
    known = None
    for number in range(1, len(levels)):
        answers = _repeated(told, levels[:number], ranges)
        if known is None:
            answers = answers.select("block", F.array("answers").alias("levels"))
        else:
            answers = answers.join(known, "block").select("block", F.concat("levels", F.array("answers")).alias("levels"))
        known = keep(answers, f"level-{levels[number - 1]}")
        told = blocks.select("block", "ids", "sizes", "data").join(known, "block")  # a block without candidates has no answers
        if known.isEmpty():
            break
    found = keep(_earliest(told, levels, ranges), "earliest")
    if known is None:
        told = told.join(found, "block", "left")
    else:
        told = blocks.select("block", "ids", "sizes", "data").join(known.join(found, "block"), "block", "left")
    listed = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words = read(r)
                edges = np.zeros(len(words.begin) + 1, np.int64)
                if r["answers"]:
                    kinds, _, _, at, which = _windows(words, levels, _bits(r))
                    least = np.full(len(kinds), NO_ID)
                    for a in r["answers"]:
                        blob = np.frombuffer(zstandard.decompress(a["blob"]), np.int64).reshape(2, -1)
                        least[blob[0]] = blob[1]
                    at = at[least[which] < words.ids[words.document[at]]]
                    edges[at] += 1
                    np.add.at(edges, at + window, -1)
                removed, runs, begins, ends, sizes, text = words.cut(np.cumsum(edges[:-1]) > 0)
                spans = pa.StructArray.from_arrays([pa.array(begins.astype(np.int32)), pa.array(ends.astype(np.int32))], names=["begin", "end"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(runs)]).astype(np.int32))
                kept = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(text)])
                yield pa.RecordBatch.from_arrays([pa.array([None if i == NO_ID else i for i in words.ids.tolist()], pa.int64()), pa.array(words.counts), pa.array(removed.astype(np.int64)),
                                                  pa.ListArray.from_arrays(offsets, spans).cast(listed), kept.cast(pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return told.select("ids", "sizes", "data", "levels", "answers").mapInArrow(run, "doc_id long, n_words long, n_removed long, spans array<struct<begin:int,end:int>>, kept string")


def digests(cut):
    """The words and the digest of what stays of each document."""
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
