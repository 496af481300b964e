"""Benchmark decontamination: edit distance through a random-walk embedding and bit sampling.

Words are the letters of the distance. The CGK walk reads a run of words and, at each step,
writes the word it stands on and moves on or stays, by a shared random bit for (step, word). It
maps runs at edit distance k to strings whose Hamming distance is of the order of k. Several
walks, each sampled at a few random places, give the keys of a hash table; two runs that share a
key are compared by exact edit distance. ``repeats`` follows from the target recall.

Windows of a text are as long as an item, at every word. Of those only the ones go on that
could lie within the distance at all: each edit spoils at most two of an item's pairs of
neighbouring words, so a window within the distance holds nearly all of them. The test is a
running count of pairs that occur in some item of that length; it loses nothing.

Items are read in blocks of ``block_items``, each block sent to all tasks, so what is broadcast
has a bound; every block is held against every row.

Nulls: null or empty texts and items match nothing and stay in the result. Items with fewer than
``least_words`` words match exactly only. Equal items are reported each. Repeated rows get a row
each; empty tables give an empty result or clean rows.
"""

from collections import Counter
from itertools import repeat
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from grabqc.llm.common import free_name, parts, utf8

# Bytes that belong to words: a-z, 0-9 and all beyond ASCII; A-Z become a-z.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SEED = 20240


def words_of(text):
    return utf8(text).translate(WORD_BYTES).split()


def edit_distance(item, window, most):
    """Least edit distance of ``item`` to a start of ``window``, or ``most`` + 1 if it is larger."""
    far = most + 1
    before = [min(j, far) for j in range(len(window) + 1)]
    for i, word in enumerate(item, 1):
        row = [far] * (len(window) + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(len(window), i + most) + 1):
            row[j] = min(before[j - 1] + (word != window[j - 1]), before[j] + 1, row[j - 1] + 1, far)
        if min(row) == far:
            return far
        before = row
    return min(before)


WALKS = 2.5  # times those that independent walks would need


class Index:
    """Items of one block, hashed by sampled places of their embeddings."""

    def __init__(self, items, max_distance, recall, sampled, least_words):
        self.items = [(i, words_of(t)) for i, t in items]
        self.items = [(i, w) for i, w in self.items if w]
        self.max_distance, self.recall, self.sampled, self.least_words = max_distance, recall, sampled, least_words
        self.ids = {w: n for n, w in enumerate(dict.fromkeys(w for _, ws in self.items for w in ws), 1)}
        self.size = len(self.ids) + 1
        self.by_length, self.tables = {}, {}
        for n, (_, words) in enumerate(self.items):
            self.by_length.setdefault(len(words), []).append(n)
        numbers = [self.numbers(w) for _, w in self.items]
        self.item_pairs, self.item_times = zip(*(np.unique(self.pair_keys(n), return_counts=True) for n in numbers)) if numbers else ((), ())
        pairs = {length: np.unique(np.concatenate([self.item_pairs[m] for m in members])) for length, members in self.by_length.items()}
        self.pairs_of = pairs
        # an edit spoils two pairs and may hide a third behind an equal neighbour
        self.least_fresh = {length: max(1, min(int(self.fresh(self.pair_keys(numbers[m])).sum()) for m in members) - 3 * self.most(length))
                            for length, members in self.by_length.items() if length > 1}
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs.values()]))
        self.classes = []  # lengths within a quarter of each other are ruled out together
        for length in sorted(n for n in self.by_length if n > 1):
            if not self.classes or length > 1.25 * self.classes[-1][0]:
                self.classes.append([])
            self.classes[-1].append(length)
        self.kinds = np.zeros(len(self.pairs), np.int64)
        for i, lengths in enumerate(self.classes):
            for length in lengths:
                self.kinds[np.searchsorted(self.pairs, pairs[length])] |= 1 << i
        for length, members in self.by_length.items():
            rng = np.random.default_rng([SEED, length])
            walks, steps = self.repeats(length), 3 * length
            flips = rng.integers(0, 1 << 62, (steps, walks), dtype=np.uint64)
            taken = np.zeros((steps, walks), bool)
            for walk in range(walks):
                taken[rng.permutation(steps)[:sampled], walk] = True
            keys = self.keys(np.stack([numbers[m] for m in members]), flips, taken)
            table = {}
            for m, row in zip(members, keys.tolist()):
                for walk, key in enumerate(row):
                    table.setdefault((walk, key), []).append(m)
            self.tables[length] = flips, taken, table

    def most(self, length):
        return 0 if length < self.least_words else int(self.max_distance * length)

    def least_pairs(self, length):
        return max(length - 1 - 2 * self.most(length), 1)

    def repeats(self, length):
        """Walks needed for the target recall at the largest distance.

        There about 4.8 of a walk's 3n places differ for each of k edits (measured). Two texts that one
        walk parts are likelier to be parted by the next, as it depends on where the edits are: with the number that
        independent walks would need, 0.89 were found in place of 0.95. ``WALKS`` times as many find more than the target.
        """
        k = self.most(length)
        share = max(1 - 1.6 * k / length, 0.05) ** self.sampled
        return 1 if k == 0 else max(1, ceil(WALKS * log(1 - self.recall) / log(1 - share)))

    def numbers(self, words):
        return np.array(list(map(self.ids.get, words, repeat(0))), np.int64)

    def pair_keys(self, numbers):
        return numbers[:-1] * self.size + numbers[1:]

    @staticmethod
    def keys(runs, flips, taken):
        """A key for each run (row) and walk: the embedding's letters at the sampled steps, hashed."""
        rows, length = runs.shape
        padded = np.concatenate([runs, np.full((rows, 1), -1, np.int64)], axis=1).astype(np.uint64)
        lines = np.arange(rows)[:, None]
        at = np.zeros((rows, flips.shape[1]), np.int64)
        out = np.zeros(at.shape, np.uint64)
        for step in range(3 * length):
            letter = padded[lines, at]
            sampled = taken[step]
            if sampled.any():
                out[:, sampled] = (out[:, sampled] * np.uint64(0x100000001B3) + letter[:, sampled] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (letter + flips[step]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            at = np.minimum(at + (mixed >> np.uint64(63)).astype(np.int64), length)
        return out

    def counted(self, keys, known, fresh):
        """Running number of fresh keys that are known."""
        found = (known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys) & fresh
        return np.concatenate([[0], np.cumsum(found)])

    @staticmethod
    def held(count, length):
        """Known keys within the window of ``length`` words at each place; the last ones are cut short."""
        return count[np.minimum(np.arange(len(count)) + length - 1, len(count) - 1)] - count

    @staticmethod
    def fresh(keys):
        """Whether each pair differs from the one before, as in a run of one repeated word it does not."""
        return np.concatenate([[True], keys[1:] != keys[:-1]])

    def suspects(self, numbers, rows):
        """{row: lengths} of the rows with a window that could hold an item of such a length."""
        out = {row: [1] for row in np.unique(rows[numbers > 0]).tolist()} if 1 in self.by_length else {}
        if len(self.pairs) and len(numbers) > 1:
            at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
            keys = numbers[at] * self.size + numbers[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            known = self.pairs[place] == keys
            if len(at) > 1:
                known[1:] &= (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1)
            at, kinds = at[known], self.kinds[place[known]]
            for i, lengths in enumerate(self.classes):
                own = at[(kinds >> i & 1) > 0]
                least = min(self.least_fresh[x] for x in lengths)
                if len(own) < least:  # no window can hold enough pairs
                    continue
                near = np.flatnonzero(own[least - 1:] - own[:len(own) - least + 1] < lengths[-1] - 1)
                # a window may begin in the row before
                for row in np.unique(np.concatenate([rows[own[near]], rows[own[near + least - 1]]])).tolist():
                    out.setdefault(row, []).extend(x for x in lengths if x > 1)
        return out

    def shared(self, keys, begin, item, length):
        """Pairs that windows share with an item, each as often as the item has it at most."""
        total = np.zeros(len(begin), np.int64)
        end = np.minimum(begin + length - 1, len(keys))
        for pair, times in zip(self.item_pairs[item], self.item_times[item]) if len(begin) else ():
            count = np.concatenate([[0], np.cumsum(keys == pair)])
            total += np.minimum(count[end] - count[begin], times)
        return total

    def windows(self, numbers, lengths):
        """(length, starts) of the windows of one text that hold enough of one item's pairs."""
        keys = self.pair_keys(numbers)
        fresh = self.fresh(keys) if len(keys) else keys
        for length in lengths:
            members = self.by_length[length]
            if length == 1:
                yield 1, np.flatnonzero(numbers)
            elif len(keys) and len(numbers) >= length - self.most(length):
                least = self.least_pairs(length)
                if self.held(self.counted(keys, self.pairs_of[length], fresh), length).max() >= self.least_fresh[length]:
                    enough = np.zeros(len(numbers), bool)
                    for m in members:
                        begin = np.flatnonzero(self.held(self.counted(keys, self.item_pairs[m], fresh), length) >= self.least_fresh[length])
                        enough[begin[self.shared(keys, begin, m, length) >= least]] = True
                    if enough.any():
                        yield length, np.flatnonzero(enough)

    def search(self, texts):
        """For each text, {item: (distance, first word)} of the items that it holds."""
        words = [words_of(t) for t in texts]
        best = [{} for _ in texts]
        todo = {}
        sizes = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(sizes)
        every = []
        for own in words:
            every += own
            every.append(b"")  # no word: it ends a text
        every = self.numbers(every)
        for row, lengths in self.suspects(every, np.repeat(np.arange(len(words)), sizes)).items():
            numbers = every[ends[row] - sizes[row]:ends[row] - 1]
            for length, starts in self.windows(numbers, lengths):
                index = starts[:, None] + np.arange(length)
                runs = np.where(index < len(numbers), numbers[np.minimum(index, len(numbers) - 1)], 0)
                todo.setdefault(length, []).append((row, starts, runs))
        for length, parts in todo.items():
            flips, taken, table = self.tables[length]
            most = self.most(length)
            runs = np.concatenate([p[2] for p in parts])
            places = [(p[0], s) for p in parts for s in p[1].tolist()]
            near = {}
            for block in range(0, len(runs), 2048):
                for (row, start), keys in zip(places[block:block + 2048], self.keys(runs[block:block + 2048], flips, taken).tolist()):
                    for m, same in Counter(m for walk, key in enumerate(keys) for m in table.get((walk, key), ())).items():
                        near.setdefault((row, m), []).append((-same, start))
            for (row, m), found in near.items():
                item, text = self.items[m]
                for _, start in sorted(found):
                    least = best[row].get(item, (most + 1, 0))[0]
                    distance = edit_distance(text, words[row][start:start + length + most], least - 1) if least else 0
                    if distance < least:
                        best[row][item] = distance, start
        return best


HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.LongType()),
                    T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType())])


def _item_blocks(items, most_items, most_bytes):
    """Items in blocks that are bounded by number and by bytes; a longer item stands alone."""
    block, size = [], 0
    for item in items:
        own = len(utf8(item[1])) + 64
        if block and (len(block) >= most_items or size + own > most_bytes):
            yield block
            block, size = [], 0
        block.append(tuple(item))
        size += own
    if block:
        yield block


def with_hits(docs, benchmark, name="benchmark_hits", text_col="text", item_col="item_id", item_text_col="text",
              max_distance=0.2, recall=0.95, sampled=6, least_words=5, block_items=20_000, block_bytes=8 << 20):
    """All columns of ``docs`` and, last, the items that a text holds, sorted by item; ``name`` must be free.

    Items pass through the driver one block at a time; a block, of at most ``block_bytes``, goes to the tasks with the code.
    """
    if free_name(docs.columns, name) != name:
        raise ValueError(f"there is a column {name} already")
    items = benchmark.select(F.col(item_col).cast("long"), item_text_col).toLocalIterator()
    marked = docs.withColumn(name, F.array().cast(T.ArrayType(HIT)))
    for block in _item_blocks(items, block_items, block_bytes):
        marked = _with_block(marked, name, text_col, block, (max_distance, recall, sampled, least_words))
    return marked


def _with_block(docs, name, text_col, items, options):
    at, last = docs.columns.index(text_col), docs.columns.index(name)
    hits_type = to_arrow_type(T.ArrayType(HIT))

    def run(batches):
        index = Index(items, *options)
        sizes = {i: len(w) for i, w in index.items}
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in parts(texts):
                part = batch.slice(a, b - a)
                found = index.search(texts[a:b])
                hits = [sorted([*before, *({"item_id": i, "distance": d, "first_word": s, "words": sizes[i]} for i, (d, s) in own.items())],
                               key=lambda h: (h["item_id"] is not None, h["item_id"]))
                        for before, own in zip(part.column(last).to_pylist(), found)]
                columns = part.columns
                columns[last] = pa.array(hits, hits_type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)


def contamination(docs, benchmark, id_col="doc_id", text_col="text", **options):
    """Per row: id, whether it holds an item, how many, which, and the closest one's similarity."""
    hits = F.col("benchmark_hits")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_hits(rows, benchmark, **options).select(
        "doc_id", (F.size(hits) > 0).alias("contaminated"), F.size(hits).cast("long").alias("n_items"),
        F.array_join(F.transform(hits, lambda h: h["item_id"].cast("string")), ",").alias("item_ids"),
        F.coalesce(F.array_max(F.transform(hits, lambda h: 1 - h["distance"] / h["words"])), F.lit(0.0)).alias("similarity"))


def drop_contaminated(docs, benchmark, text_col="text", **options):
    """The rows of ``docs`` that hold no item, with their columns as they are.

    Null and empty texts hold none and stay; repeated rows share their fate; without items all rows stay.
    """
    name = free_name(docs.columns, "benchmark_hits")
    return with_hits(docs, benchmark, name, text_col, **options).where(F.size(name) == 0).drop(name)
