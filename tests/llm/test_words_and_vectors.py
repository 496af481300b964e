"""Word windows, clusters and vector codes against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from grabqc.llm import centroids, codes, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, window):
    """(id, words, removed, spans, kept) of each row, by comparing every window."""
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, words in split:
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            own = math.inf if i is None else i
            least[key] = min(least.get(key, math.inf), own)
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - window + 1):
            if least[tuple(words[p:p + window])] < (math.inf if i is None else i):
                gone.update(range(p, p + window))
        spans = [p for p in sorted(gone) if p - 1 not in gone]
        ends = [p + 1 for p in sorted(gone) if p + 1 not in gone]
        out.append((i, len(words), len(gone), list(zip(spans, ends)), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return out


def texts():
    rng = random.Random(5)
    some = [f"w{i}é" for i in range(40)]
    passage = " ".join(rng.choice(some) for _ in range(60))
    spread = passage.replace(" ", "\t\n ")
    rows = [(i, " ".join(rng.choice(some[:6]) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(100 + i, f"{i} {i} {passage[3 * i:]} tail {i} {passage[:100 - i]}") for i in range(20)]
    rows += [(200, spread), (201, None), (202, ""), (203, " \t\r\n"), (204, " a b"), (None, passage), (None, passage), (205, passage), (205, passage), (205, "a a a a " * 40),
             (206, "a " * 300), (1, passage), (207, "one " * 12), (208, "one " * 13), (209, "one " * 13 + "two")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window, start, block", [(13, None, 4 << 20), (13, 4, 300), (13, 13, 2000), (5, 1, 100), (1, None, 500), (50, 7, 1000)])
def test_repeated_words(spark, window, start, block):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, block int").repartition(5)
    out = substrings.cut_repeats(docs, window=window, start=start, block_bytes=block, range_bytes=1000)
    got = [(r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.spans], r.kept) for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute_words(rows, window), key=str)


def test_repeated_words_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.digests(substrings.cut_repeats(docs)).count() == 0
    lone = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, substrings.digests(substrings.cut_repeats(lone)).collect())) == [(1, 0, 0, empty), (2, 0, 0, empty)]
    assert "grabqc_" not in " ".join(t.name for t in spark.catalog.listTables())


def test_levels_double_up_to_the_window():
    assert substrings.lengths(13, 7) == [7, 13] and substrings.lengths(13, 3) == [3, 6, 12, 13]
    assert substrings.lengths(50, 7) == [7, 14, 28, 50] and substrings.lengths(1, 1) == [1] and substrings.lengths(4, 9) == [4]


def test_only_repeated_windows_are_extended():
    words = substrings.Words(np.array([1, 2]), np.array([15, 11]), np.frombuffer(b"a b c d e f g hx b c d e y", np.uint8))
    at, digests = words.first_level(2, 1)
    kinds = np.unique(digests[0])
    shared = np.array([np.count_nonzero(digests[0] == k) > 1 for k in kinds])
    assert at.tolist() == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12] and shared.sum() == 3  # b c, c d, d e
    at, longer = words.candidates([2, 4], [np.packbits(shared)], 1)
    assert at.tolist() == [1, 9] and longer[0][0] == longer[0][1]
    every = words.first_level(4, 1)
    assert np.array_equal(every[1][:, np.isin(every[0], at)], longer)


def brute_clusters(rows, k, rounds, scale, dims):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) * scale < centroids.LARGEST for x in v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    books = [v for _, v in starts]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(books))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        books = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else books[j] for j in range(len(books))]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), [tuple(b) for b in books]


def vectors(dims, count):
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(6, dims)).round(1)
    rows = [(i, (middle[i % 6] + rng.normal(size=dims) / 20).tolist()) for i in range(count)]
    rows += [(count + i, rows[3][1]) for i in range(count // 2)]  # one vector in a third of the rows
    bad = [None, [], [1.0] * (dims - 1), [None] + [0.0] * (dims - 1), [math.nan] * dims, [math.inf] + [0.0] * (dims - 1), [1e300] * dims]
    rows += [(5000 + i, v) for i, v in enumerate(bad)] + [(None, [0.5] * dims), (3, [0.25] * dims), (3, [0.25] * dims), (6000, [0.0] * dims), (6001, [-0.0] * dims), (6002, [2e5] * dims)]
    return rows


@pytest.mark.parametrize("k, rounds, block", [(16, 3, 8192), (5, 6, 37), (400, 2, 100)])
def test_clusters(spark, k, rounds, block):
    rows = vectors(8, 120)
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, ids int").repartition(3)
    found = centroids.cluster(df, dims=8, k=k, rounds=rounds, block_rows=block)
    want, books = brute_clusters(rows, k, rounds, 64, 8)
    assert found.centroids == books
    assert sorted((tuple(r) for r in found.assigned.collect()), key=str) == want
    total = sum(d for _, _, d in want)
    for r in centroids.report(found).collect():
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, books[r.cluster])).encode()).hexdigest()
    assert len(found.scanned) == rounds + 1 and found.scanned[0] == len(want) * len(books)
    if rounds == 6:  # once the centroids stand still, the bounds rule nearly everything out
        assert found.scanned[-1] < found.scanned[0] / 3


def test_bounds_are_loosened_by_the_sum_of_the_moves():
    """A centroid that went away and came back has not moved; summed drifts would have it rescanned."""
    there, away = np.array([[0, 0], [10, 0]]), np.array([[40, 0], [10, 0]])
    bounds = centroids.Bounds.first(np.array([[1, 0], [9, 0]]), there)
    bounds.move(np.stack([there, away, there]))
    assert bounds.scanned == 0 and bounds.cluster.tolist() == [0, 1]
    bounds.move(np.stack([there, away, there, away]))
    assert bounds.scanned > 0 and bounds.cluster.tolist() == [1, 1]


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    out = centroids.report(centroids.cluster(df))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute_codes(rows, parts, entries, rounds, scale, dims):
    kept = [(i, [math.floor(scale * x) for x in v], b) for i, v, b in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) * scale < codes.LARGEST for x in v)]
    width = dims // parts
    starts = [v for _, v in sorted((i, v) for i, v, _ in kept if i is not None)[:entries]]
    books = [[v[p * width:(p + 1) * width] for v in starts] for p in range(parts)]

    def near(p, v):
        part = v[p * width:(p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(p, v)[1], []).append(v[p * width:(p + 1) * width])
            moved.append([[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else books[p][j] for j in range(len(starts))])
        books = moved
    out = [(i, b, "".join(f"{near(p, v)[1]:02x}" for p in range(parts)), sum(near(p, v)[0] for p in range(parts))) for i, v, b in kept]
    return sorted(((i, code, error, sum(e for _, other, _, e in out if other == b)) for i, b, code, error in out), key=str), books


@pytest.mark.parametrize("parts, entries, rounds, block", [(4, 64, 2, 16384), (2, 7, 3, 11), (8, 256, 1, 50)])
def test_codes(spark, parts, entries, rounds, block):
    rows = [(i, v, None if n % 3 == 0 else n % 4) for n, (i, v) in enumerate(vectors(8, 60))]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, code int, of int").repartition(3)
    found = codes.encode(df, parts=parts, entries=entries, rounds=rounds, block_rows=block)
    want, books = brute_codes(rows, parts, entries, rounds, 256, 8)
    out = codes.report(found).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in out), key=str) == want
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {r.codebooks_sha256 for r in out} == {hashlib.sha256(text.encode()).hexdigest()}


@pytest.mark.parametrize("most", [1, 3, 10_000])
def test_walks_share_prefixes_and_give_the_first_nearest(most):
    rng = np.random.default_rng(3)
    parts = rng.integers(-3, 3, (500, 3))
    leaves, counts, which = codes.trie(parts)
    assert np.array_equal(leaves[which], parts) and counts.sum() == 500 and leaves.tolist() == sorted(set(map(tuple, parts.tolist()))) or leaves.tolist() == sorted(map(list, set(map(tuple, parts.tolist()))))
    entries = rng.integers(-3, 3, (9, 3))
    code, error = codes.walk(leaves, entries, most)
    far = ((leaves[:, None] - entries) ** 2).sum(2)
    assert np.array_equal(code, far.argmin(1)) and np.array_equal(error, far.min(1))
    weights = codes.weigh(leaves, counts, code, 9)
    for j in range(9):
        assert weights[j].tolist() == [*(leaves * counts[:, None])[code == j].sum(0), counts[code == j].sum()]


def test_codes_of_nothing_and_of_uneven_lengths(spark):
    df = spark.createDataFrame([(1, [1.0] * 3, 0), (2, None, 0), (3, [], 0)], "vec_id long, embedding array<float>, label int")
    assert codes.report(codes.encode(df)).count() == 0
    mixed = spark.createDataFrame([(i, [float(i)] * n, 0) for i, n in enumerate([4, 4, 8, 8, 6, 8])], "vec_id long, embedding array<float>, label int")
    assert sorted(r.vec_id for r in codes.encode(mixed, parts=4).coded.collect()) == [2, 3, 5]
