"""Quality classifier: an additive model of per-feature and per-pair lookup tables.

Features are counted from the text alone. Each is cut into bins; shallow trees over one
feature's bins are boosted in turn, feature by feature, and their sum is that feature's table.
Then the pairs of features that explain most of what is left get tables of their own, from trees
with one cut on each. A text's score is the logistic of the sum of the entries of its bins.

The model is fitted on the driver from at most ``max_rows`` labelled rows, those with the
smallest hashes of their ids; this bound is also that of the one broadcast. Everything else
covers all rows.

Nulls: a null text is an empty text and has a score; a null id gets one too and is not held
out; rows with a null label or id are not learnt from. Of several labels of an id the largest
counts. Without labels of both kinds every score is the share of label 1 (one half without any).
Repeated rows are scored each; an empty table gives an empty result.
"""

from collections import Counter
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grabqc.llm.common import free_name, utf8

FEATURES = ["bytes", "words", "word_length", "longest_word", "upper", "digits", "symbols", "beyond_ascii", "distinct_words",
            "commonest_word", "repeats", "bare_marks", "ends_in_mark", "lines", "line_length", "distinct_lines", "title_words"]
MARKS = bytes(b for b in range(33, 127) if not bytes([b]).isalnum())


def features(text):
    """Numbers that describe a text, in the order of FEATURES."""
    data = utf8(text)
    words, lines = data.split(), [x for x in data.split(b"\n") if x]
    n, m = max(len(words), 1), max(len(lines), 1)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower, digits, beyond = int(count[65:91].sum()), int(count[97:123].sum()), int(count[48:58].sum()), int(count[128:].sum())
    blank = int(count[9:14].sum() + count[32])
    visible = max(len(data) - blank, 1)
    symbols = len(data) - blank - upper - lower - digits - beyond
    common = Counter(words)
    bare = ended = title = 0
    for word, times in common.items():
        if not word.isalnum():
            stem = word.rstrip(MARKS)
            ended += times if len(stem) < len(word) else 0
            bare += 0 if stem else times
        title += times if 65 <= word[0] < 91 else 0
    return (np.log1p(len(data)), np.log1p(len(words)), sum(map(len, words)) / n, np.log1p(max(map(len, words), default=0)), upper / max(upper + lower, 1),
            digits / visible, symbols / visible, beyond / visible, len(common) / n, max(common.values(), default=0) / n,
            sum(map(eq, words, words[1:])) / n, bare / n, ended / n, np.log1p(len(lines)), np.log1p(len(data) / m), len(set(lines)) / m, title / n)


def _leaves(gradient, weight, depth, least):
    """Values of a shallow tree over ordered bins: Newton steps of the leaves."""
    total, mass = gradient.sum(), weight.sum()
    if depth:
        left, below = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
        gain = left**2 / (below + 1) + (total - left)**2 / (mass - below + 1) - total**2 / (mass + 1)
        gain[(below < least) | (mass - below < least)] = -1
        if len(gain) and gain.max() > 1e-6:
            cut = int(gain.argmax()) + 1
            return np.concatenate([_leaves(gradient[:cut], weight[:cut], depth - 1, least), _leaves(gradient[cut:], weight[cut:], depth - 1, least)])
    return np.full(len(gradient), total / (mass + 1))


def _quadrants(gradient, weight, least):
    """Values and gain of the best tree with one cut on each of two features."""
    g, w = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (gradient, weight))

    def parts(x):
        a, b, c, d = x[1:-1, 1:-1], x[1:-1, -1:], x[-1:, 1:-1], x[-1, -1]
        return np.stack([a, b - a, c - a, d - b - c + a])

    gs, ws = parts(g), parts(w)
    gain = np.where((ws >= least).all(0), (gs**2 / (ws + 1)).sum(0), 0)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    step = gs[:, i, j] / (ws[:, i, j] + 1)
    out = np.empty(gradient.shape)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = step
    return out, gain[i, j]


class Model:
    """Bins, tables and pair tables; ``score`` looks a matrix of features up in them."""

    def __init__(self, edges, start, tables, pairs):
        self.edges, self.start, self.tables, self.pairs = edges, start, tables, pairs

    @classmethod
    def fit(cls, x, y, bins=32, rounds=60, rate=0.15, depth=2, pair_count=6, pair_rounds=20, pair_bins=8, least=5.0):
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0) for j in range(x.shape[1])]
        model = cls(edges, np.log(share / (1 - share)), [np.zeros(len(e) + 1) for e in edges], [])
        if not len(y) or y.min() == y.max():
            return model
        binned = model.bins(x)
        logit = np.full(len(y), model.start)

        def slopes():
            p = 1 / (1 + np.exp(-logit))
            return y - p, p * (1 - p)

        for _ in range(rounds):
            for j, table in enumerate(model.tables):
                gradient, weight = (np.bincount(binned[j], v, len(table)) for v in slopes())
                step = rate * _leaves(gradient, weight, depth, least * rate)
                table += step
                logit += step[binned[j]]
        coarse = [np.minimum(b * pair_bins // len(t), pair_bins - 1) for b, t in zip(binned, model.tables)]

        def grid(a, b):
            place = coarse[a] * pair_bins + coarse[b]
            return [np.bincount(place, v, pair_bins**2).reshape(pair_bins, pair_bins) for v in slopes()]

        ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_quadrants(*grid(*p), least * rate)[1])[:pair_count]
        model.pairs = [(a, b, pair_bins, np.zeros((pair_bins, pair_bins))) for a, b in ranked]
        for _ in range(pair_rounds):
            for a, b, _, table in model.pairs:
                step = rate * _quadrants(*grid(a, b), least * rate)[0]
                table += step
                logit += step[coarse[a], coarse[b]]
        return model

    def bins(self, x):
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def score(self, x):
        binned = self.bins(x)
        logit = np.full(len(x), self.start)
        for b, table in zip(binned, self.tables):
            logit += table[b]
        for a, b, n, table in self.pairs:
            place = [np.minimum(binned[j] * n // len(self.tables[j]), n - 1) for j in (a, b)]
            logit += table[place[0], place[1]]
        return 1 / (1 + np.exp(-logit))


def held_out(id_col):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def matrix(texts):
    return np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


def fit(docs, labels, id_col="doc_id", text_col="text", label_id="doc_id", label_col="quality", max_rows=20_000, **options):
    """A model of the labels of rows that are not held out."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    # at most max_rows pairs of numbers, whatever the corpus
    known = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("y", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            ids, texts, y = (batch.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays([pa.array([str(i) for i in ids]), pa.array(y, pa.float64()),
                                              pa.array([[float(v) for v in features(t)] for t in texts], pa.list_(pa.float64()))], names=["id", "y", "x"])

    found = rows.select("id", "text", "y").mapInArrow(run, schema).orderBy(F.xxhash64("id"), "id", "x").limit(max_rows).collect()
    x = np.array([r.x for r in found], dtype=np.float64).reshape(-1, len(FEATURES))
    return Model.fit(x, np.array([r.y for r in found], dtype=np.float64), **options)


def with_scores(docs, model, name="quality_score", text_col="text"):
    """All columns of ``docs`` and, last, the score; ``name`` must be free."""
    if free_name(docs.columns, name) != name:
        raise ValueError(f"there is a column {name} already")
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            scores = model.score(matrix(batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs, labels, id_col="doc_id", text_col="text", threshold=0.3, **options):
    """Per row: id, whether it was held out of learning, score and prediction."""
    model = fit(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_scores(rows, model, "score").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_rejected(docs, labels, id_col="doc_id", text_col="text", threshold=0.3, **options):
    """The rows of ``docs`` that are not predicted to be bad, with their columns as they are.

    Null and empty texts are scored like any other, so they stay or go by their score; repeated rows
    share their fate; rows with a null id are scored too.
    """
    model, name = fit(docs, labels, id_col, text_col, **options), free_name(docs.columns, "quality_score")
    return with_scores(docs, model, name, text_col).where(F.col(name) >= threshold).drop(name)
