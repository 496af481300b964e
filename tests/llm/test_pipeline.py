"""The pipeline's rows, stage by stage, against brute force on a small set of documents."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_documents import components, fingerprint, prose

import corpus_pipeline
from grabqc.llm import decontam, quality

ITEM, SHARED = prose(40, 777), prose(30, 778)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def documents():
    texts = [prose(120, 100 + i) for i in range(30)]
    texts += [texts[3], texts[3], texts[4] + "!", texts[5]]  # exact copies, and one that differs in its last word
    texts += [f"{prose(60, 200 + i)} {SHARED} {prose(20, 300 + i)}" for i in range(4)]
    changed = ITEM.split()
    changed[7], changed[20] = "other", "words"
    texts += [f"{prose(50, 400)} {ITEM} {prose(50, 401)}", f"{prose(50, 402)} {' '.join(changed)} {prose(50, 403)}"]
    texts += ["## 00 !! $$ 11 " * (20 + i) for i in range(25)]  # bad
    texts += [None, "", prose(90, 500).replace(" ", " é ")]
    return [(i, t, "en", "hot" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("sf"))
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{where}/documents.parquet")
    labels = [(i, int("##" not in (t or "")), 0) for i, t, *_ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, "a b"), (3, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def good(spark, folder, rows):
    """What the classifier keeps; its scores have a test of their own."""
    scored = quality.classify(spark.createDataFrame(rows, SCHEMA), spark.read.parquet(f"{folder}/labels.parquet"))
    keep = {r.doc_id for r in scored.collect() if r.predicted}
    return [r for r in rows if r[0] in keep]


def unlike(rows):
    group = components([fingerprint(r[1]) for r in rows], 2)
    return [r for i, r in enumerate(rows) if group[i] == i]


def cut(rows):
    data = {r[0]: (r[1] or "").encode() for r in rows}
    least = {}
    for i in sorted(data):
        for p in range(len(data[i]) - 49):
            least.setdefault(data[i][p:p + 50], i)
    out = []
    for i, text, *rest in rows:
        gone = {q for p in range(len(data[i]) - 49) if least[data[i][p:p + 50]] < i for q in range(p, p + 50)}
        left = bytes(b for p, b in enumerate(data[i]) if p not in gone).decode("utf-8", "ignore")
        out.append((i, None, *rest[:-1], None) if text is None else (i, left, *rest[:-1], len(left)))
    return out


def nearest(item, words):
    """Least edit distance of the item to any run of the words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(words, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[j - 1] + 1))
    return min(row)


def clean(rows):
    items = [decontam.words_of(ITEM), decontam.words_of("a b")]
    return [r for r in rows if all(nearest(w, decontam.words_of(r[1])) > (int(0.2 * len(w)) if len(w) >= 5 else 0) for w in items)]


def tokens(rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, text, *_ in rows:
        ids = whole.encode_ordinary(text or "")
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def test_rows_of_every_stage(spark, folder):
    rows = documents()
    docs, brute = spark.read.parquet(f"{folder}/documents.parquet"), [lambda r: good(spark, folder, r), unlike, cut, clean, tokens]
    sizes = []
    for (name, stage), expected in zip(corpus_pipeline.STAGES, brute, strict=True):
        rows = expected(rows)
        found = stage(spark, docs, folder)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str), name
        docs = spark.createDataFrame(rows, SCHEMA) if name != corpus_pipeline.STAGES[-1][0] else None
        sizes.append(len(rows))
    assert len(documents()) - sizes[0] >= 20 and sizes[0] - sizes[1] >= 3 and sizes[1] == sizes[2] > sizes[3]
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(rows)
