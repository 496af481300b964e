"""Every stage of the pipeline on nulls, empty and long texts, ties, repeated rows, clashing names and empty tables."""

import hashlib
from collections import Counter

import pytest
from test_documents import prose

import corpus_pipeline

GOOD = [prose(120, 100 + i) for i in range(20)]
LONG = prose(60000, 901)
ROWS = [*enumerate(GOOD), *[(20 + i, "## 00 !! $$ 11 " * (20 + i)) for i in range(20)]]
EDGES = [(50, GOOD[0]), (50, GOOD[0]), (None, GOOD[1]), (None, prose(80, 900)), (None, prose(80, 900)), (None, None), (51, None), (51, None),
         (52, ""), (53, ""), (54, LONG), (55, prose(90, 902)), (55, prose(90, 903)), (None, "")]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 2 else "en", "s" if k % 3 else None, None if t is None else len(t), 1.5, f"own {k}") for k, (i, t) in enumerate(ROWS + EDGES)]
    # quality_score and component_id are names that operators use as well
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, quality_score double, component_id string").repartition(3)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Tables with nulls, and empty ones."""
    full, empty = (str(tmp_path_factory.mktemp(n)) for n in ("full", "empty"))
    labels = [(i, int(i < 20), 0) for i in range(40)] + [(None, 1, 0), (3, None, None)]
    for where, keep in ((full, True), (empty, False)):
        spark.createDataFrame(labels if keep else [], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
        spark.createDataFrame([(1, "nothing of this stands in any text at all"), (None, None), (3, "")] if keep else [], "item_id long, text string").write.parquet(
            f"{where}/benchmark.parquet")
    return full, empty


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_rejects_by_text_alone(spark, docs, folders):
    out = STAGES["quality classifier"](spark, docs, folders[0])
    left = pairs(out)
    assert out.columns == docs.columns and not any(i is not None and 20 <= i < 40 for i, _ in left)
    assert left == pairs(docs.where("text IS NOT NULL AND text <> '' AND text NOT LIKE '##%'"))  # null ids, copies and the long text stay


def test_one_of_each_group_stays(spark, docs, folders):
    out = STAGES["near-duplicates"](spark, docs, folders[0])
    left = pairs(out)
    assert out.columns == docs.columns and set(left.values()) == {1} and left.keys() <= pairs(docs).keys()
    ids = Counter(i for i, _ in left)
    assert ids[0] == 1 and not ids[50] and ids[54] == 1  # a copy of document 0 goes, the long text stays
    assert (51, None) in left and not ids[52] and not ids[53]  # of null and empty texts the smallest id
    assert ids[55] == 2 and (None, prose(80, 900)) in left  # rows that share an id but not a text


def test_passages_are_cut_whatever_the_id(spark, docs, folders):
    out = STAGES["repeated passages"](spark, docs, folders[0])
    left = pairs(out)
    assert out.columns == docs.columns and sum(left.values()) == len(ROWS + EDGES)
    assert left[50, ""] == 2 and left[0, GOOD[0]] == 1  # both copies of document 0 lose all of it
    assert left[None, prose(80, 900)] == 2 and left[None, None] == 1 and left[51, None] == 2  # rows without an id do not cut each other
    assert left[54, LONG] == 1 and left[52, ""] == 1
    assert sorted(r.n_chars for r in out.where("doc_id = 50").collect()) == [0, 0]


def test_items_that_are_null_or_empty_match_nothing(spark, docs, folders):
    out = STAGES["benchmark decontamination"](spark, docs, folders[0])
    assert out.columns == docs.columns and pairs(out) == pairs(docs)


def test_each_row_has_tokens(spark, docs, folders):
    out = STAGES["byte-level BPE"](spark, docs, folders[0]).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert Counter((r.doc_id, r.decoded_sha256) for r in out) == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS + EDGES)
    assert all((r.n_tokens == 0) == (r.decoded_sha256 == nothing) for r in out)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, docs, folders, name):
    full, empty = folders
    stage, none = STAGES[name], docs.where("false")
    assert stage(spark, none, full).count() == stage(spark, none, empty).count() == 0
    if name in ("quality classifier", "benchmark decontamination"):  # without labels or items nothing goes
        assert pairs(stage(spark, docs, empty)) == pairs(docs)
