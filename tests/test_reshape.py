from datetime import datetime

import pytest
from pyspark.sql import functions as F

from grabqc.operators import audits, identity, reshape
from grabqc.sources import tables

VISIT = "subid int, row_ID bigint, LASAR_ID bigint, DateTime timestamp_ntz, samplers string, DEQ_Comment string, Org_Comment string"
FIRST = (7, 1, 10001, datetime(2019, 6, 1, 10, 15), "crew", "agency note", None)


@pytest.mark.parametrize("name, known, expected", [
    ("ph_r", None, ("ph", "sample")), ("phd_r", None, ("ph", "dup")), ("ph_RESULTS", None, ("ph", "sample")),
    ("cond_r", None, ("con", "dup")), ("cond_r", {"cond"}, ("cond", "sample")), ("condd_r", {"cond"}, ("cond", "dup")),
    ("phd_r", {"ph"}, ("ph", "dup")), ("new_r", {"ph"}, ("new", "sample")), ("newd_r", {"ph"}, ("new", "dup")),
    ("PH_R", None, ("PH", "sample")), ("a_rb_r", None, ("a_rb", "sample")), ("ph_qual", None, None), ("_r", None, None)])
def test_result_column_names(name, known, expected):
    assert reshape.classify_result_column(name, known) == expected


def test_name_that_reads_both_ways_is_refused():
    with pytest.raises(ValueError, match="primary of 'cond' and a replicate of 'con'"):
        reshape.classify_result_column("cond_r", {"cond", "con"})


def test_melt_keeps_values_and_shares_metadata(spark, rows):
    df = spark.createDataFrame(
        [FIRST + ("7.1", "7.3", "<", "odd", "A", " "), (7, 2, 10002, None, "crew", None, None, None, "x", None, None, None, None)],
        VISIT + ", ph_r string, phd_r string, ph_qual string, ph_cmnt string, ph_ACC string, ph_DQL string")
    out = reshape.melt_results(df, {"ph"})
    assert rows(out, "row_ID", "Char", "CharIDText", "sample_type", "Result", "RsltQual", "Res_comment", "OG_ACC", "OG_PREC",
                "OG_DQL", "DEQ_Comment") == [
        (1, "ph_r", "ph", "sample", 7.1, "<", "odd", "A", None, None, "agency note"),
        (1, "phd_r", "ph", "dup", 7.3, "<", "odd", "A", None, None, "agency note")]


def test_alternate_endings_and_quotes_in_names(spark, rows):
    df = spark.createDataFrame([FIRST + (1.5, "why", 2.0)], VISIT + ", `do_RESULTS` double, `do_COMMENTS` string, `it's a_r` double")
    assert rows(reshape.melt_results(df), "CharIDText", "Result", "Res_comment") == [("do", 1.5, "why"), ("it's a", 2.0, None)]


def test_absent_families_give_typed_empty_frames(spark):
    df = spark.createDataFrame([FIRST], VISIT)
    assert reshape.melt_metadata(df, "RsltQual").count() == 0
    assert reshape.melt_results(df).count() == 0
    assert reshape.orphan_metadata(df).count() == 0
    assert dict(reshape.melt_results(df).dtypes)["Result"] == "double"


def test_melt_metadata_and_visit_comments(spark, rows):
    df = spark.createDataFrame([FIRST + ("<", ""), (7, 2, 1, None, None, None, None, ">", "E")], VISIT + ", ph_qual string, do_QUAL string")
    assert rows(reshape.melt_metadata(df, "RsltQual")) == [
        (7, 1, "ph_qual", "ph", "<"), (7, 2, "do_QUAL", "do", "E"), (7, 2, "ph_qual", "ph", ">")]
    assert rows(reshape.visit_comments(df), "row_ID") == [(1,)]


def test_orphan_metadata(spark, rows):
    df = spark.createDataFrame([FIRST + (None, 7.0, "<", "late", "q", "z")],
                               VISIT + ", ph_r double, do_r double, ph_qual string, do_cmnt string, dod_qual string, x_ACC string")
    assert rows(reshape.orphan_metadata(df, {"ph", "do"}), "column", "value") == [("dod_qual", "q"), ("ph_qual", "<"), ("x_ACC", "z")]


def lookups(spark):
    project = spark.createDataFrame([(7, "ph", "Field", 0.5), (7, "do", "Contract Lab", 0.1), (7, "no", "Office", None),
                                     (7, None, "Field", 9.0)], "subid int, CharID string, FieldOrLab string, LOQ double")
    types = spark.createDataFrame([(149, "FM", "x"), (158, "FD", "x"), (233, "LM", "x"), (313, "LD", "x"), (None, "?", "x")],
                                  "TypeID int, TypeIDText string, TypeFilter string")
    return project, types


@pytest.mark.parametrize("batch_type, act_group", [
    (448, "7-20190601"), (449, "7-20190601-crew"), (450, "7-crew"), (451, "ERROR"), (None, "ERROR")])
def test_batch_ids(spark, batch_type, act_group):
    project, types = lookups(spark)
    subs = spark.createDataFrame([(7, batch_type, 3)], "SubID int, DupBatchType int, SubOrganizationID int")
    df = spark.createDataFrame([FIRST + (7.0,)], VISIT + ", phd_r double")
    out = identity.identify_results(reshape.melt_results(df), project, types, subs)
    row = out.first()
    assert row["act_group"] == act_group and row["actgrp_char"] == f"{act_group}-ph"
    assert row["act_id"] == "7-201906011015-10001-FD" and row["result_id"] == "7-201906011015-10001-FD-ph"
    assert row["sub_char"] == "7-ph" and "TypeFilter" not in out.columns
    assert (audits.unbatched(out).count() == 1) == (act_group == "ERROR")


def test_activity_types_and_missing_parts(spark, rows):
    project, types = lookups(spark)
    subs = spark.createDataFrame([(7, 449, 3)], "SubID int, DupBatchType int, SubOrganizationID int")
    df = spark.createDataFrame([(7, 1, None, None, None, None, None, 1.0, 2.0, 3.0, 4.0, 5.0)],
                               VISIT + ", ph_r double, phd_r double, do_r double, dod_r double, no_r double")
    out = identity.identify_results(reshape.melt_results(df, {"ph", "do", "no"}), project, types, subs)
    assert rows(out, "Char", "act_type") == [("do_r", 233), ("dod_r", 313), ("no_r", None), ("ph_r", 149), ("phd_r", 158)]
    ids = {r["Char"]: (r["act_id"], r["act_group"]) for r in out.collect()}
    assert ids["no_r"] == ("7-NA-NA-NA", "7-NA-NA") and ids["ph_r"][0] == "7-NA-NA-FM"


def test_audits(spark, rows):
    t = datetime(2019, 6, 1)
    df = spark.createDataFrame(
        [(1, 1, 5, t, "ph", "sample", 7.0), (1, 1, 5, t, "ph", "sample", 7.0), (1, 1, 5, t, "ph", "sample", 8.0),
         (1, 2, 6, None, "ph", "dup", 1.0), (1, 3, 6, None, "ph", "dup", 1.0), (2, 1, 5, t, "xx", "sample", 7.0)],
        "subid int, row_ID int, LASAR_ID int, DateTime timestamp_ntz, CharIDText string, sample_type string, Result double")
    assert audits.repeated_results(df).count() == 2
    assert audits.repeated_keys(df).count() == 3
    assert audits.repeated_results(df, across_rows=True).count() == 4
    chars = spark.createDataFrame([("ph",), (None,)], "CharIDText string")
    assert rows(audits.unknown_characteristics(df, chars), "CharIDText") == [("xx",)]
    required = spark.createDataFrame([(1, 1), (None, 1), (1, None)], "a int, b int")
    assert audits.missing_required(required, ["a"]).count() == 1
    assert audits.missing_required(required, ["a", "b"]).count() == 2


def test_one_repeated_key_holding_most_rows(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("row_ID"), F.lit(1).alias("subid"), F.lit(5).alias("LASAR_ID"),
        F.lit(None).cast("timestamp_ntz").alias("DateTime"), F.lit("ph").alias("CharIDText"), F.lit("sample").alias("sample_type"))
    assert audits.repeated_keys(df).count() == 13333 + 1


def test_unreadable_readings_are_listed(spark, rows):
    df = spark.createDataFrame([(1, 1, "<0.5", "7"), (1, 2, "0.5", " "), (1, 3, None, "n/a")], "subid int, row_ID bigint, ph_r string, do_r string")
    out = reshape.unreadable_results(df, {"ph", "do"})
    assert rows(out, "row_ID", "Char", "text") == [(1, "ph_r", "<0.5"), (3, "do_r", "n/a")]


def test_repeated_readings_are_counted_in_tasks_that_grow_with_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    spark.range(40_000).select(
        F.lit(1).alias("subid"), F.expr("id div 2 * if(id < 40, 1, 2) + if(id < 40, 0, id % 2)").alias("row_ID"), F.lit(5).alias("LASAR_ID"),
        F.lit(None).cast("timestamp_ntz").alias("DateTime"), F.lit("c1").alias("CharIDText"), F.lit("sample").alias("sample_type"),
        F.col("id").cast("double").alias("Result")).write.parquet(path)
    monkeypatch.setattr(tables, "SPREAD", 10_000)
    found = audits.repeated_keys(spark.read.parquet(path))
    assert sorted(r["Result"] for r in found.collect()) == [float(i) for i in range(40)]
    files = sum(f.stat().st_size for f in (tmp_path / "r").glob("*.parquet"))
    assert found.rdd.getNumPartitions() >= files // 10_000 > 4
