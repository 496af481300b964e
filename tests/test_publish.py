import os
import uuid
from datetime import datetime

import pytest
from helpers import result, results
from pyspark.sql import functions as F

from grabqc import schemas
from grabqc.functions.text import number_text, paste
from grabqc.functions.times import time_zone_id, visit_time
from grabqc.operators import identity, tables
from grabqc.operators.identity import row_key
from grabqc.operators.joins import fine_first
from grabqc.plans import catalog, workflow
from grabqc.session import scratch_path
from grabqc.sinks import publish as pub
from grabqc.sinks import reports
from grabqc.sources import template as src
from grabqc.sources import testdata as td
from grabqc.sources.tables import NotSaved, load_outputs, read_lookup, read_target, rows_of_batch, save_outputs

SF = "/root/testdata/sf0.001"


def groups(spark, names, submission=1):
    rows = spark.createDataFrame([(submission, n, "day", 311) for n in names], "submission int, ActGrpIDText string, ActGrpComment string, ActGrpTypeID int")
    return rows.withColumn("row_key", row_key("submission", "ActGrpIDText"))


def held(spark, root, table="t_ActGrp"):
    return read_target(spark, os.path.join(root, table))


def test_publishing_twice_is_refused_or_adds_nothing(spark):
    root = scratch_path(spark, "t")
    first = pub.publish(groups(spark, "abc"), root, "t_ActGrp").first()
    assert (first["batch_rows"], first["already_present"], first["loaded_rows"], first["matched_rows"], first["verified"]) == (3, 0, 3, 3, True)
    with pytest.raises(pub.AlreadyPublished):
        pub.publish(groups(spark, "abc"), root, "t_ActGrp")
    again = pub.publish(groups(spark, "abc"), root, "t_ActGrp", "new_only").first()
    assert (again["loaded_rows"], again["verified"]) == (0, True)
    half = pub.publish(groups(spark, "cde"), root, "t_ActGrp", "new_only").first()
    assert (half["already_present"], half["loaded_rows"], half["verified"]) == (1, 2, True)
    table = held(spark, root)
    assert sorted(r["ActGrpIDText"] for r in table.collect()) == list("abcde")
    assert sorted(r["ActGrpID"] for r in table.collect()) == [1, 2, 3, 4, 5]
    assert rows_of_batch(table, groups(spark, "bz"), "ActGrpIDText").count() == 1
    assert read_target(spark, os.path.join(root, "none")) is None


def test_an_empty_batch_and_a_batch_with_one_key_twice(spark):
    root = scratch_path(spark, "t")
    none = pub.publish(groups(spark, "a").where("false"), root, "t_ActGrp").first()
    assert (none["batch_rows"], none["loaded_rows"], none["verified"]) == (0, 0, True)
    with pytest.raises(pub.RepeatedKey):
        pub.publish(groups(spark, "aa"), root, "t_ActGrp")
    short = pub.publish(groups(spark, "ab"), root, "t_ActGrp", source_rows=3).first()
    assert (short["source_rows"], short["matched_rows"], short["verified"]) == (3, 2, False)


@pytest.mark.parametrize("step", ["staged t_ActGrp", "loaded t_ActGrp", "keys"])
def test_a_run_that_died_is_repeated_without_loss_or_double_rows(spark, monkeypatch, step):
    """It dies as it stages, as it loads, or between the keys and the load."""
    root = scratch_path(spark, "t")
    pub.publish(groups(spark, "ab", 7).unionByName(groups(spark, "c", 8)), root, "t_ActGrp")
    ids = {r["ActGrpIDText"]: r["ActGrpID"] for r in held(spark, root).collect()}
    batch = groups(spark, "bxy", 7).unionByName(groups(spark, "z", 9))
    write, extend = pub.write_counted, pub._extend_keys

    def dies(df, path, label, *more, **how):
        if label == step:
            raise RuntimeError("lost")
        return write(df, path, label, *more, **how)

    def dies_after_keys(*args):
        extend(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(pub, "write_counted", dies)
    if step == "keys":
        monkeypatch.setattr(pub, "_extend_keys", dies_after_keys)
    with pytest.raises(RuntimeError):
        pub.publish(batch, root, "t_ActGrp", "new_only")
    monkeypatch.undo()
    given = pub.key_map(spark, root, "t_ActGrp", [7, 8, 9]).collect()
    done = pub.publish(batch, root, "t_ActGrp", "new_only").first()
    assert (done["batch_rows"], done["already_present"], done["loaded_rows"], done["verified"]) == (4, 1, 3, True)
    rows = held(spark, root).collect()
    assert sorted((r["submission"], r["ActGrpIDText"]) for r in rows) == [(7, "a"), (7, "b"), (7, "x"), (7, "y"), (8, "c"), (9, "z")]
    assert len({r["ActGrpID"] for r in rows}) == 6
    assert all(r["ActGrpID"] == ids[r["ActGrpIDText"]] for r in rows if r["ActGrpIDText"] in ids)
    after = {tuple(r) for r in pub.key_map(spark, root, "t_ActGrp", [7, 8, 9]).collect()}
    assert {tuple(r) for r in given} <= after and len(after) == 6


def test_targets_are_read_by_partition(spark):
    root = scratch_path(spark, "t")
    for submission in (3, 4, 5):
        pub.publish(groups(spark, "ab", submission), root, "t_ActGrp")
    rows = rows_of_batch(held(spark, root), groups(spark, "a", 4), "ActGrpIDText")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(submission" in plan and "(submission" in plan and "= 4)" in plan
    assert rows.inputFiles() and rows.count() == 1
    assert pub.published(spark, root, "t_ActGrp", [4, 5]).count() == 4


def visits(spark, items):
    """Results of one station, minute and type; ``items`` are (row, sampler, value)."""
    out = results(spark, [result(row, value) for row, _, value in items])
    names = spark.createDataFrame([(row, name) for row, name, _ in items], "row_ID bigint, samplers string")
    return (out.join(names, "row_ID").withColumns({
        "act_id": F.lit("1-201906011000-100-FM"), "act_type": F.lit(149), "SubOrganizationID": F.lit(100), "result_id": F.lit("1-201906011000-100-FM-ph"),
        **{c: F.lit(None).cast("string") for c in ("SampleDepth", "SampleDepthUnit", "DEQ_Comment", "Org_Comment", "MethodSpeciation", "RsltQual", "Res_comment",
                                                    "OG_ACC", "OG_PREC", "OG_DQL", "DQLCmt")},
        "act_group": F.lit("b"), "DupBatchType": F.lit(448), "Date4group": F.lit("20190601"), "Method Short Name": F.lit("M"), "UNITS": F.lit("u"), "prelim_dql": F.lit("A"),
        "final_DQL": F.lit("A"), "anomaly_bits": F.lit(3), **{c: F.lit(1).cast("bigint") for c in ("anom_sub_95", "anom_amb_99", "anom_amb_95", "anom_WQS", "anom_BelowLOQ")}}))


def test_rows_that_share_their_text_ids_stay_apart(spark):
    final = visits(spark, [(1, "ann", 7.0), (2, "bob", 8.0), (3, "bob", 9.0)])
    lookups = {"characteristics": spark.createDataFrame([(1, "ph", "pH", 9)], "CharID int, CharIDText string, CharAbbr string, StoretUniqueID int"),
               "units": spark.createDataFrame([(1, "u")], "UnitID int, UnitIdText string"), "methods": spark.createDataFrame([(1, "M")], "MethodID int, ShortName string"),
               "types": td.types(spark), "context": td.context(spark),
               "stations": spark.createDataFrame([], "STATION_KEY bigint, StnID int, StationDes string, MLocID string, ContextID string")}
    none = spark.createDataFrame([], "subid int, row_ID bigint, CharIDText string, result_id string, prec_val double, prec_DQL string")
    root = scratch_path(spark, "t")
    out = workflow.publish_all(final, workflow.shape_tables(final, none, lookups), root).collect()
    assert [(r["target"], r["source_rows"], r["loaded_rows"], r["verified"]) for r in out] == [
        ("t_ActGrp", 1, 1, True), ("t_Activity", 2, 2, True), ("tjct_ActGrp2Act", 2, 2, True), ("t_Result", 3, 3, True),
        ("t_Anomaly", 6, 6, True), ("grabdataforreview", 3, 3, True)]
    activities = {r["ActivityID"]: r["Samplers"] for r in held(spark, root, "t_Activity").collect()}
    assert sorted((activities[r["ActivityID"]], r["Result"]) for r in held(spark, root, "t_Result").collect()) == [("ann", "7"), ("bob", "8"), ("bob", "9")]
    review = held(spark, root, "grabdataforreview")
    assert sorted(r["Result"] for r in review.collect()) == [7.0, 8.0, 9.0] and review.select("ResultID").distinct().count() == 3


def test_row_keys(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "c"), ("", "c"), ("-", "c"), ("NA", "c"), ("ab", "c")], "x string, y string")
    keys = [bytes(r["k"]) for r in df.coalesce(1).select(row_key("x", "y").alias("k")).collect()]
    assert len(keys[0]) == 16 and keys[0] == keys[-1] and len(set(keys)) == 6


def test_new_keys_are_numbered_without_gaps(spark):
    keys = spark.range(1000).repartition(7).withColumnRenamed("id", "k")
    assert sorted(r["n"] for r in pub.number_new(keys, "n", 41).collect()) == list(range(42, 1042))


def test_ids_are_dense_and_depend_on_the_key_alone(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    one = {r["key"]: r["n"] for r in pub.assign_ids(keys, "key", "n", start=7).collect()}
    two = {r["key"]: r["n"] for r in pub.assign_ids(keys.repartition(5), "key", "n", start=7).collect()}
    assert one == two and sorted(one.values()) == list(range(8, 508))


def test_whole_chain_on_the_test_tables(spark):
    final, shaped = catalog._shaped(spark, SF)
    root = scratch_path(spark, "t")
    out = {r["target"]: r for r in workflow.publish_all(final, shaped, root).collect()}
    assert list(out) == pub.PUBLISH_ORDER and all(r["verified"] for r in out.values())
    for table, columns in {"t_ActGrp": schemas.ACTIVITY_GROUP, "t_Activity": schemas.ACTIVITY, "t_Result": schemas.RESULT,
                           "tjct_ActGrp2Act": schemas.GROUP_ACTIVITY, "t_Anomaly": schemas.ANOMALY,
                           "grabdataforreview": schemas.REVIEW}.items():
        got = spark.read.parquet(os.path.join(root, table))
        key = pub.TARGET_IDS.get(table)
        assert [c for c in got.columns if c != "submission" and (c != key or c in columns)] == list(columns)
    results = spark.read.parquet(os.path.join(root, "t_Result"))
    assert results.where("ActivityID IS NULL OR ResultID IS NULL").isEmpty()
    assert results.count() == final.count()
    again = workflow.publish_all(final, shaped, root, on_existing="new_only")
    assert {r["loaded_rows"] for r in again.collect()} == {0}
    rows = workflow.export(root, shaped["t_Activity"], shaped["t_Result"], td.lookups(spark, SF))
    assert rows.columns == tables.EXCHANGE_COLUMNS and len(rows.columns) == 33 and rows.count() == final.count()


def test_exchange_text(spark):
    chars = spark.createDataFrame([(1, "pH")], "CharID int, CharAbbr string")
    empty = {n: spark.createDataFrame([], s) for n, s in {
        "units": "UnitID int, UnitIdText string", "methods": "MethodID int, ShortName string",
        "orgs": "OrgID int, OrgName string", "stations": "StnID int, MLocID string"}.items()}
    acts = spark.createDataFrame([(5, datetime(2019, 6, 1, 8, 30))], "ActivityID bigint, StartDateTime timestamp_ntz")
    acts = acts.select("ActivityID", *[(F.col(c) if c in acts.columns else F.lit(None).cast(t).alias(c)) for c, t in schemas.ACTIVITY.items()])
    data = [(5, 1, "<", "0.5", "odd", None), (5, 1, None, "2", None, "seen"), (9, 1, None, "3", "odd", "seen"), (5, 1, None, "4", None, None)]
    res = spark.createDataFrame(data, "ActivityID bigint, CharID int, RsltQual string, Result string, Org_RsltComment string, DEQ_RsltComment string")
    res = res.select([F.col(c) if c in res.columns else F.lit(None).cast(t).alias(c) for c, t in schemas.RESULT.items()])
    out = tables.exchange_rows(acts, res, chars, empty["units"], empty["methods"], empty["orgs"], empty["stations"])
    got = {r["result"]: (r["comment"], r["StartDate"], r["StartTime"], r["CharAbbr"]) for r in out.collect()}
    assert got == {"<0.5": ("odd:NA", "2019-06-01", "08:30:00", "pH"), "2": ("seen", "2019-06-01", "08:30:00", "pH"),
                   "3": ("odd:seen", None, None, "pH"), "4": (None, "2019-06-01", "08:30:00", "pH")}
    path = reports.write_exchange(out, scratch_path(spark, "x"))
    text = [r["value"] for r in spark.read.text(path).collect()]
    assert not any('""' in line or "null" in line for line in text)


@pytest.mark.parametrize("zone, summer, winter", [("UTC", 23, 23), ("America/Los_Angeles", 22, 23), ("America/Phoenix", 23, 23)])
def test_time_zone_code(spark, zone, summer, winter):
    df = spark.sql("SELECT timestamp_ntz'2019-07-01 12:00:00' AS s, timestamp_ntz'2019-12-01 12:00:00' AS w, cast(NULL AS timestamp_ntz) AS n")
    row = df.select(*[time_zone_id(F.col(c), zone).alias(c) for c in "swn"]).first()
    assert tuple(row) == (summer, winter, None)


def test_visit_time(spark):
    cases = [("2019-06-01", "10:15:30", datetime(2019, 6, 1, 10, 15, 30)), ("2019/06/01", "9:05", datetime(2019, 6, 1, 9, 5)),
             ("2019-06-01 00:00:00", "1899-12-31 10:15:00", datetime(2019, 6, 1, 10, 15)), ("2019-06-01", None, None),
             (None, "10:15", None), ("June 1", "10:15", None), ("2019-06-01", "noon", None), ("2019-02-30", "10:15", None)]
    df = spark.createDataFrame([c[:2] for c in cases], "d string, t string").coalesce(1)
    assert [r["x"] for r in df.select(visit_time(F.col("d"), F.col("t")).alias("x")).collect()] == [c[2] for c in cases]


def test_number_text(spark):
    cases = [(5.0, "5"), (0.5, "0.5"), (1e8, "100000000"), (1.25e-5, "0.0000125"), (100.0, "100"), (None, None), (1e24, "1" + "0" * 24),
             (1e-16, "0." + "0" * 15 + "1"), (-1.5e-16, "-0." + "0" * 15 + "15"), (1.2345678e7, "12345678"), (-1.234567890123e22, "-1234567890123" + "0" * 10),
             (12345678.5, "12345678.5"), (0.0, "0")]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v double").coalesce(1)
    assert [r["t"] for r in df.select(number_text(F.col("v")).alias("t")).collect()] == [t for _, t in cases]


def test_paste_writes_missing_parts(spark):
    assert spark.createDataFrame([(1, None)], "a int, b string").select(paste("-", "a", "b").alias("t")).first()["t"] == "1-NA"


def write(folder, subid, text):
    path = os.path.join(folder, f"subid={subid}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "data.csv"), "w") as f:
        f.write(text)


PREAMBLE = "Grab data,,\n,,\n\"quoted, text\nover two lines\",,\n,,\n,,\n"


def test_template_files_with_their_own_headers(spark, tmp_path, rows):
    folder = str(tmp_path / "tabs")
    write(folder, 7, PREAMBLE + "LASAR_ID,StartDate,StartTime,ph_r,ph_cmnt\n10001,2019-06-01,10:15,7.1,\"odd, but\nfine\"\n"
          ",2019-06-01,10:20,7.2,\n10002.0,2019-06-01,10:30,7.3,\n")
    write(folder, 8, PREAMBLE + "StartTime,do_r,LASAR_ID,StartDate\n08:00:30,9.5,10003,2019-07-01\n")
    out = src.read_template(spark, folder)
    assert rows(out, "subid", "row_ID", "LASAR_ID", "DateTime", "ph_r", "do_r", "ph_cmnt") == [
        (7, 1, 10001, datetime(2019, 6, 1, 10, 15), "7.1", None, "odd, but\nfine"),
        (7, 2, 10002, datetime(2019, 6, 1, 10, 30), "7.3", None, None),
        (8, 1, 10003, datetime(2019, 7, 1, 8, 0, 30), None, "9.5", None)]


def test_template_without_a_header_is_refused(spark, tmp_path):
    folder = str(tmp_path / "bad")
    write(folder, 7, PREAMBLE + "\n10001,2019-06-01,10:15\n10002,2019-06-01,10:15\n")
    with pytest.raises(ValueError, match="LASAR_ID"):
        src.read_template(spark, folder)


def test_template_with_its_header_on_another_line_is_refused(spark, tmp_path):
    folder = str(tmp_path / "late")
    write(folder, 7, PREAMBLE + "one line more,\nLASAR_ID,StartDate,StartTime,ph_r\n10001,2019-06-01,10:15,7.1\n")
    with pytest.raises(Exception, match="no column LASAR_ID in line 6"):
        src.read_template(spark, folder).collect()


def test_stations_that_cannot_be_read_are_listed(spark, tmp_path, rows):
    folder = str(tmp_path / "some")
    write(folder, 7, PREAMBLE + "LASAR_ID,StartDate,StartTime,ph_r\nA-77,2019-06-01,10:15,7.1\n10001,2019-06-01,10:16,7.2\n,2019-06-01,10:17,7.3\n")
    write(folder, 8, PREAMBLE + "LASAR_ID,StartDate,StartTime,ph_r\n10002,2019-06-01,10:15,7.4\n")
    assert rows(src.read_template(spark, folder), "subid", "row_ID", "LASAR_ID", "ph_r") == [(7, 1, 10001, "7.2"), (8, 1, 10002, "7.4")]
    assert rows(src.unreadable_stations(spark, folder), "subid", "line", "text") == [(7, 7, "A-77")]
    plan = src.read_template(spark, folder).drop("at")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1 or plan.count("Relation [_c0") <= 2


def test_project_files(spark, tmp_path, rows):
    folder = str(tmp_path / "project")
    write(folder, 7, PREAMBLE + "CharID,Limit of Quantitation,Low Level QC limit,FieldOrLab\nph,0.5,,Field\n,1,2,Lab\n")
    out = src.read_project(spark, folder)
    assert rows(out, "subid", "CharID", "LOQ", "Low_QC", "FieldOrLab") == [(7, "ph", 0.5, None, "Field")]
    assert src.listed_characteristics(out) == {"ph"}
    write(folder, 8, PREAMBLE + "CharID,Limit of Quantitation,Low Level QC limit,FieldOrLab\nph,<0.5,n/a,Field\ndo,1,,Lab\n")
    assert rows(src.unreadable_limits(spark, folder), "subid", "line", "CharID", "limit", "text") == [(8, 7, "ph", "LOQ", "<0.5"), (8, 7, "ph", "Low_QC", "n/a")]
    assert rows(src.read_project(spark, folder), "subid", "CharID", "LOQ", "Low_QC") == [(7, "ph", 0.5, None), (8, "do", 1.0, None), (8, "ph", None, None)]


def test_lookup_and_saved_outputs(spark, tmp_path, rows):
    where = str(tmp_path / "saved")
    save_outputs({"a": spark.range(3), "b": spark.range(2)}, where)
    save_outputs({"a": spark.range(4)}, where)
    back = load_outputs(spark, where, ["a", "b"])
    assert back["a"].count() == 4 and back["b"].count() == 2
    assert read_lookup(spark, where, "a", ["id"]).columns == ["id"]


def test_a_half_written_output_is_refused(spark, tmp_path, monkeypatch):
    where = str(tmp_path / "saved")
    save_outputs({"a": spark.range(3)}, where)

    def dies(*args, **how):
        raise RuntimeError("lost")

    monkeypatch.setattr("grabqc.sources.tables.write_counted", dies)
    with pytest.raises(RuntimeError):
        save_outputs({"a": spark.range(5)}, where)
    monkeypatch.undo()
    with pytest.raises(NotSaved, match="not saved to the end"):
        load_outputs(spark, where, ["a"])
    with pytest.raises(NotSaved):
        load_outputs(spark, where, ["b"])
    save_outputs({"a": spark.range(5)}, where)
    spark.range(1).write.mode("append").parquet(os.path.join(where, "a"))
    with pytest.raises(NotSaved, match="5 rows"):
        load_outputs(spark, where, ["a"])


def test_nothing_staged_is_left_over(spark, tmp_path, monkeypatch):
    for module in ("grabqc.sinks.publish", "grabqc.sources.tables"):
        monkeypatch.setattr(f"{module}.scratch_path", lambda _, label: str(tmp_path / "scratch" / f"{label}-{uuid.uuid4().hex}"))
    root = str(tmp_path / "targets")
    pub.publish(groups(spark, "ab"), root, "t_ActGrp")
    pub.publish(groups(spark, "bc"), root, "t_ActGrp", "new_only")
    assert held(spark, root).count() == 3 and os.listdir(tmp_path / "scratch") == []


def test_report_goes_to_one_folder_per_submission(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", None), (2, "y", 1.0)], "subid int, actgrp_char string, pctA double")
    path = reports.write_report(df, str(tmp_path), "batch_summary")
    assert sorted(p for p in os.listdir(path) if p.startswith("subid")) == ["subid=1", "subid=2"]
    assert "NA" in " ".join(r["value"] for r in spark.read.text(path).collect())


def test_a_target_that_is_not_there_yet(spark, tmp_path):
    assert read_target(spark, str(tmp_path / "none")) is None
    (tmp_path / "died" / "_temporary" / "0").mkdir(parents=True)
    assert read_target(spark, str(tmp_path / "died")) is None
    spark.range(3).write.parquet(str(tmp_path / "held"))
    assert read_target(spark, str(tmp_path / "held")).count() == 3


def test_a_first_batch_gets_its_ids_where_it_is_staged(spark):
    """Ids follow from the places of the staged rows, so no row is moved; with some keys known, new rows take the next ids."""
    root, stage = scratch_path(spark, "t"), scratch_path(spark, "stage")
    batch = spark.range(500).selectExpr("cast(id % 3 AS int) AS submission", "cast(id AS string) AS ActGrpIDText", "'day' AS ActGrpComment", "311 AS ActGrpTypeID")
    batch = batch.withColumn("row_key", row_key("submission", "ActGrpIDText")).repartition(5)
    assert pub.write_counted(batch, stage, "staged", "submission", placed=True) == 500
    staged = spark.read.parquet(stage)
    keyed, gathered = pub._extend_keys(staged, 500, root, "t_ActGrp", [0, 1, 2], [])
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert gathered and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert sorted(r["ActGrpID"] for r in keyed.collect()) == list(range(1, 501))
    given = pub.key_map(spark, root, "t_ActGrp", [0, 1, 2]).join(staged.select("row_key", "ActGrpIDText"), "row_key")
    assert {(r["ActGrpIDText"], r["ActGrpID"]) for r in given.collect()} == {(r["ActGrpIDText"], r["ActGrpID"]) for r in keyed.collect()}
    keyed, gathered = pub._extend_keys(staged, 500, root, "t_ActGrp", [0, 1, 2], [])
    assert not gathered and keyed.count() == 500 and pub.key_map(spark, root, "t_ActGrp", [0, 1, 2]).count() == 500


def test_a_batch_is_read_back_by_its_keys(spark, rows):
    """A published table holds more than the batch, also in the batch's submissions; a key that was never published brings no row."""
    root = scratch_path(spark, "t")
    pub.publish(groups(spark, "abc", 1).unionByName(groups(spark, "ab", 2)).unionByName(groups(spark, "a", 3)), root, "t_ActGrp")
    batch = groups(spark, "bcx", 1).unionByName(groups(spark, "a", 2)).unionByName(groups(spark, "a", 2))
    back = pub.published_batch(spark, root, "t_ActGrp", batch)
    assert rows(back, "submission", "ActGrpIDText") == [(1, "b"), (1, "c"), (2, "a")]


def test_rows_are_compared_with_those_held(spark):
    """Missing values are alike; a row held twice is seen, and one that is not held does not match."""
    frame = lambda items: spark.createDataFrame(items, "submission int, a bigint, b string")
    batch = frame([(1, 1, "x"), (1, None, "x"), (1, 2, None)])
    assert pub._compared(batch, frame([(1, 1, "x"), (1, None, "x"), (1, 2, None), (1, 9, "z")]), ["submission", "a", "b"]) == (3, False)
    assert pub._compared(batch, frame([(1, 1, "x"), (1, 1, "x"), (2, None, "x")]), ["submission", "a", "b"]) == (1, True)
    assert pub._compared(batch.where("false"), batch.where("false"), ["submission", "a", "b"]) == (0, False)


def test_a_batch_that_the_target_does_not_take(spark, tmp_path, monkeypatch):
    """The audit sees the staged rows: nothing is loaded, no id given and nothing left over."""
    for module in ("grabqc.sinks.publish", "grabqc.sources.tables"):
        monkeypatch.setattr(f"{module}.scratch_path", lambda _, label: str(tmp_path / "scratch" / f"{label}-{uuid.uuid4().hex}"))
    root = str(tmp_path / "targets")

    def odd(rows):
        return rows.where("ActGrpIDText = 'b'")

    with pytest.raises(pub.Refused, match="odd"):
        pub.publish(groups(spark, "abc"), root, "t_ActGrp", audit=odd)
    assert not os.path.exists(root) and os.listdir(tmp_path / "scratch") == []
    assert pub.publish(groups(spark, "ac"), root, "t_ActGrp", audit=odd).first()["verified"]


@pytest.mark.parametrize("lacking", ["value", "submission"])
def test_results_that_lack_required_values_are_not_published(spark, lacking):
    final = visits(spark, [(1, "ann", 7.0), (2, "bob", 8.0)])
    column, kind = ("Result", "double") if lacking == "value" else ("subid", "int")
    final = final.withColumn(column, F.when(F.col("row_ID") == 2, F.lit(None).cast(kind)).otherwise(F.col(column)))
    lookups = {"characteristics": spark.createDataFrame([(1, "ph", "pH", 9)], "CharID int, CharIDText string, CharAbbr string, StoretUniqueID int"),
               "units": spark.createDataFrame([(1, "u")], "UnitID int, UnitIdText string"), "methods": spark.createDataFrame([(1, "M")], "MethodID int, ShortName string"),
               "types": td.types(spark), "context": td.context(spark),
               "stations": spark.createDataFrame([], "STATION_KEY bigint, StnID int, StationDes string, MLocID string, ContextID string")}
    none = spark.createDataFrame([], "subid int, row_ID bigint, CharIDText string, result_id string, prec_val double, prec_DQL string")
    root = scratch_path(spark, "t")
    with pytest.raises(ValueError, match="missing_required"):
        workflow.publish_all(final, workflow.shape_tables(final, none, lookups), root)
    assert held(spark, root, "t_Result") is None and held(spark, root, "t_Activity") is not None


def test_final_results_are_stored_with_what_the_targets_read(spark):
    """Limits and batch sums stay out; with them the generated code is too long for the JVM to compile."""
    final, _ = catalog._shaped(spark, SF)
    assert set(final.columns) == {*tables.FINAL_COLUMNS, *identity.IDENTIFIERS}


def test_the_review_reads_few_columns_of_the_results(spark):
    """Results stored with their keys and the reviewed columns alone give the review of whole ones."""
    final = visits(spark, [(1, "ann", 7.0), (2, "bob", 8.0)])
    keyed = identity.with_row_keys(final).select("submission", F.col("result_key").alias("row_key"), F.col("row_ID").alias("ResultID"))
    whole = keyed.select("*", *[F.lit("5" if kind == "string" else 5).cast(kind).alias(name) for name, kind in schemas.RESULT.items() if kind != "timestamp_ntz"])
    few = whole.select("submission", "row_key", "ResultID", *tables.REVIEWED)
    reviewed = [sorted(map(tuple, tables.review_table(final, rows).collect()), key=str) for rows in (whole, few)]
    assert reviewed[0] == reviewed[1] and [r[1] for r in reviewed[0]] == [1, 2] and all(r[4] == 5 for r in reviewed[0])


def test_fine_keys_come_first():
    assert fine_first(["subid", "row_ID", "CharIDText"]) == ["row_ID", "CharIDText", "subid"]
    assert fine_first(["submission", "act_key"]) == ["act_key", "submission"]
