import pytest
from helpers import quantile
from pyspark.sql import functions as F

from grabqc.operators import anomalies as A
from grabqc.plans.oracle import RULES

LIMITS = {"LOQ": 10.0, "RealRngL": 1.0, "RealRngU": 99.0, "amb01L": 2.0, "amb05L": 3.0, "amb95U": 90.0, "amb99U": 95.0,
          "stdL": 4.0, "stdU": 80.0, "stdLlp": 3.5, "stdUlp": 85.0, "percen_5th": 11.0, "percen_10th": 12.0,
          "percen_90th": 70.0, "percen_95th": 75.0, "S_percen_5th": 10.5, "S_percen_95th": 76.0}
# flag, value that just meets its limit, value that breaks it, limit to blank
CASES = [("expected_range", 1.0, 0.99, "RealRngL"), ("expected_range", 99.0, 99.01, "RealRngU"),
         ("LOQ_anom", 9.0, 8.99, "LOQ"), ("ambient_01", 2.0, 1.99, "amb01L"), ("ambient_05", 3.0, 2.99, "amb05L"),
         ("ambient_95", 90.0, 90.01, "amb95U"), ("ambient_99", 95.0, 95.01, "amb99U"), ("WQS", 4.0, 3.99, "stdL"),
         ("WQS", 80.0, 80.01, "stdU"), ("WQS_LP", 3.5, 3.49, "stdLlp"), ("WQS_LP", 85.0, 85.01, "stdUlp"),
         ("sub_5", 11.0, 10.99, "percen_5th"), ("sub_10", 12.0, 11.99, "percen_10th"), ("sub_90", 70.0, 70.01, "percen_90th"),
         ("sub_95", 75.0, 75.01, "percen_95th"), ("station_5", 10.5, 10.49, "S_percen_5th"),
         ("station_95", 76.0, 76.01, "S_percen_95th")]


def limited(spark, rows):
    """Rows of (id, Result, blanked limit)."""
    df = spark.createDataFrame(rows, "result_id int, Result double, blank string")
    return df.withColumns({k: F.when(F.coalesce(F.col("blank"), F.lit("")) != k, F.lit(v)) for k, v in LIMITS.items()})


def test_each_rule_on_beyond_and_without_its_limit(spark):
    data = []
    for i, (_, on, beyond, limit) in enumerate(CASES):
        data += [(3 * i, on, None), (3 * i + 1, beyond, None), (3 * i + 2, beyond, limit)]
    got = {r["result_id"]: r for r in A.flag_columns(A.with_flags(limited(spark, data))).collect()}
    labels = {flag: label for flag, label, *_ in A.RULES}
    for i, (flag, *_) in enumerate(CASES):
        assert [got[3 * i + k][flag] for k in range(3)] == [None, labels[flag], None], CASES[i]


def test_codes_count_once_per_result(spark):
    flagged = A.with_flags(limited(spark, [(1, 0.5, None), (2, 50.0, None), (3, 92.0, None)]))
    got = {r["result_id"]: r for r in A.with_counts(flagged).collect()}
    raised = A.raised_anomalies(flagged).select("result_id", A.anomaly_code(F.col("Anom")).alias("code")).collect()
    for i in (1, 2, 3):
        codes = {r["code"] for r in raised if r["result_id"] == i}
        assert got[i]["num_anom"] == (len(codes) or None)
        for name, code in A.COUNT_COLUMNS.items():
            assert got[i][name] == ((code in codes) * 1 if codes else None)
    assert got[2]["num_anom"] is None and got[1]["anom_amb_99"] == 1 and got[3]["anom_WQS"] == 1


def test_fourteen_labels_map_to_eight_codes(spark):
    assert [tuple(r) for r in A.RULES] == RULES
    assert len(A.RULES) == 14 and {r[4] for r in A.RULES} == set(A.CODES) and len(A.CODES) == 8
    df = spark.createDataFrame([(label,) for _, label, *_ in A.RULES] + [("none of them",)], "Anom string")
    got = {r[0]: r[1] for r in df.select("Anom", A.anomaly_code(F.col("Anom"))).collect()}
    assert got == {label: code for _, label, _, _, code in A.RULES} | {"none of them": None}


def test_percentiles_stay_within_the_submission(spark, ranges):
    data = [(s, 100 + i % 3, "ph", float(i * s)) for s in (1, 2) for i in range(30)]
    counts = A.station_counts(spark.createDataFrame(data, "subid int, LASAR_ID int, CharIDText string, Result double"))
    for r in A.submission_percentiles(counts).collect():
        mine = [v for s, _, _, v in data if s == r["subid"]]
        assert [r[k] for k in A.SUBMISSION_PERCENTILES] == pytest.approx([quantile(mine, p) for p in A.SUBMISSION_PERCENTILES.values()])
    for r in A.station_percentiles(counts).collect():
        mine = [v for s, st, _, v in data if (s, st) == (r["subid"], r["LASAR_ID"])]
        assert [r[k] for k in A.STATION_PERCENTILES] == pytest.approx([quantile(mine, p) for p in A.STATION_PERCENTILES.values()])


def test_limits_of_few_stations_leave_the_results_where_they_are(spark, tmp_path):
    spark.range(4000).selectExpr(
        "1 AS subid", "id AS row_ID", "id % 9 AS LASAR_ID", "'ph' AS CharIDText", "double(id % 50) AS Result", "2.0D AS LOQ").write.parquet(str(tmp_path / "r"))
    res = spark.read.parquet(str(tmp_path / "r"))
    limits = spark.createDataFrame([tuple([1, 1, "ph"] + [None] * 10)], "AnomCritID int, charid int, charidText string, " + ", ".join(
        f"{c} double" for c in A.CRITERIA_COLUMNS[2:]))
    limits.write.parquet(str(tmp_path / "c"))
    limited = A.with_limits(res, spark.read.parquet(str(tmp_path / "c")), A.station_counts(res))
    assert "Exchange hashpartitioning" not in limited._jdf.queryExecution().executedPlan().toString()
    assert limited.count() == 4000 and limited.where("S_percen_95th IS NULL OR percen_5th IS NULL").isEmpty()
