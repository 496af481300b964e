"""One submission, batch and station holding most rows, on the many-task paths."""

from pyspark.sql import functions as F

from grabqc.operators import anomalies as A
from grabqc.operators import grading as G
from grabqc.operators import ordered
from grabqc.operators import precision as P

ROWS = 60_000


def skewed(spark):
    """Two thirds of the readings in one batch; half of the readings are replicated."""
    base = spark.range(ROWS).withColumns({
        "hot": F.col("id") % 3 > 0, "row_ID": F.col("id"), "CharIDText": F.lit("c1"), "result_id": F.col("id").cast("string")})
    base = base.withColumns({
        "subid": F.when(F.col("hot"), 1).otherwise((F.col("id") % 7 + 2).cast("int")),
        "actgrp_char": F.when(F.col("hot"), "b-c1").otherwise(F.concat(F.lit("b"), (F.col("id") % 700).cast("string"))),
        "LASAR_ID": F.when(F.col("hot"), F.lit(1).cast("bigint")).otherwise(F.col("id") % 50),
        "DateTime": F.expr("timestampadd(SECOND, cast(id * 37 % 5000000 AS int), timestamp_ntz'2019-01-01 00:00:00')"),
        "Low_QC": F.lit(None).cast("double"), "LOQ": F.lit(2.0)})
    kinds = F.explode(F.when(F.col("id") % 2 == 0, F.array(F.lit("sample"), F.lit("dup"))).otherwise(F.array(F.lit("sample"))))
    return base.withColumn("sample_type", kinds).withColumn(
        "Result", F.expr("20.0D + id % 30 + if(sample_type = 'dup', id * 13 % 23, 0)")).drop("id", "hot")


def test_a_hot_batch_and_a_hot_hour_take_several_tasks(spark, tmp_path):
    """Two thirds of the readings in one batch, and half of these within one hour."""
    hour = F.expr("timestampadd(SECOND, cast(row_ID % 3600 AS int), timestamp_ntz'2019-02-01 00:00:00')")
    rows = skewed(spark).withColumn("DateTime", F.when(F.col("row_ID") % 6 < 4, hour).otherwise(F.col("DateTime")))
    rows.write.parquet(str(tmp_path / "r"))
    res = spark.read.parquet(str(tmp_path / "r"))
    chars = spark.createDataFrame([(1, "c1")], "CharID int, CharIDText string")
    crit = spark.createDataFrame([(1, "c1", "AbsDiff", 5.0, 15.0)], "charid int, charidText string, QCcalc string, DQLA double, DQLB double")
    P.graded_pairs(res, chars, crit).write.parquet(str(tmp_path / "g"))
    graded = spark.read.parquet(str(tmp_path / "g"))
    batch_rows = G.batches(graded)
    out = {}
    for few in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", few)
        windows = G.qc_applicability(graded, batch_rows)
        final = G.grade_results(res, graded, batch_rows, G.interval_grades(G.covering_windows(graded, batch_rows, windows)))
        out[few] = final.groupBy("subid", "actgrp_char", "prelim_dql").agg(
            F.count("*").alias("n"), F.sum("row_ID").alias("ids")).orderBy("subid", "actgrp_char", "prelim_dql").collect()
    qc = graded.where("n_dup > 0 AND actgrp_char = 'b-c1'")
    hot = ordered.in_ranges(qc, P.BATCH_KEY, ["DateTime", "row_ID"], "t").where("DateTime < timestamp_ntz'2019-02-01 01:00:00' AND DateTime >= timestamp_ntz'2019-02-01 00:00:00'")
    sizes = [r["count"] for r in hot.groupBy(ordered.RANGE).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out["true"] == out["false"]
    assert sum(r["n"] for r in out["true"]) == res.count()
    assert {r["prelim_dql"] for r in out["true"] if r["actgrp_char"] == "b-c1"} == {"A", "B", "C"}
    assert len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)


def test_hot_station_percentiles_are_the_same_in_many_ranges(spark):
    counts = A.station_counts(skewed(spark)).cache()
    for summary in (A.submission_percentiles, A.station_percentiles):
        one = sorted(summary(counts).collect())
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert sorted(summary(counts).collect()) == one
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
