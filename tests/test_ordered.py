import random

import pytest
from helpers import quantile
from pyspark.sql import functions as F

from grabqc.operators import ordered
from grabqc.operators.joins import join_null_safe
from grabqc.operators.percentiles import roll_up, summarise_counts, value_counts
from grabqc.sources import tables


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; values repeat, are negative, zero, small and large."""
    dice = random.Random(7)
    data = [(dice.choice(["hot"] * 8 + ["a", "b", None]), i,
             dice.choice([dice.uniform(-5, 5), float(dice.randrange(-3, 40)), dice.uniform(0, 1e6), 0.0]))
            for i in range(600)]
    return data, spark.createDataFrame(data, "k string, i int, v double").cache()


def groups_by_range(ranged, key):
    return {tuple(r) for r in ranged.select(key, ordered.RANGE).distinct().collect()}


def test_running_totals(skewed, ranges):
    data, df = skewed
    ranged = ordered.in_ranges(df, ["k"], ["i"], "t")
    out = ordered.running_totals(ranged, ["k"], ["i"], {"s": F.col("i")})
    for row in out.collect():
        mine = [i for k, i, _ in data if k == row["k"]]
        assert row["s"] == sum(i for i in mine if i <= row["i"])
        assert row["s_total"] == sum(mine)
    assert out.columns == [*df.columns, "s_total", "s"] or set(out.columns) == {*df.columns, "s", "s_total"}
    assert (len([k for k, _ in groups_by_range(ranged, "k") if k == "hot"]) > 2) == (ranges == "many ranges")


def test_neighbours(skewed, ranges):
    data, df = skewed
    out = ordered.neighbours(ordered.in_ranges(df, ["k"], ["i"], "t"), ["k"], ["i"], ["i"])
    got = {r["i"]: (r["prev"] and r["prev"]["i"], r["next"] and r["next"]["i"]) for r in out.collect()}
    assert len(got) == len(data)
    for key in {k for k, _, _ in data}:
        mine = sorted(i for k, i, _ in data if k == key)
        for at, i in enumerate(mine):
            assert got[i] == (mine[at - 1] if at else None, mine[at + 1] if at + 1 < len(mine) else None)


def test_close_values_of_one_group_take_several_ranges(spark, ranges):
    """Values between 1000 and 1001: no rule on their size could tell them apart."""
    values = [1000 + i / 4000 for i in range(4000)]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double").repartition(4)
    counts = value_counts(df, ["k"], "v")
    met = len(groups_by_range(ordered.in_ranges(counts, ["k"], ["value"], "t"), "k"))
    assert met == (1 if ranges == "one range" else 4)
    row = summarise_counts(counts, ["k"], {"p": 0.37}).first()
    assert row["n"] == 4000 and row["p"] == pytest.approx(quantile(values, 0.37), rel=1e-12)


def test_weighted_counts(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1)], "k string, v double, n int")
    assert {tuple(r) for r in value_counts(df, ["k"], "v", "n").collect()} == {("a", 1.0, 3), ("a", 2.0, 1)}


@pytest.mark.parametrize("scope", [["k"], []])
def test_dense_index(skewed, scope):
    data, df = skewed
    out = ordered.dense_index(df.withColumn("block", F.expr("i div 40")), scope, ["block"], ["i"], "n", start=10)
    groups = {}
    for r in out.collect():
        groups.setdefault(r["k"] if scope else 0, []).append((r["i"], r["n"]))
    assert sum(map(len, groups.values())) == len(data)
    for rows in groups.values():
        assert [n for _, n in sorted(rows)] == list(range(11, 11 + len(rows)))


def test_percentiles_are_exact(skewed, ranges):
    data, df = skewed
    probs = {"p5": 0.05, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0, "p0": 0.0}
    out = summarise_counts(value_counts(df, ["k"], "v"), ["k"], probs)
    rows = {r["k"]: r for r in out.collect()}
    assert len(rows) == 4
    for key, row in rows.items():
        mine = [v for k, _, v in data if k == key]
        assert row["n"] == len(mine) and row["min"] == min(mine) and row["max"] == max(mine)
        assert row["mean"] == pytest.approx(sum(mine) / len(mine))
        for name, p in probs.items():
            assert row[name] == pytest.approx(quantile(mine, p), rel=1e-12)


def test_percentiles_skip_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, v double")
    out = summarise_counts(value_counts(df, ["k"], "v"), ["k"], {"m": 0.5}).collect()
    assert [(r["k"], r["n"], r["m"]) for r in out] == [("a", 2, 2.0)]


def test_roll_up(skewed):
    _, df = skewed
    counts = value_counts(df.withColumn("half", F.col("i") % 2), ["k", "half"], "v")
    whole = {(r["k"], r["value"]): r["occurs"] for r in roll_up(counts, ["k"]).collect()}
    assert whole == {(r["k"], r["value"]): r["occurs"] for r in value_counts(df, ["k"], "v").collect()}


def test_null_safe_join(spark, rows):
    left = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    right = spark.createDataFrame([(1, "p"), (None, "q")], "k int, b string")
    assert rows(join_null_safe(left, right, ["k"])) == [(None, "y", "q"), (1, "x", "p")]
    assert join_null_safe(left, right, ["k"], "left_semi").columns == ["k", "a"]


def shuffles(df):
    """Shuffles that the plan of a frame asks for."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_whose_keys_are_there_are_shuffled_once(spark, tmp_path):
    """Besides the rows, only what is carried from part to part is shuffled: its sums, and these by group."""
    rows = spark.range(200).select(F.expr("id % 3").alias("k"), F.col("id").alias("i"))
    ranged = ordered.in_ranges(rows, ["k"], ["i"], "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for call in (lambda n: ordered.running_totals(ranged, ["k"], ["i"], {"s": F.col("i")}, nullable=n),
                 lambda n: ordered.neighbours(ranged, ["k"], ["i"], ["i"], nullable=n)):
        some, none = call(None), call([])
        assert sorted(map(str, some.collect())) == sorted(map(str, none.collect()))
        assert shuffles(call([])) < shuffles(call(None))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tasks_grow_with_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    spark.range(50_000).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "r").glob("*.parquet"))
    monkeypatch.setattr(tables, "SPREAD", size // 40)
    spread = tables.spread(spark.read.parquet(path), "id")
    assert 40 <= spread.rdd.getNumPartitions() <= 42 and spread.count() == 50_000
    monkeypatch.setattr(tables, "SPREAD", 2 * size)
    assert tables.spread(spark.read.parquet(path), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
