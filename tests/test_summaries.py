import random

import pytest
from helpers import criteria, quantile, result, results

from grabqc.operators import anomalies, precision, summaries


@pytest.fixture(scope="module")
def values(spark):
    dice = random.Random(3)
    data = [(dice.choice([1, 2]), dice.choice([10, 10, 10, 20]), "ph", round(dice.gauss(7, 3), 1)) for _ in range(300)]
    data += [(1, 10, "ph", 400.0), (1, 10, "ph", 400.0), (1, 10, "ph", -90.0)]
    df = spark.createDataFrame(data, "subid int, LASAR_ID int, CharIDText string, Result double")
    return data, anomalies.station_counts(df).cache()


def test_data_summary_has_both_levels(values, ranges):
    data, counts = values
    rows = summaries.data_summary(counts).collect()
    assert {(r["subid"], r["Station"]) for r in rows} == {(s, t) for s in (1, 2) for t in ("All", "10", "20")}
    for r in rows:
        mine = [v for s, t, _, v in data if s == r["subid"] and r["Station"] in ("All", str(t))]
        assert (r["Count"], r["Min"], r["Max"]) == (len(mine), min(mine), max(mine))
        assert r["Mean"] == pytest.approx(sum(mine) / len(mine))
        for name, p in summaries.DATA_PERCENTILES.items():
            assert r[name] == pytest.approx(quantile(mine, p))
    assert list(rows[0].asDict())[:6] == ["subid", "Station", "Characteristic", "Count", "Mean", "Min"]


def test_box_plot(values, ranges):
    data, counts = values
    outliers = {}
    for r in summaries.box_plot_outliers(counts).collect():
        outliers.setdefault((r["subid"], r["LASAR_ID"]), []).extend([r["value"]] * r["occurs"])
    for r in summaries.box_plot_stats(counts).collect():
        mine = [v for s, t, _, v in data if (s, t) == (r["subid"], r["LASAR_ID"])]
        q1, q3 = quantile(mine, 0.25), quantile(mine, 0.75)
        inside = [v for v in mine if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        beyond = sorted(set(mine) - set(inside))
        assert (r["ymin"], r["ymax"], r["n_outliers"]) == (min(inside), max(inside), len(mine) - len(inside))
        assert (r["lower"], r["middle"], r["upper"]) == pytest.approx((q1, quantile(mine, 0.5), q3))
        assert sorted(set(outliers.get((r["subid"], r["LASAR_ID"]), []))) == beyond
    assert outliers[(1, 10)].count(400.0) == 2


@pytest.fixture(scope="module")
def graded(spark):
    items = []
    for i, (a, b) in enumerate([(10, 12), (10, 20), (50, 10), (5, 5), (0, 3)]):
        items += [result(i, a), result(i, b, "dup"), result(i, a, char="ec"), result(i, b, "dup", char="ec")]
    items += [result(90, 5, char="tb"), result(90, 5, "dup", char="tb"), result(99, 3)]
    rules = [("ph", "AbsDiff", 5.0, 15.0), ("ec", "LogDiff", 0.1, 0.2)]
    return precision.graded_pairs(results(spark, items), *criteria(spark, rules, ("ph", "ec", "tb"))).cache()


def test_qc_summary_counts_signed_grades_and_missing(graded):
    rows = {r["charid"]: r for r in summaries.qc_summary(precision.signed_series(graded)).collect()}
    ph, ec, tb = rows["ph"], rows["ec"], rows["tb"]
    assert (ph["Count"], ph["CountA"], ph["CountB"], ph["CountCorE"], ph["Count_Missing"]) == (5, 4, 1, 0, 0)
    assert (ph["Min"], ph["Max"], ph["Mean"], ph["Median"]) == (-40.0, 10.0, -5.0, 2.0)
    assert ph["PercentA"] == 0.8 and ph["Count_QC"] == 5
    assert ec["Count_Missing"] == 1 and ec["Count"] == 5 and ec["Max"] == pytest.approx(0.30103, abs=1e-5)
    assert (tb["QCcalc"], tb["Count"], tb["CountCorE"], tb["Mean"]) == (None, 1, 1, None)


def test_control_chart_and_scatter(graded, rows):
    assert summaries.control_chart_series(graded).count() == 11
    r = summaries.pair_scatter(graded).where("row_ID = 1 AND CharIDText = 'ph'").first()
    assert (r["sample"], r["dup"], r["prec_val"]) == (10.0, 20.0, 10.0)
    assert (r["A_QC_U"], r["A_QC_L"], r["B_QC_U"], r["B_QC_L"]) == (15.0, 5.0, 25.0, -5.0)
    assert rows(summaries.characteristics_present(graded)) == [(1, "ec"), (1, "ph"), (1, "tb")]
