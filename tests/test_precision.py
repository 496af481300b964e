import math

import pytest
from helpers import RESULT_SCHEMA, criteria, result, results

from grabqc.operators import precision as P


def graded(spark, items, rules, chars=("ph",)):
    return P.graded_pairs(results(spark, items), *criteria(spark, rules, chars))


def test_each_replicate_is_held_against_the_reading_before_it(spark, rows):
    items = [result(1, 10), result(1, 30, "dup"), result(1, 11, "dup"), result(2, 5, "dup"), result(2, 6, "dup")]
    out = graded(spark, items, [("ph", "AbsDiff", 1.0, 15.0)])
    assert rows(P.replicate_precision(out), "row_ID", "prec_val", "prec_DQL") == [(1, 1.0, "A"), (1, 19.0, "C")]
    assert rows(out, "row_ID", "n_sample", "n_dup") == [(1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 0, 1)]


def test_precision_value_of_each_rule(spark):
    cases = [("AbsDiff", 10, 13, 3.0), ("AbsDiff", 13, 10, 3.0), ("RPD", 10, 30, 1.0), ("RPD", 30, 10, 1.0),
             ("LogDiff", 10, 1000, 2.0), ("LogDiff", 0, 10, None), ("RPD", -5, 5, None), ("Other", 1, 2, None)]
    chars = [f"c{i}" for i in range(len(cases))]
    items = [r for c, (_, a, b, _) in zip(chars, cases) for r in (result(1, a, char=c), result(1, b, "dup", char=c))]
    out = graded(spark, items, [(c, case[0], 0.5, 2.0) for c, case in zip(chars, cases)], chars)
    got = {r["CharIDText"]: r for r in P.replicate_precision(out).collect()}
    for c, (*_, expected) in zip(chars, cases):
        if expected is None:
            assert (got[c]["prec_val"], got[c]["prec_DQL"]) == (None, "C")
        else:
            assert math.isclose(got[c]["prec_val"], expected)


def test_grade_limits_are_inclusive(spark):
    cases = [(10, "A"), (15, "A"), (15.01, "B"), (25, "B"), (25.01, "C"), (5, "A")]
    items = [r for i, (v, _) in enumerate(cases) for r in (result(i, 10), result(i, v, "dup"))]
    out = P.replicate_precision(graded(spark, items, [("ph", "AbsDiff", 5.0, 15.0)]))
    assert [r["prec_DQL"] for r in out.orderBy("row_ID").collect()] == [g for _, g in cases]


def test_missing_rule_and_missing_threshold_grade_c(spark, rows):
    items = [result(1, 10), result(1, 10, "dup"), result(2, 10, char="do"), result(2, 10, "dup", char="do")]
    out = graded(spark, items, [("do", "AbsDiff", None, None)], ("ph", "do"))
    assert rows(P.replicate_precision(out), "CharIDText", "QCcalc", "prec_DQL") == [("do", "AbsDiff", "C"), ("ph", None, "C")]


def test_level_chooses_between_difference_rules(spark):
    cases = [(19, 20.0, "AbsDiff"), (20, 20.0, "RPD"), (21, 20.0, "RPD"), (5, None, "RPD")]
    items = [r for i, (v, low, _) in enumerate(cases) for r in (result(i, v, low=low), result(i, v, "dup", low=low))]
    rules = [("ph", "RPD", 0.1, 0.2), ("ph", "AbsDiff", 1.0, 2.0)]
    out = P.replicate_precision(graded(spark, items, rules))
    assert [r["QCcalc"] for r in out.orderBy("row_ID").collect()] == [c for *_, c in cases]
    chosen = P.chosen_rules(P.replicate_pairs(results(spark, items)), P.rules_by_characteristic(*criteria(spark, rules)))
    assert [r["QCcalc"] for r in chosen.orderBy("row_ID").collect()] == [c for *_, c in cases]


def test_single_rule_is_used_at_any_level(spark):
    out = graded(spark, [result(1, 1, low=20.0), result(1, 1, "dup", low=20.0)], [("ph", "RPD", 0.1, 0.2)])
    assert P.replicate_precision(out).first()["QCcalc"] == "RPD"


def test_two_rules_that_do_not_exclude_each_other_both_grade(spark, rows):
    out = graded(spark, [result(1, 100, low=20.0), result(1, 101, "dup", low=20.0)],
                 [("ph", "RPD", 0.1, 0.2), ("ph", "LogDiff", 0.0, 0.001)])
    assert rows(P.replicate_precision(out), "QCcalc", "prec_DQL") == [("LogDiff", "C"), ("RPD", "A")]


def test_unpaired_readings_have_no_grade(spark, rows):
    out = graded(spark, [result(1, 10), result(2, 10, "dup")], [("ph", "AbsDiff", 5.0, 15.0)])
    assert rows(out, "row_ID", "n_sample", "n_dup", "prec_DQL") == [(1, 1, 0, None), (2, 0, 1, None)]
    assert P.replicate_precision(out).count() == 0


def test_signed_series_grades_on_sign_or_size(spark):
    out = graded(spark, [result(1, 50), result(1, 10, "dup")], [("ph", "AbsDiff", 5.0, 15.0)])
    signed = P.signed_series(out).first()
    assert (signed["prec_val"], signed["prec_DQL"], signed["DQLA_Low"], signed["DQLB_Low"]) == (-40.0, "A", -5.0, -15.0)
    assert P.signed_series(out, grade_on="abs").first()["prec_DQL"] == "C"
    with pytest.raises(ValueError):
        P.signed_series(out, grade_on="other")


def test_pairs_of_results_without_ids_are_the_same(spark):
    """The template cell tells readings apart where there is no id."""
    rows = [r + (f"c{i}",) for i, r in enumerate([result(1, 5), result(1, 9, "dup"), result(1, 12, "dup"), result(2, 7)])]
    res = spark.createDataFrame(rows, RESULT_SCHEMA + ", Char string")
    tables_ = criteria(spark, [("ph", "AbsDiff", 5.0, 15.0)])
    own, without = P.graded_pairs(res, *tables_), P.graded_pairs(res.drop("result_id"), *tables_)
    assert "result_id" not in without.columns and "result_id" in own.columns
    assert sorted(map(str, own.drop("result_id").collect())) == sorted(map(str, without.collect()))
    assert P.replicate_precision(without).count() == 2
