"""Replicate pairs, the rule that applies to each, and the grade it earns.

A pair is a replicate of one characteristic in one template row and the reading before it: the
primary, or for a further replicate the replicate before it. Pairs carry only the columns needed
to grade; full result rows never take part.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.functions.quality import precision_grade, signed_precision
from grabqc.operators.joins import fine_first

PAIR_KEY = ["subid", "row_ID", "CharIDText"]
BATCH_KEY = ["subid", "actgrp_char"]


#: What tells the readings of a key apart: the template cell, the result's id, or both. Results have one of them at least.
CELL = ["Char", "result_id"]


def cells_of(*frames):
    """Those of ``CELL`` that all frames have."""
    return [c for c in CELL if all(c in f.columns for f in frames)]


def replicate_pairs(results):
    """One row per replicate, and one per key that has none.

    Readings of a key are ordered by class, primaries first, then by column, id and value. Ids are long; results that
    have their cell may come without, which makes pairs a good deal smaller.
    ``sample`` is the reading before the replicate; ``n_sample`` counts the key's primaries on
    its first row only, so that sums over rows count each once.
    """
    primary, replicate = F.col("sample_type") == "sample", F.col("sample_type") == "dup"
    line = Window.partitionBy(*fine_first(PAIR_KEY)).orderBy(replicate, *cells_of(results), "Result")
    # the whole key, in the same order, so that one sort serves all
    key = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.count("Result").over(key) == F.count(F.lit(1)).over(key)
    placed = results.select(*PAIR_KEY, "actgrp_char", "LASAR_ID", "DateTime", "Low_QC", "Result", "sample_type",
                            *cells_of(results)).withColumns({
        "primaries": F.count_if(primary).over(key), "replicates": F.count_if(replicate).over(key),
        "primary": F.max(F.when(primary, F.col("Result"))).over(key), "mean": F.when(whole, F.avg("Result").over(key)),
        "before": F.lag("Result").over(line), "place": F.row_number().over(line)})
    return placed.where(replicate | ((F.col("replicates") == 0) & (F.col("place") == 1))).select(
        *PAIR_KEY, *cells_of(results), "actgrp_char", "LASAR_ID", "DateTime", "Low_QC", "primary", "primaries", "mean",
        F.when(replicate, F.col("before")).otherwise(F.col("Result")).alias("sample"),
        F.when(replicate, F.col("Result")).alias("dup"),
        F.when(~replicate | (F.col("place") == F.col("primaries") + 1), F.col("primaries")).otherwise(0).alias("n_sample"),
        replicate.cast("long").alias("n_dup"), (replicate & (F.col("primaries") > 0)).alias("paired"))


def rules_by_characteristic(characteristics, criteria):
    """The precision rules of each characteristic as one short array (a lookup table)."""
    chars = characteristics.where(F.col("CharID").isNotNull() & F.col("CharIDText").isNotNull())
    rules = criteria.withColumnsRenamed({"charid": "CharID", "charidText": "CharIDText"})
    return (chars.select("CharID", "CharIDText").join(rules, ["CharID", "CharIDText"])
            .groupBy("CharIDText")
            .agg(F.sort_array(F.collect_list(F.struct("QCcalc", "DQLA", "DQLB"))).alias("rules")))


def applicable_rules(rules, value, low_limit):
    """The rules left for a primary value.

    Where several are on offer, values under the low-level limit are not judged by relative
    difference and values over it not by absolute difference. At the limit itself, or with no
    limit, the relative difference is kept, so a pair is never judged by both.
    """
    several = F.size(rules) > 1
    relative = F.exists(rules, lambda r: r["QCcalc"] == "RPD")
    below, above = F.coalesce(value < low_limit, F.lit(False)), F.coalesce(value > low_limit, F.lit(False))
    return F.filter(rules, lambda r: ~(
        several & (
            (below & (r["QCcalc"] == "RPD"))
            | (above & (r["QCcalc"] == "AbsDiff"))
            | (relative & ~below & ~above & (r["QCcalc"] == "AbsDiff")))))


def choose_rules(pairs, rules):
    """Pairs with the rule to apply: one row per remaining rule, or one with none.

    ``rule_no`` counts the rules of a pair from 0 and is NULL when it has none.
    """
    return (pairs.join(rules, "CharIDText", "left")
            .withColumn("rules", F.when(F.col("primaries") > 0, applicable_rules(
                F.col("rules"), F.col("primary"), F.col("Low_QC"))))
            .select(*pairs.columns, F.posexplode_outer("rules").alias("rule_no", "rule"))
            .select(*pairs.columns, "rule_no", "rule.*"))


def chosen_rules(pairs, rules):
    """The rule table itself: one row per primary value and rule that applies to it."""
    return (choose_rules(pairs.where(F.col("n_sample") > 0), rules)
            .select(*PAIR_KEY, "QCcalc", "DQLA", "DQLB", F.lit(1).alias("USE")))


def grade_pairs(ruled_pairs):
    """Add signed and absolute precision and the grade; NULL where the pair is incomplete."""
    paired = F.col("paired")
    signed = signed_precision(F.col("QCcalc"), F.col("sample"), F.col("dup"), F.col("mean"))
    return (ruled_pairs
            .withColumn("signed_val", F.when(paired, signed))
            .withColumn("prec_val", F.abs("signed_val"))
            .withColumn("prec_DQL", F.when(paired, precision_grade(F.col("prec_val"), F.col("DQLA"), F.col("DQLB")))))


def graded_pairs(results, characteristics, criteria):
    """All pair keys of the results with rule, precision and grade."""
    return grade_pairs(choose_rules(replicate_pairs(results), rules_by_characteristic(characteristics, criteria)))


def replicate_precision(graded):
    """Precision and grade of each replicate with a primary, under the replicate's id, its cell or both."""
    return (graded.where("paired")
            .select(*PAIR_KEY, *cells_of(graded), "QCcalc", "prec_val", "DQLA", "DQLB", "prec_DQL"))


def signed_series(graded, grade_on="signed"):
    """Precision with its sign, and the limits mirrored below zero, for control charts.

    By default the grade is read from the signed value, so every negative difference is an A;
    ``grade_on='abs'`` reads it from the absolute value instead.
    """
    if grade_on not in ("signed", "abs"):
        raise ValueError("grade_on must be 'signed' or 'abs'")
    basis = F.col("signed_val") if grade_on == "signed" else F.col("prec_val")
    return (graded.where("paired")
            .select(*PAIR_KEY, "DateTime", "QCcalc", F.col("signed_val").alias("prec_val"), "DQLA", "DQLB",
                    precision_grade(basis, F.col("DQLA"), F.col("DQLB")).alias("prec_DQL"),
                    (-F.col("DQLA")).alias("DQLA_Low"), (-F.col("DQLB")).alias("DQLB_Low")))
