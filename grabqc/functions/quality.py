"""Precision and grade expressions."""

from pyspark.sql import functions as F


def signed_precision(calc, primary, replicate, mean):
    """Replicate against the reading before it by the named rule; NULL when there is no rule or no value.

    The logarithm of zero or less is NULL, as is a relative difference about a zero mean.
    """
    return (F.when(calc == "LogDiff", F.log10(replicate) - F.log10(primary))
            .when(calc == "AbsDiff", replicate - primary)
            .when(calc == "RPD", F.try_divide(replicate - primary, mean)))


def precision_grade(precision, limit_a, limit_b):
    """A within the first limit, B within the second, C beyond it or when it cannot be told."""
    return F.when(precision <= limit_a, "A").when(precision <= limit_b, "B").otherwise("C")


def preliminary_grade(qc_ratio, share_a, share_b, share_c):
    """Grade of a batch from its replicates: too few, all alike, or mixed."""
    return (F.when(qc_ratio < 0.1, F.concat(F.lit("QC "), (qc_ratio * 100).cast("int").cast("string"), F.lit("%")))
            .when(share_a == 1, "A")
            .when(share_b == 1, "B")
            .when(share_c == 1, "C")
            .when((share_a < 1) | (share_b < 1) | (share_c < 1), "Mixed"))


def final_grade(prelim, amb_99, sub_95, amb_95, wqs):
    """``Anom`` for an A or B with telling anomalies and for a batch with too few replicates.

    Telling are an extreme ambient value, a broken standard, or a value high or low both for its
    submission and for ambient water. A broken standard needs no second sign, so the pair of it
    with an ambient value is not a case of its own. Grades of too few replicates sort after H.
    """
    telling = (amb_99 > 0) | (wqs > 0) | ((sub_95 > 0) & (amb_95 > 0))
    return F.when(((prelim < "C") & telling) | (prelim > "H"), "Anom").otherwise(prelim)
