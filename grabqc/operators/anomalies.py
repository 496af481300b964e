"""Anomaly flags of each result, their codes and counts, and the final grade.

Codes and counts of a result depend on that result's own row alone, so they are computed as
columns: nothing is melted, made distinct, regrouped and joined back.
"""

from pyspark.sql import functions as F

from grabqc.functions.quality import final_grade
from grabqc.operators.percentiles import roll_up, summarise_counts, value_counts
from grabqc.sources.tables import materialise

SUBMISSION_PERCENTILES = {"percen_5th": 0.05, "percen_10th": 0.10, "percen_90th": 0.90, "percen_95th": 0.95}
STATION_PERCENTILES = {"S_percen_5th": 0.05, "S_percen_95th": 0.95}
SUBMISSION_KEY = ["subid", "CharIDText"]
STATION_KEY = ["subid", "LASAR_ID", "CharIDText"]
CRITERIA_COLUMNS = ["AnomCritID", "charid", "RealRngL", "RealRngU", "amb01L", "amb05L", "amb95U", "amb99U",
                    "stdL", "stdU", "stdLlp", "stdUlp"]

# The flag, its label, the limit it must fall under, the limit it must exceed,
# and the code it counts towards.
RULES = [
    ("expected_range", "OutOfRange", "RealRngL", "RealRngU", "outofrange"),
    ("LOQ_anom", "BelowLOQ", "LOQ_limit", None, "BelowLOQ"),
    ("ambient_01", "Lowest1%AmbientValues", "amb01L", None, "ambient_99"),
    ("ambient_05", "Lowest5%AmbientValues", "amb05L", None, "ambient_95"),
    ("ambient_95", "Highest95%AmbientValues", None, "amb95U", "ambient_95"),
    ("ambient_99", "Highest99%AmbientValues", None, "amb99U", "ambient_99"),
    ("WQS", "ViolatesWQStandard", "stdL", "stdU", "ViolateWQS"),
    ("WQS_LP", "ViolatesLessProtectiveWQStandard", "stdLlp", "stdUlp", "ViolateWQS"),
    ("sub_5", "Lowest5%SubmValues", "percen_5th", None, "submit_95"),
    ("sub_10", "Lowest10%SubmValues", "percen_10th", None, "submit_90"),
    ("sub_90", "Highest90%SubmValues", None, "percen_90th", "submit_90"),
    ("sub_95", "Highest95%SubmValues", None, "percen_95th", "submit_95"),
    ("station_5", "Lowest5%SubmStnValues", "S_percen_5th", None, "station_95"),
    ("station_95", "Highest95%SubmStnValues", None, "S_percen_95th", "station_95"),
]
CODES = ["ambient_99", "submit_95", "submit_90", "station_95", "ambient_95", "outofrange", "BelowLOQ", "ViolateWQS"]
# Count columns kept per result, by code.
COUNT_COLUMNS = {"anom_sub_95": "submit_95", "anom_amb_99": "ambient_99", "anom_amb_95": "ambient_95",
                 "anom_WQS": "ViolateWQS", "anom_BelowLOQ": "BelowLOQ"}


def station_counts(results, times=None):
    """Histogram of results by submission, station and characteristic; one read serves all."""
    return value_counts(results, STATION_KEY, "Result", times)


def submission_percentiles(counts):
    """Percentiles of each characteristic within its submission."""
    return (summarise_counts(roll_up(counts, SUBMISSION_KEY), SUBMISSION_KEY, SUBMISSION_PERCENTILES)
            .select(*SUBMISSION_KEY, *SUBMISSION_PERCENTILES))


def station_percentiles(counts):
    """Percentiles of each station and characteristic within its submission."""
    return (summarise_counts(counts, STATION_KEY, STATION_PERCENTILES)
            .select(*STATION_KEY, *STATION_PERCENTILES))


def with_limits(results, criteria, counts):
    """Attach fixed criteria and both kinds of percentiles.

    The two percentile tables meet first and are stored, so their size is known when the results are joined to
    them: few stations are broadcast, and the results then stay where they are. The criteria are a lookup.
    """
    observed = materialise(station_percentiles(counts).join(
        submission_percentiles(counts), SUBMISSION_KEY, "left"), "limits")
    fixed = criteria.where(F.col("charidText").isNotNull()).select(F.col("charidText").alias("CharIDText"), *CRITERIA_COLUMNS)
    return results.join(observed, STATION_KEY, "left").join(fixed, "CharIDText", "left")


BITS = "anomaly_bits"


def _bit(i):
    return 1 << i


def _code_bits(code):
    return sum(_bit(i) for i, rule in enumerate(RULES) if rule[4] == code)


def with_flags(limited):
    """Add the raised flags as one integer, a bit for each rule in the order of ``RULES``.

    A missing limit raises nothing. One integer instead of fourteen labels keeps the rows
    narrow and the generated code small enough for the JVM to compile.
    """
    def test(low, high):
        return " OR ".join(([f"Result < {low}"] if low else []) + ([f"Result > {high}"] if high else []))

    bits = " + ".join(f"if({test(low, high)}, {_bit(i)}, 0)" for i, (_, _, low, high, _) in enumerate(RULES))
    return limited.withColumn("LOQ_limit", F.expr("LOQ - LOQ * 0.1D")).withColumn(BITS, F.expr(bits)).drop("LOQ_limit")


def flag_columns(flagged):
    """The flags as fourteen columns: the label where the rule is broken, else NULL."""
    return flagged.select("*", *[F.expr(f"if({BITS} & {_bit(i)} <> 0, '{label}', NULL) AS {flag}")
                                 for i, (flag, label, *_) in enumerate(RULES)])


def raised_anomalies(flagged):
    """One row per result and raised flag."""
    rules = ", ".join(f"named_struct('bit', {_bit(i)}, 'Anom_type', '{flag}', 'Anom', '{label}')"
                      for i, (flag, label, *_) in enumerate(RULES))
    return (flagged.where(F.col(BITS) != 0)
            .select("*", F.expr(f"inline(array({rules}))"))
            .where(F.expr(f"{BITS} & bit <> 0")).drop("bit"))


def anomaly_code(label):
    """Code of an anomaly label; NULL for a label that is none of the fourteen."""
    case = F
    for _, text, _, _, code in RULES:
        case = case.when(label == text, code)
    return case


def with_counts(flagged):
    """Add the number of distinct codes of each result and an indicator for five of them.

    All are NULL for a result with no anomaly.
    """
    total = " + ".join(f"if({BITS} & {_code_bits(code)} <> 0, 1L, 0L)" for code in CODES)
    return flagged.select(
        "*", F.expr(f"if({BITS} <> 0, {total}, NULL) AS num_anom"),
        *[F.expr(f"if({BITS} <> 0, if({BITS} & {_code_bits(code)} <> 0, 1L, 0L), NULL) AS {name}")
          for name, code in COUNT_COLUMNS.items()])


def finalise(counted):
    """Add the final grade and an empty review comment."""
    return counted.withColumns({"final_DQL": final_grade(
        F.col("prelim_dql"), F.col("anom_amb_99"), F.col("anom_sub_95"), F.col("anom_amb_95"), F.col("anom_WQS"),
    ), "DQLCmt": F.lit("")})


def flag_results(graded_results, criteria, counts):
    """Graded results with limits, flags, counts and final grade, in one pass over them."""
    return finalise(with_counts(with_flags(with_limits(graded_results, criteria, counts))))
