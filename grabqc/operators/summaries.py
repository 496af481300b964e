"""Data summary, replicate summary, and the data behind the charts."""

from pyspark.sql import functions as F

from grabqc.operators.anomalies import STATION_KEY
from grabqc.operators.joins import join_null_safe
from grabqc.operators.percentiles import summarise_counts, value_counts
from grabqc.operators.precision import PAIR_KEY, signed_series

DATA_PERCENTILES = {"5th %": 0.05, "10th %": 0.1, "20th %": 0.2, "25th %": 0.25, "Median": 0.5,
                    "75th %": 0.75, "80th %": 0.8, "90th %": 0.9, "95th %": 0.95}
QC_PERCENTILES = {"5th %": 0.05, "10th %": 0.1, "25th %": 0.25, "Median": 0.5, "75th %": 0.75,
                  "90th %": 0.9, "95th %": 0.95}
HINGES = {"lower": 0.25, "middle": 0.5, "upper": 0.75}
ALL_STATIONS = "All"


def data_summary(counts):
    """Statistics per characteristic over all stations and per station, in one result.

    ``counts`` is the histogram by submission, station and characteristic; both levels come
    from it with grouping sets.
    """
    whole, station = ["subid", "CharIDText", "value"], ["subid", "CharIDText", "value", "LASAR_ID"]
    levels = (counts.groupingSets([whole, station], *station)
              .agg(F.sum("occurs").alias("occurs"), F.grouping("LASAR_ID").alias("all_stations"))
              .withColumn("Station", F.when(F.col("all_stations") == 1, ALL_STATIONS)
                          .otherwise(F.col("LASAR_ID").cast("string"))))
    keys = ["subid", "Station", "CharIDText"]
    stats = summarise_counts(levels.select(*keys, "value", "occurs"), keys, DATA_PERCENTILES)
    return stats.select("subid", "Station", F.col("CharIDText").alias("Characteristic"),
                        F.col("n").alias("Count"), F.col("mean").alias("Mean"), F.col("min").alias("Min"),
                        *[F.col(f"`{p}`") for p in DATA_PERCENTILES], F.col("max").alias("Max"))


def qc_summary(series):
    """Statistics of the signed precision and grade counts, per characteristic and rule.

    Missing precisions are left out of the statistics and counted in ``Count_Missing``.
    """
    keys = ["subid", "CharIDText", "QCcalc"]
    stats = summarise_counts(value_counts(series, keys, "prec_val"), keys, QC_PERCENTILES)
    grades = series.groupBy(*keys).agg(
        F.count("*").alias("Count_QC"),
        F.count_if(F.col("prec_DQL") == "A").alias("CountA"),
        F.count_if(F.col("prec_DQL") == "B").alias("CountB"),
        F.count_if(F.col("prec_val").isNull()).alias("Count_Missing"),
    ).withColumn("CountCorE", F.col("Count_QC") - F.col("CountA") - F.col("CountB"))
    return join_null_safe(grades, stats, keys).select(
        "subid", F.col("CharIDText").alias("charid"), "QCcalc", F.col("Count_QC").alias("Count"),
        F.col("mean").alias("Mean"), F.col("min").alias("Min"), *[F.col(f"`{p}`") for p in QC_PERCENTILES],
        F.col("max").alias("Max"), "CountA", "CountB", "CountCorE", "Count_QC",
        *[F.try_divide(f"Count{g}", "Count_QC").alias(f"Percent{g}") for g in ("A", "B", "CorE")],
        "Count_Missing")


def _with_fences(counts):
    hinges = summarise_counts(counts, STATION_KEY, HINGES)
    spread = 1.5 * (F.col("upper") - F.col("lower"))
    fenced = hinges.select(*STATION_KEY, "n", *HINGES, (F.col("lower") - spread).alias("low_fence"),
                           (F.col("upper") + spread).alias("high_fence"))
    return counts.join(fenced, STATION_KEY)


def box_plot_stats(counts):
    """Hinges, whiskers and number of outliers of each station and characteristic."""
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return _with_fences(counts).groupBy(*STATION_KEY).agg(
        F.max("n").alias("n"),
        F.min(F.when(inside, F.col("value"))).alias("ymin"),
        *[F.max(h).alias(h) for h in HINGES],
        F.max(F.when(inside, F.col("value"))).alias("ymax"),
        F.sum(F.when(inside, 0).otherwise(F.col("occurs"))).alias("n_outliers"),
    )


def box_plot_outliers(counts):
    """Values beyond the whiskers, with how often each occurs."""
    outside = ~F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return _with_fences(counts).where(outside).select(*STATION_KEY, "value", "occurs")


def characteristics_present(results):
    """The characteristics for which there is something to draw."""
    return results.select("subid", "CharIDText").distinct()


def control_chart_series(graded, grade_on="signed"):
    """Signed precision over time with its limits, per characteristic."""
    return signed_series(graded, grade_on)


def pair_scatter(graded):
    """Replicate against primary with the bands the limits put round the primary.

    The bands add the limit to the value whatever the rule. The batch id is what precedes the
    characteristic in the batch-and-characteristic id.
    """
    batch = F.expr("substring(actgrp_char, 1, length(actgrp_char) - length(CharIDText) - 1)").alias("act_group")
    return (graded.where("paired")
            .select(*PAIR_KEY, "LASAR_ID", "DateTime", batch, "actgrp_char",
                    F.col("signed_val").alias("prec_val"), "DQLA", "DQLB", "dup", "sample",
                    (F.col("sample") + F.col("DQLA")).alias("A_QC_U"),
                    (F.col("sample") - F.col("DQLA")).alias("A_QC_L"),
                    (F.col("sample") + F.col("DQLB")).alias("B_QC_U"),
                    (F.col("sample") - F.col("DQLB")).alias("B_QC_L")))
