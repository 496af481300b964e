"""The steps a user runs: format, grade, summarise, shape, publish, export.

Each takes frames and returns frames by name. Every step works on any number of submissions.
"""

from functools import reduce

from pyspark.sql import functions as F

from grabqc.operators import anomalies, audits, grading, identity, precision, reshape, summaries, tables
from grabqc.sinks import reports
from grabqc.sinks.publish import key_map, publish, published, published_batch
from grabqc.sources.tables import materialise, submissions_of


def format_data(template, project, types, submissions, characteristics, known=None):
    """Wide template to identified long results, with the audits that must be empty."""
    res = identity.identify_results(reshape.melt_results(template, known), project, types, submissions)
    return {
        "res": res,
        "bad_batch": audits.unbatched(res),
        "redundant_result": audits.repeated_results(res),
        "redundant_act_char": audits.repeated_keys(res),
        "name_check": audits.unknown_characteristics(res, characteristics),
        "orphan_metadata": reshape.orphan_metadata(template, known),
    }


def grade(res, characteristics, criteria, anomaly_criteria, overlaps="worst"):
    """Long results to final grades.

    ``res`` should be a stored table: it is scanned a few times, each with few columns, but
    joined whole only twice. Pairs, batches and the value histogram are stored once and read
    by the rest. With ``overlaps='all'`` a result has one row per grade of the periods that cover it, and
    counts as often as ``periods`` says, once where none does.
    """
    graded = materialise(precision.graded_pairs(res, characteristics, criteria), "pairs")
    batch_rows = materialise(grading.batches(graded), "batches")
    windows = materialise(grading.qc_applicability(graded, batch_rows), "periods")
    covered = grading.covering_windows(graded, batch_rows, windows)
    with_grade = grading.grade_results(res, graded, batch_rows, grading.interval_grades(covered, overlaps))
    counted = res if overlaps == "worst" else with_grade.withColumn("times", F.greatest("periods", F.lit(1)))
    counts = materialise(anomalies.station_counts(counted, None if overlaps == "worst" else "times"), "values")
    return {
        "graded_pairs": graded,
        "prec_grade": precision.replicate_precision(graded),
        "batch_summary": grading.batch_summary(batch_rows),
        "qc_applicability": windows,
        "value_counts": counts,
        "final_DQL": anomalies.flag_results(with_grade, anomaly_criteria, counts),
    }


def summarise(graded, counts):
    """Report and chart data, from the graded pairs and the value histogram."""
    series = precision.signed_series(graded)
    return {
        "data_summary": summaries.data_summary(counts),
        "qc_summary": summaries.qc_summary(series),
        "box_plot_stats": summaries.box_plot_stats(counts),
        "box_plot_outliers": summaries.box_plot_outliers(counts),
        "control_chart_series": series,
        "pair_scatter": summaries.pair_scatter(graded),
    }


def write_reports(outputs, directory):
    return {name: reports.write_report(outputs[name], directory, name) for name in reports.REPORTS if name in outputs}


def shape_tables(final, prec_grade, lookups, zone="UTC"):
    """The four tables that do not need published ids, with the keys of their rows."""
    return {
        "t_ActGrp": tables.activity_group_table(final, keyed=True),
        "t_Activity": tables.activity_table(final, lookups["stations"], lookups["context"], zone, keyed=True),
        "t_Result": tables.result_table(final, lookups["characteristics"], lookups["units"], lookups["methods"],
                                        prec_grade, keyed=True),
        "t_Anomaly": tables.anomaly_table(anomalies.raised_anomalies(final), lookups["types"], keyed=True),
    }


def source_counts(final):
    """How many rows each target should get, counted on the final results themselves.

    Results are brought to one row per batch and activity first; all counts follow from those.
    """
    pairs = materialise(identity.with_row_keys(final).groupBy("submission", "group_key", "act_key").agg(
        F.count("*").alias("results"), F.sum(F.bit_count(anomalies.BITS)).alias("anomalies")), "source")
    total = pairs.agg(F.count("*").alias("pairs"), F.sum("results").alias("results"), F.sum("anomalies").alias("anomalies")).first()
    kinds = {key: pairs.select("submission", key).distinct().count() for key in ("group_key", "act_key")}
    return {"t_ActGrp": kinds["group_key"], "t_Activity": kinds["act_key"], "tjct_ActGrp2Act": total["pairs"],
            "t_Result": total["results"] or 0, "t_Anomaly": total["anomalies"] or 0, "grabdataforreview": total["results"] or 0}


def publish_all(final, shaped, root, on_existing="refuse"):
    """Publish the six targets in order of dependence; one reconciliation row for each.

    Ids given to one target are read back by row key for the next, from the batch's partitions only.
    """
    spark, due = final.sparkSession, source_counts(final)
    submissions = submissions_of(final.select(F.col("subid").alias("submission")))

    def load(table, rows, audit=None):
        return publish(rows, root, table, on_existing, due[table], audit)

    def ids(table):
        return key_map(spark, root, table, submissions)

    done = [load("t_ActGrp", shaped["t_ActGrp"]), load("t_Activity", shaped["t_Activity"])]
    done.append(load("tjct_ActGrp2Act", tables.group_activity_table(final, ids("t_Activity"), ids("t_ActGrp"))))
    if not final.where(F.col("subid").isNull()).isEmpty():
        raise ValueError("results lack required values; see audits.missing_required")  # without a submission there is no activity
    done.append(load("t_Result", tables.with_activity_ids(shaped["t_Result"], ids("t_Activity")), audits.missing_required))
    done.append(load("t_Anomaly", tables.with_result_ids(shaped["t_Anomaly"], ids("t_Result"))))
    done.append(load("grabdataforreview", tables.review_table(final, published(spark, root, "t_Result", submissions))))
    return reduce(lambda a, b: a.unionByName(b), done)


def export(root, batch_activities, batch_results, lookups):
    """Exchange rows of one batch, from what is published now (after review).

    Only the batch's partitions of the targets are read.
    """
    spark = batch_results.sparkSession
    return tables.exchange_rows(
        published_batch(spark, root, "t_Activity", batch_activities), published_batch(spark, root, "t_Result", batch_results),
        lookups["characteristics"], lookups["units"], lookups["methods"], lookups["organisations"], lookups["stations"])
