"""Registered queries: each operator run over the whole test tables."""

import os
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from grabqc.functions.times import day_stamp, minute_stamp
from grabqc.operators import anomalies, audits, grading, identity, precision, reshape, summaries, tables
from grabqc.operators.precision import BATCH_KEY, PAIR_KEY
from grabqc.plans import workflow
from grabqc.session import scratch_path
from grabqc.sinks import reports
from grabqc.sinks.publish import assign_ids, key_map, publish, published
from grabqc.sources import template as template_source
from grabqc.sources import testdata as td
from grabqc.sources.tables import load_outputs, materialise, read_lookup, read_target, rows_of_batch, save_outputs, submissions_of

KNOWN = {f"c{i}" for i in range(1, td.CHARACTERISTICS + 1)}
DIGITS = 6


def plain(df, *optional):
    """Values that print alike in any engine.

    Doubles are rounded to six decimals, times are written as text, and so are the named
    integer columns that hold missing values.
    """
    changed = {}
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            changed[field.name] = F.round(column, DIGITS)
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            changed[field.name] = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif field.name in optional:
            changed[field.name] = column.cast("string")
    return df.withColumns(changed) if changed else df


def spelled(df, *columns):
    """The named columns as text, blank where there is no value: for columns that may hold nothing at all."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns})


def _graded_pairs(spark, sf_dir, res=None, several=False):
    res = td.results(spark, sf_dir) if res is None else res
    return precision.graded_pairs(res, td.characteristics(spark), td.precision_criteria(spark, several))


GRADED_COLUMNS = [*PAIR_KEY, "Char", "sample_type", "actgrp_char", "LASAR_ID", "DateTime", "Low_QC", "result_id", "Result"]


def _batches(spark, sf_dir):
    """The columns of the results that grading reads, stored once, their graded pairs and batches."""
    res = materialise(td.results(spark, sf_dir).select(*GRADED_COLUMNS), "results")
    graded = materialise(_graded_pairs(spark, sf_dir, res), "pairs")
    return res, graded, materialise(grading.batches(graded), "batches")


def _grade(spark, sf_dir):
    """Grades of the results, which are stored and shuffled without the identifiers that follow from their other columns."""
    res = identity.with_identifiers(materialise(td.plain_results(spark, sf_dir), "results")).drop("result_id")
    graded = workflow.grade(res, td.characteristics(spark), td.precision_criteria(spark), td.anomaly_criteria(spark))
    return graded | {"final_DQL": identity.with_identifiers(graded["final_DQL"])}


def _counts(spark, sf_dir):
    return anomalies.station_counts(td.results(spark, sf_dir))


# Template, identifiers and audits

def template_melt_results(spark, sf_dir):
    return plain(reshape.melt_results(td.template(spark, sf_dir), KNOWN)
                 .select("subid", "row_ID", "LASAR_ID", "DateTime", "Char", "CharIDText", "sample_type", "Result"))


def template_metadata_join(spark, sf_dir):
    return (reshape.melt_results(td.template(spark, sf_dir), KNOWN)
            .select("subid", "row_ID", "Char", *reshape.METADATA_SUFFIXES, "Org_Comment", "DEQ_Comment"))


def template_metadata_long(spark, sf_dir):
    return reshape.melt_all_metadata(td.template(spark, sf_dir))


def template_visit_comments(spark, sf_dir):
    return reshape.visit_comments(td.visits(spark, sf_dir))


def row_numbering(spark, sf_dir):
    rows = td.visits(spark, sf_dir).select(
        "subid", F.col("row_ID").alias("entry"),
        F.when(F.col("row_ID") % 11 != 0, F.col("LASAR_ID")).alias("LASAR_ID"))
    blocks = rows.withColumn("block", F.expr("entry div 10000"))
    return template_source.number_rows(blocks, ["block"], ["entry"]).drop("block")


def sample_timestamp(spark, sf_dir):
    key, at = F.col("row_ID"), F.col("DateTime")
    clock = (F.when(key % 7 == 0, F.lit(None).cast("string"))
             .when(key % 4 == 0, F.date_format(at, "HH:mm"))
             .when(key % 4 == 1, F.concat(F.lit("1899-12-31 "), F.date_format(at, "HH:mm:ss")))
             .otherwise(F.date_format(at, "HH:mm:ss")))
    day = F.when(key % 4 == 2, F.date_format(at, "yyyy/MM/dd")).otherwise(F.date_format(at, "yyyy-MM-dd"))
    rows = td.visits(spark, sf_dir).select("row_ID", day.alias("StartDate"), clock.alias("StartTime"))
    rows = template_source.with_visit_time(rows)
    return plain(rows.withColumns({"Date4Id": minute_stamp(F.col("DateTime")), "Date4group": day_stamp(F.col("DateTime"))}))


def _identified(spark, sf_dir):
    melted = reshape.melt_results(td.template(spark, sf_dir), KNOWN)
    return identity.identify_results(melted, td.project(spark, sf_dir), td.types(spark),
                                     td.submissions(spark, sf_dir, gaps=True))


def identifiers(spark, sf_dir):
    return plain(_identified(spark, sf_dir).select(
        "subid", "row_ID", "Char", "act_type", "DupBatchType", "LOQ", "Low_QC", "act_id", "act_group", "result_id",
        "sub_char", "actgrp_char"), "DupBatchType")


def audit_unbatched(spark, sf_dir):
    return audits.unbatched(_identified(spark, sf_dir)).select("subid", "row_ID", "Char", "Result", "actgrp_char")


def audit_repeat_results(spark, sf_dir):
    return plain(audits.repeated_results(td.raw_readings(spark, sf_dir)))


def audit_repeat_keys(spark, sf_dir):
    return plain(audits.repeated_keys(td.raw_readings(spark, sf_dir)))


def audit_repeat_keys_across_rows(spark, sf_dir):
    """Some visits are entered a second time, in a row of their own."""
    raw = td.raw_readings(spark, sf_dir)
    again = raw.where(F.col("row_ID") % 16 == 0).withColumn("row_ID", F.col("row_ID") + td.NEXT_VISIT)
    return plain(audits.repeated_keys(raw.unionByName(again), across_rows=True))


def audit_unreadable(spark, sf_dir):
    reading = F.when(F.col("row_ID") % 13 == 0, F.concat(F.lit("<"), F.col("c1_r").cast("string"))).otherwise(F.col("c1_r").cast("string"))
    return reshape.unreadable_results(td.template(spark, sf_dir).withColumn("c1_r", reading), KNOWN).select(
        "subid", "row_ID", "Char", "CharIDText", "text")


def audit_unknown_char(spark, sf_dir):
    known = td.characteristics(spark).where(F.col("CharIDText") != "c7")
    return audits.unknown_characteristics(td.results(spark, sf_dir), known).select(
        "subid", "row_ID", "Char", "CharIDText", "Result")


def audit_required_nulls(spark, sf_dir):
    res = materialise(td.results(spark, sf_dir), "results").withColumn("final_DQL", F.lit(None).cast("string"))
    none = spark.range(0).select(F.lit(0).alias("subid"), F.col("id").alias("row_ID"), F.lit("").alias("CharIDText"), F.lit("").alias("result_id"),
                                 F.lit(0.0).alias("prec_val"), F.lit("").alias("prec_DQL"))
    shaped = tables.result_table(res, td.characteristics(spark), td.units(spark), td.methods(spark, complete=False), none, keyed=True)
    activities = materialise(_activity_keys(res).where("submission <> 1995"), "activities")
    keyed = assign_ids(activities, "row_key", "ActivityID")
    return plain(audits.missing_required(tables.with_activity_ids(shaped, keyed)).select(
        "ResultIDText", "ActivityID", "CharID", "MethodID", "Result"), "ActivityID", "MethodID")


def audit_orphan_metadata(spark, sf_dir):
    rows = td.template(spark, sf_dir)
    blanked = rows.withColumns({f"c{i}_r": F.when(F.col(f"c{i}_r") >= 10, F.col(f"c{i}_r"))
                                for i in range(1, td.CHARACTERISTICS + 1)})
    return reshape.orphan_metadata(blanked, KNOWN)


# Precision and grades

def precision_rule_choice(spark, sf_dir):
    rules = precision.rules_by_characteristic(td.characteristics(spark), td.precision_criteria(spark, several=True))
    return precision.chosen_rules(precision.replicate_pairs(td.results(spark, sf_dir)), rules)


def _precision(spark, sf_dir, several):
    return plain(precision.replicate_precision(_graded_pairs(spark, sf_dir, several=several)).drop("Char"))


def replicate_precision(spark, sf_dir):
    return _precision(spark, sf_dir, False)


def replicate_precision_by_level(spark, sf_dir):
    return _precision(spark, sf_dir, True)


def replicate_precision_of_many(spark, sf_dir):
    """Visits with several primaries or replicates: each replicate against the reading before it."""
    return plain(precision.replicate_precision(_graded_pairs(spark, sf_dir, td.raw_results(spark, sf_dir))))


def replicate_precision_signed(spark, sf_dir):
    return plain(precision.signed_series(_graded_pairs(spark, sf_dir), grade_on="abs"))


def batch_summary(spark, sf_dir):
    return plain(grading.batch_summary(grading.batches(_graded_pairs(spark, sf_dir))))


def qc_applicability(spark, sf_dir):
    graded = materialise(_graded_pairs(spark, sf_dir), "pairs")
    return plain(grading.qc_applicability(graded, materialise(grading.batches(graded), "batches")))


def _interval(spark, sf_dir, overlaps):
    res, graded, batch_rows = _batches(spark, sf_dir)
    covered = grading.covering_windows(graded, batch_rows, grading.qc_applicability(graded, batch_rows))
    grades = grading.interval_grades(covered, overlaps)
    return (res.join(grades, grading.INSTANT_KEY)
            .select(*PAIR_KEY, "sample_type", "actgrp_char", "prec_DQL", *[c for c in grades.columns if c == "periods"]))


def interval_grade(spark, sf_dir):
    return _interval(spark, sf_dir, "worst")


def interval_grade_overlaps(spark, sf_dir):
    """A row for each period that covers a result."""
    return grading.each_period(_interval(spark, sf_dir, "all"))


def graded_results(spark, sf_dir):
    res, graded, batch_rows = _batches(spark, sf_dir)
    covered = grading.covering_windows(graded, batch_rows, grading.qc_applicability(graded, batch_rows))
    out = grading.grade_results(res, graded, batch_rows, grading.interval_grades(covered))
    return out.select(*PAIR_KEY, "sample_type", "actgrp_char", "Result", "grp_count", "sumofQC", "prelim_dql")


# Anomalies and final grade

def submission_percentiles(spark, sf_dir):
    return plain(anomalies.submission_percentiles(_counts(spark, sf_dir)))


def station_percentiles(spark, sf_dir):
    return plain(anomalies.station_percentiles(_counts(spark, sf_dir)))


def _flagged(spark, sf_dir):
    counts = materialise(_counts(spark, sf_dir), "values")
    return anomalies.with_flags(anomalies.with_limits(td.results(spark, sf_dir), td.anomaly_criteria(spark), counts))


def anomaly_flags(spark, sf_dir):
    return anomalies.raised_anomalies(_flagged(spark, sf_dir)).select(
        *PAIR_KEY, "result_id", "Result", "AnomCritID", "Anom_type", "Anom",
        anomalies.anomaly_code(F.col("Anom")).alias("AnomTypeCode"))


def anomaly_counts(spark, sf_dir):
    counted = anomalies.with_counts(_flagged(spark, sf_dir)).where(F.col("num_anom").isNotNull())
    return counted.select(*PAIR_KEY, "sample_type", "num_anom", *anomalies.COUNT_COLUMNS)


def final_grade(spark, sf_dir):
    return plain(_grade(spark, sf_dir)["final_DQL"].select(
        *PAIR_KEY, "sample_type", "result_id", "Result", "prelim_dql", "num_anom", *anomalies.COUNT_COLUMNS,
        "final_DQL", "DQLCmt"), "num_anom", *anomalies.COUNT_COLUMNS)


# Summaries and chart data

def data_summary(spark, sf_dir):
    return plain(summaries.data_summary(_counts(spark, sf_dir)))


def qc_summary(spark, sf_dir):
    return plain(summaries.qc_summary(precision.signed_series(materialise(_graded_pairs(spark, sf_dir), "pairs"))))


def box_plot_stats(spark, sf_dir):
    return plain(summaries.box_plot_stats(materialise(_counts(spark, sf_dir), "values")))


def box_plot_outliers(spark, sf_dir):
    return plain(summaries.box_plot_outliers(materialise(_counts(spark, sf_dir), "values")))


def characteristics_present(spark, sf_dir):
    return summaries.characteristics_present(td.results(spark, sf_dir))


def control_chart_series(spark, sf_dir):
    return plain(summaries.control_chart_series(_graded_pairs(spark, sf_dir)))


def pair_scatter_bands(spark, sf_dir):
    return plain(summaries.pair_scatter(_graded_pairs(spark, sf_dir)))


# Target tables, publishing and export

def _numeric(df, *columns):
    """Text numbers back to rounded doubles, as the last digits of a text may differ."""
    return df.withColumns({c: F.round(F.col(c).try_cast("double"), DIGITS) for c in columns})


def table_activity_group(spark, sf_dir):
    return tables.activity_group_table(td.results(spark, sf_dir))


def table_activity(spark, sf_dir):
    shaped = tables.activity_table(td.results(spark, sf_dir), td.stations(spark, sf_dir), td.context(spark), "America/Los_Angeles")
    return spelled(plain(shaped, "SmplDepthUnitID"), *NEVER_SET["t_Activity"])


# Target columns for which the definition gives no value.
NEVER_SET = {
    "t_Activity": ["EndDateTime", "EndDateTimeZoneID", "SmplColMthdID", "SmplColEquip", "SmplEquipID", "SmplColEquipComment"],
    "t_Result": ["AnalyticalLaboratoryID", "AnalyticalStartTime", "AnalyticalStartTimeZoneID", "AnalyticalEndTime",
                 "AnalyticalEndTimeZoneID", "LabCommentCode", "DEQ_ACC", "BiasValue", "StatisticalBasisID", "RsltTimeBasisID",
                 "DEQ_RsltComment"],
    "exchange": ["EndDate", "EndTime", "EndDateTimeZoneID", "SmplColEquipComment", "OrgName", "AnStartDate", "AnStartTime",
                 "AnalyticalStartTimeZoneID", "AnEndDate", "AnEndTime", "AnalyticalEndTimeZoneID", "LabCommentCode",
                 "BiasValue", "StatisticalBasisID", "RsltTimeBasisID"],
}


def _lookups(spark, sf_dir):
    """The lookups, with the stations stored, as they are made from a table of the data and read several times."""
    looked = td.lookups(spark, sf_dir)
    return looked | {"stations": materialise(looked["stations"], "stations")}


def _shaped(spark, sf_dir, looked=None):
    graded = _grade(spark, sf_dir)
    final = identity.with_identifiers(materialise(graded["final_DQL"].select(*[f"`{c}`" for c in tables.FINAL_COLUMNS]), "final"))
    return final, workflow.shape_tables(final, graded["prec_grade"], looked or _lookups(spark, sf_dir))


def table_result(spark, sf_dir):
    graded = _grade(spark, sf_dir)
    looked = td.lookups(spark, sf_dir)
    shaped = tables.result_table(graded["final_DQL"], looked["characteristics"], looked["units"], looked["methods"],
                                 graded["prec_grade"])
    return spelled(_numeric(shaped, "PrecisionValue"), *NEVER_SET["t_Result"])


def table_anomaly(spark, sf_dir):
    raised = anomalies.raised_anomalies(_flagged(spark, sf_dir))
    return spelled(tables.anomaly_table(raised, td.types(spark)), "AnomalyComment")


def _activity_keys(res):
    return identity.with_row_keys(res).select("submission", F.col("act_key").alias("row_key")).distinct()


def table_group_activity(spark, sf_dir):
    res = materialise(td.results(spark, sf_dir), "results")
    groups = assign_ids(materialise(tables.activity_group_table(res, keyed=True), "groups"), "row_key", "ActGrpID")
    activities = assign_ids(materialise(_activity_keys(res), "activities"), "row_key", "ActivityID")
    return tables.group_activity_table(res, activities, groups).drop("submission")


def table_review(spark, sf_dir):
    final, shaped = _shaped(spark, sf_dir)
    activities = assign_ids(materialise(_activity_keys(final), "activities"), "row_key", "ActivityID")
    keyed = tables.with_activity_ids(shaped["t_Result"], activities)
    results = materialise(keyed.select("submission", "row_key", *tables.REVIEWED), "results")
    rows = tables.review_table(final, assign_ids(results, "row_key", "ResultID"))
    return plain(rows.drop("submission"), *anomalies.COUNT_COLUMNS)


def surrogate_keys(spark, sf_dir):
    ids = materialise(td.results(spark, sf_dir).select(F.col("act_id").alias("ActivityIDText")).distinct(), "activities")
    return assign_ids(ids, "ActivityIDText", "ActivityID", start=100)


def publish_reconciliation(spark, sf_dir):
    final, shaped = _shaped(spark, sf_dir)
    return workflow.publish_all(final, shaped, scratch_path(spark, "targets"))


def publish_again(spark, sf_dir):
    """The activity groups of half the submissions, then of all of them."""
    root = scratch_path(spark, "targets")
    groups = materialise(tables.activity_group_table(td.results(spark, sf_dir), keyed=True), "groups")
    publish(groups.where("submission % 2 = 0"), root, "t_ActGrp")
    return publish(groups, root, "t_ActGrp", on_existing="new_only")


def publish_keeps_ids(spark, sf_dir):
    """Per submission: activities, and how many have the id they got when half of them were published."""
    root = scratch_path(spark, "targets")
    rows = materialise(tables.activity_table(td.results(spark, sf_dir), td.stations(spark, sf_dir), td.context(spark), keyed=True), "activities")
    half = rows.where(F.conv(F.substring(F.hex("row_key"), 1, 1), 16, 10).cast("int") < 8)
    submissions = submissions_of(rows)
    publish(half, root, "t_Activity")
    first = materialise(key_map(spark, root, "t_Activity", submissions), "first")
    publish(rows, root, "t_Activity", on_existing="new_only")
    now = published(spark, root, "t_Activity", submissions).select("submission", "row_key", "ActivityID")
    both = now.join(first.withColumn("kept", F.lit(1)), ["submission", "row_key", "ActivityID"], "left")
    return both.groupBy("submission").agg(F.count("*").alias("activities"), F.count_distinct("ActivityID").alias("ids"),
                                          F.count("kept").alias("kept_ids"))


def keyed_readback(spark, sf_dir):
    """Published groups of the batches that hold an ungraded-qualifier result, from their partitions."""
    root = scratch_path(spark, "targets")
    res = td.results(spark, sf_dir)
    publish(tables.activity_group_table(res, keyed=True), root, "t_ActGrp")
    batch = materialise(res.where(F.col("RsltQual") == "R").select(F.col("subid").alias("submission"), F.col("act_group").alias("ActGrpIDText")).distinct(), "batch")
    return rows_of_batch(read_target(spark, os.path.join(root, "t_ActGrp")), batch, "ActGrpIDText").select(
        "ActGrpIDText", "ActGrpComment", "ActGrpTypeID")


def exchange_export(spark, sf_dir):
    """Activities and results published, read back by their keys and written as the exchange file."""
    root, looked = scratch_path(spark, "targets"), _lookups(spark, sf_dir)
    final, shaped = _shaped(spark, sf_dir, looked)
    visits = materialise(shaped["t_Activity"], "visits")
    publish(visits, root, "t_Activity")
    activities = key_map(spark, root, "t_Activity", submissions_of(visits))
    publish(tables.with_activity_ids(shaped["t_Result"], activities), root, "t_Result")
    results = identity.with_row_keys(final).select("submission", F.col("result_key").alias("row_key"))
    path = reports.write_exchange(
        workflow.export(root, visits, results, looked), os.path.join(root, "exchange"))
    back = spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in tables.EXCHANGE_COLUMNS))
    return spelled(_numeric(back, "PrecisionValue"), *NEVER_SET["exchange"])


TAB_ORDERS = 100_000


def _write_tabs(rows, path, columns, order, block):
    """Write CSV tabs with a preamble, as workbook exports would hold them.

    A tab holds one block of a submission's rows, so it stays within a workbook's size.
    """
    text = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    head = "Field sheet,,\n,,\nnote,\"one, two\",\n,,\n,,\n" + ",".join(columns) + "\n"
    in_order = F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), text.alias("line"))))
    lines = F.concat(F.lit(head), F.array_join(F.transform(in_order, lambda r: r["line"]), "\n"))
    (rows.withColumn("tab", F.lpad(block.cast("string"), 12, "0"))
     .groupBy("subid", "tab").agg(lines.alias("value")).write.partitionBy("subid", "tab").text(path))


def template_source_roundtrip(spark, sf_dir):
    """Visits written as tabs and read back through the template reader."""
    path = scratch_path(spark, "tabs")
    rows = td.template(spark, sf_dir).select(
        "subid", "row_ID", F.when(F.col("row_ID") % 11 != 0, F.col("LASAR_ID")).alias("LASAR_ID"), "samplers",
        F.date_format("DateTime", "yyyy-MM-dd").alias("StartDate"), F.date_format("DateTime", "HH:mm").alias("StartTime"),
        F.col("row_ID").alias("order_no"), "c1_r", "c1d_r", "c2_r", "c1_qual")
    columns = ["LASAR_ID", "samplers", "StartDate", "StartTime", "order_no", "c1_r", "c1d_r", "c2_r", "c1_qual"]
    _write_tabs(rows, path, columns, "row_ID", F.expr(f"row_ID div {TAB_ORDERS}"))
    return plain(reshape.melt_results(template_source.read_template(spark, path), KNOWN).select(
        "subid", "row_ID", "LASAR_ID", "DateTime", "Char", "Result", "RsltQual"))


def audit_unreadable_stations(spark, sf_dir):
    """Tabs in which some stations are no numbers; what is listed, and how many rows are read beside it."""
    path = scratch_path(spark, "tabs")
    station = F.when(F.col("row_ID") % 29 == 0, F.concat(F.lit("A-"), F.col("LASAR_ID").cast("string"))).otherwise(F.col("LASAR_ID").cast("string"))
    rows = td.visits(spark, sf_dir).select("subid", "row_ID", station.alias("LASAR_ID"), F.date_format("DateTime", "yyyy-MM-dd").alias("StartDate"),
                                           F.date_format("DateTime", "HH:mm").alias("StartTime"))
    _write_tabs(rows, path, ["LASAR_ID", "StartDate", "StartTime"], "row_ID", F.expr(f"row_ID div {TAB_ORDERS}"))
    listed = template_source.unreadable_stations(spark, path).groupBy("subid", "text").agg(F.count("*").alias("n_rows"))
    read = template_source.read_template(spark, path).groupBy("subid").agg(F.count("*").alias("n_rows"))
    return listed.unionByName(read.select("subid", F.lit("read").alias("text"), "n_rows"))


def audit_unreadable_limits(spark, sf_dir):
    """Project tabs in which some limits are no numbers."""
    path = scratch_path(spark, "tabs")
    odd = F.expr("(subid + cast(substring(CharIDText, 2) AS int)) % 3 = 0")
    rows = td.results(spark, sf_dir).groupBy("subid", "CharIDText").agg(F.max("LOQ").alias("LOQ"), F.max("Low_QC").alias("Low_QC")).select(
        "subid", F.col("CharIDText").alias("CharID"), F.when(odd, F.concat(F.lit("<"), F.col("LOQ").cast("string"))).otherwise(F.col("LOQ").cast("string")).alias("Limit of Quantitation"),
        F.when(F.col("subid") % 2 == 0, "none").otherwise(F.col("Low_QC").cast("string")).alias("Low Level QC limit"))
    _write_tabs(rows, path, ["CharID", "Limit of Quantitation", "Low Level QC limit"], "CharID", F.lit(0))
    return template_source.unreadable_limits(spark, path).select("subid", "CharID", "limit", "text")


def project_source_roundtrip(spark, sf_dir):
    """Project info written as tabs and read back, blank codes dropped."""
    path = scratch_path(spark, "tabs")
    counted = td.results(spark, sf_dir).groupBy("subid", "CharIDText").agg(
        F.max("LOQ").alias("Limit of Quantitation"), F.max("Low_QC").alias("Low Level QC limit"),
        F.max("UNITS").alias("UNITS"), F.max("FieldOrLab").alias("FieldOrLab"))
    rows = counted.withColumn("CharID", F.when(F.col("CharIDText") != "c3", F.col("CharIDText")))
    _write_tabs(rows, path, ["CharID", "Limit of Quantitation", "Low Level QC limit", "UNITS", "FieldOrLab"], "CharIDText",
                F.lit(0))
    return template_source.read_project(spark, path).select("subid", "CharID", "LOQ", "Low_QC", "UNITS", "FieldOrLab")


def _reread(spark, df, report, schema):
    path = reports.write_report(df, scratch_path(spark, "reports"), report)
    return spark.read.csv(path, header=True, nullValue="NA", schema=schema)


def report_roundtrip(spark, sf_dir):
    """Batch summary written as the per-submission report and read back."""
    back = _reread(spark, batch_summary(spark, sf_dir), "batch_summary", (
        "actgrp_char string, grp_count bigint, sumofQC bigint, sumofNonQC bigint, sumofA bigint, sumofB bigint, "
        "sumofC bigint, pctQC double, pctQCtononQC double, pctA double, pctB double, pctC double, prelim_dql string, "
        "subid int"))
    return back.select(*BATCH_KEY, *grading.SUMMARY_COLUMNS)


def report_data_summary(spark, sf_dir):
    """Data summary written as the per-submission report and read back."""
    percentiles = ", ".join(f"`{p}` double" for p in summaries.DATA_PERCENTILES)
    return _reread(spark, data_summary(spark, sf_dir), "data_summary", (
        f"Station string, Characteristic string, Count bigint, Mean double, Min double, {percentiles}, Max double, subid int"))


def report_qc_summary(spark, sf_dir):
    """Replicate summary written as the per-submission report and read back."""
    percentiles = ", ".join(f"`{p}` double" for p in summaries.QC_PERCENTILES)
    return _reread(spark, qc_summary(spark, sf_dir), "qc_summary", (
        f"charid string, QCcalc string, Count bigint, Mean double, Min double, {percentiles}, Max double, CountA bigint, CountB bigint, "
        "CountCorE bigint, Count_QC bigint, PercentA double, PercentB double, PercentCorE double, Count_Missing bigint, subid int"))


def report_pair_scatter(spark, sf_dir):
    """Replicate pairs with their bands written as the per-submission report and read back."""
    return _reread(spark, pair_scatter_bands(spark, sf_dir), "pair_scatter", (
        "row_ID bigint, CharIDText string, LASAR_ID bigint, DateTime string, act_group string, actgrp_char string, prec_val double, DQLA double, "
        "DQLB double, dup double, sample double, A_QC_U double, A_QC_L double, B_QC_U double, B_QC_L double, subid int"))


def lookup_columns(spark, sf_dir):
    """A lookup table kept as files, of which only the named columns are read."""
    root = scratch_path(spark, "lookups")
    save_outputs({"tlu_Stations": td.stations(spark, sf_dir)}, root)
    return read_lookup(spark, root, "tlu_Stations", ["STATION_KEY", "StnID", "MLocID"])


def format_data_results(spark, sf_dir):
    """The whole first step: template, project and lookups to identified results."""
    return plain(_formatted(spark, sf_dir)["res"].select(
        "subid", "row_ID", "Char", "CharIDText", "sample_type", "Result", "RsltQual", "Res_comment", "UNITS", "act_type", "DupBatchType",
        "LOQ", "act_id", "act_group", "result_id", "actgrp_char"), "DupBatchType")


def format_data_audits(spark, sf_dir):
    """How many rows each audit of the first step holds; all must be none before grading."""
    outputs = _formatted(spark, sf_dir)
    names = ["bad_batch", "redundant_result", "redundant_act_char", "name_check", "orphan_metadata"]
    parts = [outputs[n].agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("audit"), "n_rows") for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _formatted(spark, sf_dir):
    wide = materialise(td.template(spark, sf_dir), "template")
    known = td.characteristics(spark).where("CharIDText <> 'c7'")
    return workflow.format_data(wide, td.project(spark, sf_dir), td.types(spark), td.submissions(spark, sf_dir, gaps=True), known, KNOWN)


def summarise_outputs(spark, sf_dir):
    """The whole third step: rows of each report and chart table, with a sum of one of its columns."""
    counts = materialise(anomalies.station_counts(td.results(spark, sf_dir)), "values")
    outputs = workflow.summarise(materialise(_graded_pairs(spark, sf_dir), "pairs"), counts)
    sums = {"data_summary": "Count", "qc_summary": "Count_QC", "box_plot_stats": "n", "box_plot_outliers": "occurs",
            "control_chart_series": "row_ID", "pair_scatter": "row_ID"}
    parts = [outputs[n].agg(F.count("*").alias("n_rows"), F.sum(F.col(c).cast("bigint")).alias("total")).select(F.lit(n).alias("output"), "n_rows", "total")
             for n, c in sums.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stage_resume(spark, sf_dir):
    """Named outputs saved by one step and loaded by the next."""
    path = scratch_path(spark, "saved")
    graded = _graded_pairs(spark, sf_dir)
    save_outputs({"graded_pairs": graded}, path)
    return plain(summaries.pair_scatter(load_outputs(spark, path, ["graded_pairs"])["graded_pairs"]))


QUERIES = [
    template_melt_results, template_metadata_join, template_metadata_long, template_visit_comments, row_numbering,
    sample_timestamp, identifiers, audit_unbatched, audit_repeat_results, audit_repeat_keys,
    audit_repeat_keys_across_rows, audit_unreadable, audit_unknown_char, audit_required_nulls, audit_orphan_metadata,
    precision_rule_choice, replicate_precision, replicate_precision_by_level, replicate_precision_of_many,
    replicate_precision_signed,
    batch_summary, qc_applicability, interval_grade, interval_grade_overlaps, graded_results,
    submission_percentiles, station_percentiles, anomaly_flags, anomaly_counts, final_grade,
    data_summary, qc_summary, box_plot_stats, box_plot_outliers, characteristics_present, control_chart_series,
    pair_scatter_bands, table_activity_group, table_activity, table_result, table_anomaly, table_group_activity,
    table_review, surrogate_keys, publish_reconciliation, publish_again, publish_keeps_ids, keyed_readback, exchange_export,
    template_source_roundtrip, project_source_roundtrip, audit_unreadable_stations, audit_unreadable_limits, report_roundtrip, report_data_summary, report_qc_summary,
    report_pair_scatter, stage_resume, lookup_columns, format_data_results, format_data_audits, summarise_outputs,
]


def queries():
    return {query.__name__: query for query in QUERIES}
