"""Activity types and the identifiers of activities, batches and results."""

from pyspark.sql import functions as F

from grabqc.functions.text import paste
from grabqc.functions.times import day_stamp, minute_stamp

# Activity-type codes by (class, place of analysis).
FIELD_REPLICATE, FIELD_PRIMARY, LAB_REPLICATE, LAB_PRIMARY = 158, 149, 313, 233
# How a submission groups its replicates into batches.
BATCH_BY_DAY, BATCH_BY_DAY_AND_SAMPLER, BATCH_BY_SAMPLER = 448, 449, 450
UNBATCHED = "ERROR"
# Lookup columns never carried into results.
UNUSED_LOOKUP_COLUMNS = ["TypeFilter", "LastChangeDate", "DEQuse", "MonitoringLocationRequired",
                         "AnalyticalMethodRequired", "SubRevNarrative", "OriginalDate"]


def activity_type(sample_type, place):
    """Code for the class and the place; a place naming both counts as field."""
    replicate, primary = sample_type == "dup", sample_type == "sample"
    field, lab = place.contains("Field"), place.contains("Lab")
    return (F.when(replicate & field, FIELD_REPLICATE)
            .when(primary & field, FIELD_PRIMARY)
            .when(replicate & lab, LAB_REPLICATE)
            .when(primary & lab, LAB_PRIMARY))


def batch_id(batch_type):
    return (F.when(batch_type == BATCH_BY_DAY_AND_SAMPLER, paste("-", "subid", "Date4group", "samplers"))
            .when(batch_type == BATCH_BY_SAMPLER, paste("-", "subid", "samplers"))
            .when(batch_type == BATCH_BY_DAY, paste("-", "subid", "Date4group"))
            .otherwise(UNBATCHED))


#: What ``with_identifiers`` adds.
IDENTIFIERS = ["Date4Id", "Date4group", "act_id", "act_group", "result_id", "sub_char", "actgrp_char"]


def with_identifiers(results):
    """Add date stamps and ids; needs the type text and the submission's batch type."""
    return (results
            .withColumns({"Date4Id": minute_stamp(F.col("DateTime")), "Date4group": day_stamp(F.col("DateTime"))})
            .withColumns({"act_id": paste("-", "subid", "Date4Id", "LASAR_ID", "TypeIDText"),
                          "act_group": batch_id(F.col("DupBatchType"))})
            .withColumns({"result_id": paste("-", "act_id", "CharIDText"),
                          "sub_char": paste("-", "subid", "CharIDText"),
                          "actgrp_char": paste("-", "act_group", "CharIDText")}))


def row_key(*values):
    """128-bit key of a row's values. Equal values give equal keys, and a NULL is a value of its own.

    Each value is written with its length, so that no two rows of different values read alike.
    """
    parts = []
    for value in values:
        text = (F.col(f"`{value}`") if isinstance(value, str) else value).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts)))


def with_row_keys(results):
    """Add the submission and the keys of each result, its activity and its batch.

    The text ids leave out what may differ between two rows: visits of one station, minute and type
    share an activity id, and so do their results. The keys tell such rows apart. A result is
    one cell of the template; an activity and a batch are what their target holds of them.
    """
    return results.withColumns({
        "submission": F.col("subid"),
        "result_key": row_key(*[c for c in RESULT_IDENTITY if c in results.columns]),
        "act_key": row_key(*ACTIVITY_IDENTITY),
        "group_key": row_key("subid", "act_group", batch_comment())})


RESULT_IDENTITY = ["subid", "row_ID", "CharIDText", "sample_type", "Char"]
ACTIVITY_IDENTITY = ["act_id", "act_type", "subid", "LASAR_ID", "DateTime", "SubOrganizationID", "samplers", "SampleDepth",
                     "SampleDepthUnit", "DEQ_Comment", "Org_Comment"]
SAMPLER_BATCH_COMMENT = "batched through calendar year by sampler"


def batch_comment():
    """The day of a batch, or that it spans a year; NULL without a batch type."""
    return (F.when(F.col("DupBatchType") == BATCH_BY_SAMPLER, SAMPLER_BATCH_COMMENT)
            .when(F.col("DupBatchType").isNotNull(), F.col("Date4group")))


def identify_results(melted, project, types, submissions):
    """Attach project, activity-type and submission attributes, then build the ids.

    ``project`` is keyed by (subid, CharID); the lookups are joined plainly so that Spark
    broadcasts them only when their size allows.
    """
    project = project.where(F.col("CharID").isNotNull()).withColumnRenamed("CharID", "CharIDText")
    types = types.where(F.col("TypeID").isNotNull()).withColumnRenamed("TypeID", "act_type")
    submissions = submissions.where(F.col("SubID").isNotNull()).withColumnRenamed("SubID", "subid")
    joined = (melted.join(project, ["subid", "CharIDText"], "left")
              .withColumn("act_type", activity_type(F.col("sample_type"), F.col("FieldOrLab")))
              .join(types, "act_type", "left")
              .join(submissions, "subid", "left"))
    return with_identifiers(joined).drop(*UNUSED_LOOKUP_COLUMNS)
