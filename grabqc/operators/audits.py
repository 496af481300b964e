"""Checks of the long results that must come back empty before grading or loading."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.operators.identity import UNBATCHED
from grabqc.operators.percentiles import any_of
from grabqc.sources.tables import spread

READING_KEY = ["subid", "row_ID", "LASAR_ID", "DateTime", "CharIDText", "sample_type"]
# The same reading entered in two template rows is only seen when the row number is left out.
ACROSS_ROWS_KEY = [k for k in READING_KEY if k != "row_ID"]
REQUIRED_RESULT_COLUMNS = ["ActivityID", "CharID", "Result", "UnitID", "MethodID", "RsltTypeID", "RsltStatusID"]


def unbatched(results):
    """Results whose submission has no usable batch type."""
    return results.where(F.col("act_group") == UNBATCHED)


def repeated(results, keys):
    """All rows of every key that occurs more than once.

    Rows are dealt out by key once and counted where they are; the rows of one key meet in one task. Tasks are as many as
    the input asks for, so what one sorts does not grow with it.
    """
    kinds = dict(results.dtypes)  # numbers with a fraction are dealt by another hash in windows
    return (spread(results, *[k for k in keys if kinds[k] not in ("double", "float")]).withColumn("__n", F.count("*").over(Window.partitionBy(*keys)))
            .where(F.col("__n") > 1).drop("__n"))


def repeated_results(results, across_rows=False):
    """Same reading and same value more than once."""
    return repeated(results, (ACROSS_ROWS_KEY if across_rows else READING_KEY) + ["Result"])


def repeated_keys(results, across_rows=False):
    """Same reading more than once, whatever its value."""
    return repeated(results, ACROSS_ROWS_KEY if across_rows else READING_KEY)


def unknown_characteristics(results, characteristics):
    """Results whose characteristic is not in the lookup."""
    known = characteristics.where(F.col("CharIDText").isNotNull()).select("CharIDText")
    return results.join(known, "CharIDText", "left_anti")


def missing_required(result_table, required=REQUIRED_RESULT_COLUMNS):
    """Rows of the result table lacking a value that the target requires."""
    return result_table.where(any_of([F.col(c).isNull() for c in required]))
