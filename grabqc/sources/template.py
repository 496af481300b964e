"""Field templates exported from a workbook tab, and templates already held as tables.

One file is one workbook tab of one submission, so a file has at most 1,048,576 rows and is
read whole by a task; a run reads any number of files. Submissions are told apart by a
``subid=<id>`` folder.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.functions.text import blank_to_null
from grabqc.functions.times import visit_time
from grabqc.operators.ordered import dense_index
from grabqc.sources.tables import materialise

PREAMBLE_ROWS = 5
# Column names come from the characteristics' vocabulary, not from the amount of data.
MAX_COLUMNS = 16_384


def read_manifest(spark, path, must):
    """One row per file: its header's cells, its widest line and its number of lines.

    The header is the first line that names the column ``must``. This reads the files as plain lines,
    once; the manifest is stored, and what follows from headers is known before any cell is read.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    cells = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit(""))) + 1
    names = F.col("value").rlike(rf'(^|,)"?\s*{must}\s*"?(,|$)')
    return materialise(lines.groupBy("file").agg(
        F.min_by(F.when(names, F.col("value")), F.when(names, F.col("at"))).alias("header"),
        F.max(cells).alias("width"), F.count("*").alias("n_lines")), "manifest")


def read_tab(spark, path, must, preamble=PREAMBLE_ROWS):
    """Rows of the tabs under ``path`` as one text column for each name in any header, with subid, file and line.

    Each file's own header, on the row after the preamble, names its cells, so submissions
    with different columns are read together. A file whose header does not name the column ``must`` is refused, as is
    one too wide to read. The cells are read in one pass.
    """
    manifest = read_manifest(spark, path, must)
    top = manifest.agg(F.max("width").alias("width"), F.max(F.when(F.col("header").isNull(), F.col("file"))).alias("bare")).first()
    width = top["width"] or 1
    if width > MAX_COLUMNS:
        raise ValueError(f"a line has {width} cells; at most {MAX_COLUMNS} can be read")
    if top["bare"]:
        raise ValueError(f"no column {must} in line {preamble + 1} of {top['bare']}")
    kinds = ", ".join(f"_c{i} string" for i in range(width))
    header = manifest.withColumn("h", F.from_csv("header", kinds)).select(
        "file", F.transform(F.array(*[F.col(f"h._c{i}") for i in range(width)]), lambda c: blank_to_null(F.trim(c))).alias("header"))
    names = [r["name"] for r in header.select(F.explode("header").alias("name")).where("name IS NOT NULL").distinct().orderBy("name").limit(MAX_COLUMNS + 1).collect()]
    if len(names) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} different columns; read fewer kinds of template at once")
    raw = (spark.read.option("multiLine", True).option("escape", '"').schema(kinds + ", subid int").csv(path)
           .select("subid", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
                   F.array(*[f"_c{i}" for i in range(width)]).alias("row")))
    lines = raw.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("at"))).where(F.col("line") > preamble)
    # the line after the preamble must be the header that the manifest has
    wrong = (F.col("line") == preamble + 1) & ~F.coalesce(F.exists("row", lambda c: F.trim(c) == must), F.lit(False))
    stop = F.raise_error(F.concat(F.lit(f"no column {must} in line {preamble + 1} of "), F.col("file"))).cast("boolean")
    cells = F.map_from_entries(F.filter(F.arrays_zip("header", "row"), lambda c: c["header"].isNotNull()))
    return (lines.where(F.when(wrong, stop).otherwise(F.col("line") > preamble + 1))
            .join(header, "file").withColumn("cells", cells)
            .select("subid", "file", "line", *[blank_to_null(F.element_at("cells", F.lit(n))).alias(n) for n in names]))


def number_rows(rows, block, order):
    """Dense row number per submission, in reading order, of the rows that name a station."""
    return dense_index(rows.where(F.col("LASAR_ID").isNotNull()), ["subid"], block, order, "row_ID")


def with_visit_time(rows):
    return rows.withColumn("DateTime", visit_time(F.col("StartDate"), F.col("StartTime")))


LIMITS = {"Limit of Quantitation": "LOQ", "Low Level QC limit": "Low_QC"}


def station_number():
    return F.regexp_replace("LASAR_ID", r"\.0+$", "").try_cast("bigint")


def read_template(spark, path):
    """Wide data tab: rows without a readable station dropped, the others numbered, visit time built.

    Stations that cannot be read are listed by ``unreadable_stations``.
    """
    rows = read_tab(spark, path, must="LASAR_ID").withColumn("LASAR_ID", station_number())
    return with_visit_time(number_rows(rows, ["file"], ["line"])).drop("file", "line")


def unreadable_stations(spark, path):
    """Rows of the data tabs whose station is no number: subid, file, line and the text."""
    tab = read_tab(spark, path, must="LASAR_ID")
    return tab.where(F.col("LASAR_ID").isNotNull() & station_number().isNull()).select("subid", "file", "line", F.col("LASAR_ID").alias("text"))


def read_project(spark, path):
    """Project-info tab: one row per submission and characteristic.

    Limits that cannot be read are missing here and listed by ``unreadable_limits``.
    """
    return shape_project(read_tab(spark, path, must="CharID").drop("file", "line"))


def unreadable_limits(spark, path):
    """Limits of the project tabs that are no numbers: subid, file, line, characteristic, which limit, and the text."""
    tab = read_tab(spark, path, must="CharID").where(F.col("CharID").isNotNull())
    named = [F.struct(F.lit(short).alias("limit"), F.col(f"`{long}`").alias("text")) for long, short in LIMITS.items() if long in tab.columns]
    if not named:
        return tab.select("subid", "file", "line", "CharID", F.lit("").alias("limit"), F.lit("").alias("text")).where("false")
    return (tab.select("subid", "file", "line", "CharID", F.inline(F.array(*named)))
            .where(F.col("text").isNotNull() & F.col("text").try_cast("double").isNull()))


def shape_project(rows):
    rows = rows.withColumnsRenamed(LIMITS)
    return (rows.withColumns({c: F.col(c).try_cast("double") for c in LIMITS.values() if c in rows.columns})
            .where(F.col("CharID").isNotNull()))


def listed_characteristics(project, limit=MAX_COLUMNS):
    """The distinct characteristic codes of the project tabs, to resolve column names with."""
    codes = [r["CharID"] for r in project.select("CharID").distinct().limit(limit + 1).collect()]
    if len(codes) > limit:
        raise ValueError(f"more than {limit} characteristics listed")
    return set(codes)
