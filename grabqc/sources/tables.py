"""Lookup tables, keyed read-back of published tables, and saved stages."""

import json
import os
import re

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from grabqc.session import scratch_path

PARTITION = "submission"


def read_lookup(spark, directory, table, columns=None, jdbc=None):
    """A whole lookup table, from parquet files or, with JDBC options, from a database.

    Only ``columns`` are read when given. Whether it is broadcast is left to its size.
    """
    if jdbc:
        df = spark.read.format("jdbc").options(**jdbc, dbtable=table).load()
    else:
        df = spark.read.parquet(os.path.join(directory, table))
    return df.select(*columns) if columns else df


def _located(spark, path):
    """A path and its file system, which may be any that Spark writes to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def read_target(spark, path):
    """A published table, or None when nothing has been published yet."""
    where, system = _located(spark, path)
    if not system.exists(where):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):  # the folder of a write that died
            return None
        raise


def submissions_of(batch):
    """The submissions of a batch, which are the partitions its target is read and written in.

    One number for each partition comes to the driver, which lists them for the write anyway.
    """
    return sorted(r[0] for r in batch.select(PARTITION).distinct().collect() if r[0] is not None)


def rows_of_submissions(target, submissions):
    """Rows of a published table in the given submissions: a filter on partitions, others are not read."""
    return None if target is None else target.where(F.col(PARTITION).isin(submissions))


def rows_of_batch(target, batch, key, submissions=None):
    """Rows of a published table whose natural key occurs in the batch.

    Where both hold the submission, only the batch's partitions of the target are read. ``submissions`` are those of the
    batch, where they are known.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if PARTITION in target.columns and PARTITION in batch.columns:
        submissions = submissions_of(batch) if submissions is None else submissions
        target, keys = rows_of_submissions(target, submissions), [*dict.fromkeys([*keys, PARTITION])]
    return target.join(batch.select(*keys).distinct(), keys, "left_semi")


def highest_partition(df, name):
    """Highest value of a partition column, from the names of the files alone; 0 where there are none."""
    found = [re.search(f"/{name}=([0-9]+)/", f) for f in df.inputFiles()] if df is not None else []
    return max((int(m.group(1)) for m in found if m), default=0)


def materialise(df, label, made=None):
    """Write a frame once to the shared scratch folder and read it back.

    For frames that several later steps read with different columns: each then scans only the
    columns it needs instead of recomputing the frame, and lost executors lose nothing. The folder is
    added to the list ``made``, for a caller that removes it when it is done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input files for which a task is made by ``spread``: some 200,000 readings.
SPREAD = 2 << 20


def spread(df, *keys):
    """Rows dealt out by some keys, over more tasks the larger the files are that they come from.

    Adaptive execution gathers small partitions until there are as few tasks as cores, so what a task sorts would grow with
    the input. A number that is asked for is kept.
    """
    spark, size = df.sparkSession, 0
    for name in df.inputFiles():
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        size += where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getLen()
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-size // SPREAD)), *keys)


def remove(spark, paths):
    """Remove folders that this library made in the scratch folder."""
    for path in paths:
        where, system = _located(spark, path)
        system.delete(where, True)


#: Task that a row was written by, and its number in it, as one number.
PLACE = "__at"


def write_counted(df, path, label, partition=None, gathered=False, placed=False, **how):
    """Write a frame, by the values of ``partition`` if given; the number of its rows, counted as they are written.

    Rows that are ``gathered`` lie by ``partition`` already and stay where they are. With ``placed`` rows are written
    with their ``PLACE``.
    """
    seen = Observation(label)
    rows = df.hint("rebalance", partition) if partition and not gathered else df
    if placed:
        rows = rows.withColumn(PLACE, F.monotonically_increasing_id())
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    (rows.write.partitionBy(partition) if partition else rows.write).options(**how).mode("overwrite").parquet(path)
    return seen.get["rows"]


class NotSaved(ValueError):
    """A saved output is missing, half-written or not what its mark says."""


MARK = "name string, committed boolean, schema string, n_rows bigint"


def _mark(spark, directory, name, committed, schema="", rows=0):
    spark.createDataFrame([(name, committed, schema, rows)], MARK).coalesce(1).write.mode("overwrite").parquet(os.path.join(directory, "_marks", name))


def save_outputs(outputs, directory):
    """Save named frames for a later step.

    A mark beside each says that it is whole, with its schema and number of rows. The mark is taken
    back before the rows are written, so a save that died is seen.
    """
    for name, df in outputs.items():
        _mark(df.sparkSession, directory, name, False)
        rows = write_counted(df, os.path.join(directory, name), f"saved {name}")
        _mark(df.sparkSession, directory, name, True, df.schema.json(), rows)


def load_outputs(spark, directory, names):
    """Resume from frames saved by an earlier step; refuses one that is not whole."""
    out = {}
    for name in names:
        marked = read_target(spark, os.path.join(directory, "_marks", name))
        mark = marked.first() if marked is not None else None
        if mark is None or not mark["committed"]:
            raise NotSaved(f"{name} in {directory} was not saved to the end")
        saved = spark.read.schema(T.StructType.fromJson(json.loads(mark["schema"]))).parquet(os.path.join(directory, name))
        if saved.count() != mark["n_rows"]:
            raise NotSaved(f"{name} in {directory} does not hold the {mark['n_rows']} rows that were saved")
        out[name] = saved
    return out
