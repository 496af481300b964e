"""Session settings and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Correctness needs the first two; the rest are what the plans are written for. Skewed joins
# are left to adaptive execution, so it may add a shuffle to split a hot key. The JVM does not
# compile methods over 8000 bytes, so Spark should not generate longer ones for wide rows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(app_name="grabqc", master=None, extra=None):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark, label):
    """A path not used before, in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="grabqc-")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")
