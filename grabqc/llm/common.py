"""Helpers the operators share."""

import os
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from grabqc.session import scratch_path


def table(spark, sf_dir, name):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def keep(df, label):
    """Write a frame once to the shared scratch folder and read it back.

    It cuts the lineage: what was written survives the loss of an executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns, base):
    """A name for a helper column that none of the columns has, in any case."""
    taken = {c.lower() for c in columns}
    return next(n for n in chain([base], (f"{base}_{i}" for i in count(1))) if n.lower() not in taken)


def utf8(text):
    """Bytes of a text; null is empty. Lone surrogates cannot come from Spark but may from callers."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def parts(texts, most=4_000_000):
    """(start, end) of runs of texts with about ``most`` characters together, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_batches(df, columns, function, schema):
    """Run a function on lists of the given columns, batch by batch, on the executors.

    ``function()`` is called once per task; what it returns takes one list for each column and
    gives one list for each field of ``schema``.
    """
    picked = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    fields = to_arrow_schema(schema)

    def run(batches):
        step = function()
        for batch in batches:
            out = step(*[c.to_pylist() for c in batch.columns])
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, fields)], schema=fields)

    return picked.mapInArrow(run, schema)


def narrow(whole):
    """(name, array): whole numbers in the smallest type that holds them."""
    most = int(np.abs(whole).max()) if whole.size else 0
    kind = "int8" if most < 1 << 7 else "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64"
    return kind, np.ascontiguousarray(whole, kind)


def whole_vectors(batch, dims, scale, largest, others=()):
    """Ids and vectors of a batch (vec_id, vector, ...), components times ``scale`` rounded down.

    Leaves out vectors that are null, not of ``dims`` components, or hold a component that is null,
    not finite or too large. ``others`` names columns whose kept values are returned as arrays too.
    """
    vector = batch.column(1)
    batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(vector), dims), False))
    values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) * scale
    with np.errstate(invalid="ignore"):
        good = (np.abs(values) < largest).all(axis=1)
    batch = batch.filter(pa.array(good))
    out = batch.column(0).to_pylist(), np.floor(values[good]).astype(np.int64)
    return (*out, [batch.column(n) for n in others]) if others else out
