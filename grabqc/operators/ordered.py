"""Ordered computations inside groups of any size.

A plain window puts a whole group into one task. Here rows are first laid out in ranges of (group,
order), so that a group takes as many ranges as it has rows for, and each row knows the number of its
range. Windows run inside a group's part of a range; what is carried from range to range is one row for
each. The plan is the same for groups of any size, and two rows of a group are in one range
only if they are near each other in the order, however close their values are.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.operators.joins import join_null_safe
from grabqc.sources.tables import materialise

RANGE = "__range"


def in_ranges(df, keys, order, label):
    """Rows laid out by (group, order) and stored, with the number of their range.

    Range numbers rise with the order inside a group. They are stored, as the bounds are sampled and
    another run could cut elsewhere.
    """
    return materialise(df.repartitionByRange(*keys, *order).withColumn(RANGE, F.spark_partition_id()), label)


def running_totals(ranged, keys, order, sums, nullable=None):
    """Running sums inside each group, in ``order``, of rows laid out with ``in_ranges``.

    ``sums`` maps an output name to the column it accumulates. Adds, per output, the running
    sum including the current row (``name``) and the total of the group (``name_total``): the sum
    inside the range, and the sums of the group's ranges before it. ``nullable`` names the keys that can be missing,
    where that is known; without any, rows are shuffled once.
    """
    cells = [*keys, RANGE]
    inside = Window.partitionBy(*cells).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({f"__l_{n}": F.sum(c).over(inside) for n, c in sums.items()})

    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = ranged.groupBy(*cells).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    offsets = totals.select(
        *cells,
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(whole).alias(f"{n}_total") for n in sums],
    )
    joined = join_null_safe(local, offsets, cells, nullable=nullable)
    joined = joined.withColumns({n: F.col(f"__l_{n}") + F.col(f"__o_{n}") for n in sums})
    return joined.drop(RANGE, *[f"__l_{n}" for n in sums], *[f"__o_{n}" for n in sums])


def neighbours(ranged, keys, order, fields, nullable=None):
    """Previous and next row of each row inside its group, as structs ``prev`` and ``next``.

    Rows are laid out with ``in_ranges``. Where a group goes on in the next range, its last row here and
    its first row there look for each other among such edge rows only: two for each range at most.
    """
    cells = [*keys, RANGE]
    inside = Window.partitionBy(*cells).orderBy(*order)
    row = F.struct(*fields)
    placed = F.struct(F.struct(*order).alias("at"), row.alias("row"))
    local = ranged.withColumns({"prev": F.lag(row).over(inside), "next": F.lead(row).over(inside)})
    across = Window.partitionBy(*keys).orderBy(RANGE)
    edges = (ranged.groupBy(*cells).agg(F.min(placed).alias("first"), F.max(placed).alias("last"))
             .select(*cells, F.lag("last.row").over(across).alias("__before"), F.lead("first.row").over(across).alias("__after"))
             .where(F.col("__before").isNotNull() | F.col("__after").isNotNull()))
    return (join_null_safe(local, edges, cells, nullable=nullable)
            .withColumns({"prev": F.coalesce("prev", "__before"), "next": F.coalesce("next", "__after")})
            .drop(RANGE, "__before", "__after"))


def dense_index(df, scope, block, order, name, start=0, nullable=None):
    """Number rows 1, 2, 3 ... inside ``scope`` without sorting a scope in one task.

    ``block`` splits a scope into ordered parts of bounded size: rows sort by block first, then
    by ``order``. An empty scope numbers the whole frame; only one row per block then meets in
    a single task. ``nullable`` names the columns of scope and block that can be missing, where that is known (see
    ``join_null_safe``): without any, rows are shuffled once.
    """
    cells = [*scope, *block]
    inside = Window.partitionBy(*cells).orderBy(*order)
    scope_window = Window.partitionBy(*scope) if scope else Window.partitionBy(F.lit(0))
    before = scope_window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(*cells).agg(F.count("*").alias("__rows"))
               .select(*cells, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")))
    local = df.withColumn("__at", F.row_number().over(inside))
    return (join_null_safe(local, offsets, cells, nullable=nullable)
            .withColumn(name, F.col("__before") + F.col("__at") + F.lit(start))
            .drop("__before", "__at"))
