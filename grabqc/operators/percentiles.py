"""Exact percentiles by linear interpolation, from a histogram of distinct values.

The raw rows are read once into (group, value, count), which aggregates before the shuffle; all
statistics are then taken from that smaller table.
"""

from functools import reduce

from pyspark.sql import functions as F

from grabqc.operators.ordered import in_ranges, running_totals


def value_counts(df, keys, value, times=None):
    """One row per group and distinct non-null value, with its number of occurrences.

    ``times`` names a column that says how often a row counts.
    """
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys, F.col(value).cast("double").alias("value"))
            .agg((F.sum(times) if times else F.count("*")).alias("occurs")))


def roll_up(counts, keys):
    """Histogram of coarser groups from that of finer ones."""
    return counts.groupBy(*keys, "value").agg(F.sum("occurs").alias("occurs"))


def summarise_counts(counts, keys, probs):
    """Per group: ``n``, ``mean``, ``min``, ``max`` and one column per requested percentile.

    ``probs`` maps an output name to a probability in [0, 1]. The place of a percentile among n
    values is 1 + (n - 1) p; between two places the two values are weighted by the fraction.
    Values are laid out in ranges of (group, value), so those of one group, however many and
    however close, are ranked by as many tasks as they need.
    """
    ranked = running_totals(in_ranges(counts, keys, ["value"], "ranks"), keys, ["value"], {"upto": F.col("occurs")})
    # A value takes the places from ``since + 1`` to ``upto``; a percentile needs the values at
    # the whole places on either side of its own.
    places = {name: f"1 + (upto_total - 1) * {float(p)!r}D" for name, p in probs.items()}
    stats = ranked.withColumn("since", F.expr("upto - occurs")).groupBy(*keys).agg(
        F.expr("sum(occurs) AS n"), F.expr("sum(value * occurs) / sum(occurs) AS mean"),
        F.expr("min(value) AS min"), F.expr("max(value) AS max"),
        *[F.expr(f"max(if({place} >= since + 1 AND {place} < upto + 1, value, NULL)) AS `__floor_{name}`")
          for name, place in places.items()],
        *[F.expr(f"max(if({place} > since AND {place} <= upto, value, NULL)) AS `__ceil_{name}`")
          for name, place in places.items()])

    def between(name, p):
        low, high, place = f"`__floor_{name}`", f"`__ceil_{name}`", f"(1 + (n - 1) * {float(p)!r}D)"
        part = f"({place} - floor({place}))"
        return F.expr(f"if({low} = {high}, {low}, (1 - {part}) * {low} + {part} * {high}) AS `{name}`")

    return stats.select(*keys, "n", "mean", "min", "max", *[between(name, p) for name, p in probs.items()])


def any_of(conditions):
    return reduce(lambda a, b: a | b, conditions)
