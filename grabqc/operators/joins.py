"""Join helper used where a key may be missing on both sides."""

from functools import reduce

from pyspark.sql import functions as F


#: Keys that take few values, or whose values begin alike.
COARSE = ("submission", "subid", "actgrp_char", "CharIDText", "Char")


def fine_first(keys):
    """The keys of a join or window in the order to name them in: those that tell most rows apart come first.

    Rows are sorted in the order that keys are named in, and a sort looks at the first eight bytes of the first of them
    alone, as long as they differ. With a key that all rows share in front, each comparison reads both rows.
    """
    return sorted(keys, key=lambda k: COARSE[::-1].index(k) + 1 if k in COARSE else 0)


def join_null_safe(left, right, keys, how="left", nullable=None):
    """Equi-join in which NULL matches NULL; the right side's key columns are dropped.

    ``<=>`` is planned as a hash key, so this still runs as a shuffle or broadcast join.
    ``nullable`` names the keys that can be missing, where that is known; the others are
    compared plainly, which hashes and sorts less.
    """
    nullable = keys if nullable is None else nullable
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [
        F.col(k).eqNullSafe(F.col(f"__r_{k}")) if k in nullable else F.col(k) == F.col(f"__r_{k}") for k in keys])
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])
