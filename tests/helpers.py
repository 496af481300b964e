"""Small frames and plain-Python definitions to check the operators against."""

from datetime import datetime, timedelta

RESULT_SCHEMA = (
    "subid int, row_ID bigint, LASAR_ID bigint, DateTime timestamp_ntz, CharIDText string, sample_type string, "
    "Result double, actgrp_char string, act_group string, sub_char string, result_id string, LOQ double, Low_QC double")
T0 = datetime(2019, 6, 1, 10, 0, 0)


def at(minutes=0, seconds=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def result(row, value, kind="sample", when=T0, char="ph", batch="b", subid=1, station=100, loq=None, low=None):
    return (subid, row, station, when, char, kind, None if value is None else float(value), f"{batch}-{char}", batch,
            f"{subid}-{char}", f"r{row}-{kind}-{char}", loq, low)


def results(spark, items):
    return spark.createDataFrame(items, RESULT_SCHEMA).cache()


def criteria(spark, rules, chars=("ph",)):
    """Characteristics and rules; ``rules`` are (char, QCcalc, DQLA, DQLB)."""
    ids = {c: i + 1 for i, c in enumerate(chars)}
    characteristics = spark.createDataFrame([(i, c) for c, i in ids.items()], "CharID int, CharIDText string")
    table = spark.createDataFrame([(ids[c], c, k, a, b) for c, k, a, b in rules],
                                  "charid int, charidText string, QCcalc string, DQLA double, DQLB double")
    return characteristics, table


def periods(qc, drop_unpaired=False):
    """(grade, start, end) of each (time, row, grade) of one batch, by the written rules."""
    qc = sorted((q for q in qc if not (drop_unpaired and q[2] is None)), key=lambda q: (q[0], q[1]))
    out = []
    for i, (t, _, g) in enumerate(qc):
        before = qc[i - 1] if i else None
        after = qc[i + 1] if i + 1 < len(qc) else None
        if t == qc[0][0]:
            start = t.replace(year=t.year - 1)
        elif before and g and before[2]:
            start = t if g <= before[2] else before[0] + timedelta(seconds=2)
        else:
            start = t.replace(year=t.year + 1000)
        if t == qc[-1][0]:
            end = t.replace(year=t.year + 1)
        elif after and g and after[2]:
            end = t + timedelta(seconds=1) if g < after[2] else after[0] - timedelta(seconds=1)
        else:
            end = t.replace(year=t.year + 1000)
        out.append((g, start, end))
    return out


def quantile(values, p):
    values = sorted(values)
    place = 1 + (len(values) - 1) * p
    low, high = values[int(place) - 1], values[min(-int(-place // 1), len(values)) - 1]
    return low if low == high else (1 - (place - int(place))) * low + (place - int(place)) * high
