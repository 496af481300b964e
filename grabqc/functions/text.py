"""Identifier and label expressions."""

from pyspark.sql import functions as F


def paste(sep, *parts):
    """Join columns (by name) as text; a missing part is written as ``NA`` rather than dropped."""
    texts = ", ".join(f"coalesce(cast(`{p}` AS string), 'NA')" for p in parts)
    return F.expr(f"concat_ws('{sep}', {texts})")


def blank_to_null(column):
    return F.when(F.trim(column) != "", column)


def _without_exponent(text):
    """Digits and exponent, as doubles are written in text, to plain digits."""
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?(.*)E", 1), r"\.0*$", "")
    whole, part = F.substring_index(digits, ".", 1), F.when(digits.contains("."), F.substring_index(digits, ".", -1)).otherwise("")
    places = F.regexp_extract(text, r"E(.*)$", 1).try_cast("int")
    point = F.when(F.length(part) > places, F.concat(F.lit("."), F.substr(part, places + 1))).otherwise("")
    large = F.concat(whole, F.rpad(part, places, "0"), point)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -places - 1), whole, part)
    return F.concat(F.when(text.startswith("-"), "-").otherwise(""), F.when(places > 0, large).otherwise(small))


def number_text(column):
    """A number as plain text: no exponent, no trailing zeros, all its digits.

    Few numbers have an exponent. Theirs is taken away inside an array function, which keeps that
    code out of what is generated and compiled for every row.
    """
    plain = column.cast("string")
    moved = F.transform(F.array(plain), _without_exponent)[0]
    return F.regexp_replace(F.when(plain.contains("E"), moved).otherwise(plain), r"\.0*$", "")
