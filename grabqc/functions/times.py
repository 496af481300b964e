"""Timestamp expressions. Times are ``timestamp_ntz`` values holding UTC."""

from pyspark.sql import functions as F

DAYLIGHT_SAVING_ZONE_ID = 22
STANDARD_ZONE_ID = 23


def visit_time(date, time):
    """Timestamp from a date and a time text; NULL when either is missing or unreadable.

    The time may be ``HH:MM``, ``HH:MM:SS`` or a full date-time whose date part is ignored.
    """
    day = F.regexp_replace(F.substring(F.trim(date), 1, 10), "[/.]", "-")
    clock = F.regexp_extract(time, r"(\d{1,2}:\d{2}(?::\d{2})?)(?:\.\d+)?\s*$", 1)
    clock = F.when(F.length(clock) <= 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    return F.concat(day, F.lit(" "), clock).try_cast("timestamp_ntz")


def minute_stamp(ts):
    return F.date_format(ts, "yyyyMMddHHmm")


def day_stamp(ts):
    return F.date_format(ts, "yyyyMMdd")


def time_zone_id(ts, zone):
    """Code telling daylight-saving from standard time in ``zone`` at the UTC time ``ts``."""
    def offset(utc):
        return F.timestamp_diff("MINUTE", utc, F.from_utc_timestamp(utc, zone).cast("timestamp_ntz"))

    january = F.date_trunc("YEAR", ts).cast("timestamp_ntz")
    july = january + F.expr("INTERVAL 6 MONTH")
    standard = F.least(offset(january), offset(july))
    return (F.when(ts.isNull(), F.lit(None).cast("int"))
            .when(offset(ts) > standard, DAYLIGHT_SAVING_ZONE_ID)
            .otherwise(STANDARD_ZONE_ID))


def date_part(ts):
    return F.date_format(ts, "yyyy-MM-dd")


def time_part(ts):
    return F.date_format(ts, "HH:mm:ss")
