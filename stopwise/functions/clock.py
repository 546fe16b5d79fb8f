"""Time expressions. All of them ignore the session time zone.

Epoch seconds are turned into zone-less timestamps first, so the result is the
same whatever ``spark.sql.session.timeZone`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

LONDON = "Europe/London"
SYDNEY = "Australia/Sydney"

# File names carry year, day, month in this order.
FILE_NAME_PATTERN = r"^(\d{4}_\d{2}_\d{2}_\d{2}_\d{2}_\d{2})\.json"
FILE_NAME_FORMAT = "yyyy_dd_MM_HH_mm_ss"
MINUTE_NAME_FORMAT = "yyyy-dd-MM-HH-mm"

# Accepted spellings of a time argument, day first before month first.
DAY_FIRST_FORMATS = (
    "yyyy_dd_MM_HH_mm_ss",
    "yyyy_MM_dd_HH_mm_ss",
    "yyyy-dd-MM'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-dd-MM",
    "yyyy-MM-dd",
)
ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def utc_time(epoch: str | Column) -> Column:
    """Zone-less UTC wall time of epoch seconds."""
    return F.timestamp_add("SECOND", _col(epoch).cast("long"), F.expr(_EPOCH))


def local_time(epoch: str | Column, zone: str) -> Column:
    """Zone-less wall time of epoch seconds in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_time(epoch))


def epoch_of_utc(stamp: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), stamp)


def epoch_of_local(stamp: Column, zone: str) -> Column:
    """Epoch seconds of a zone-less wall time in ``zone``.

    In the repeated autumn hour the earlier instant is taken; prefer the epoch of
    the document header where there is one.
    """
    return epoch_of_utc(F.convert_timezone(F.lit(zone), F.lit("UTC"), stamp))


def utc_date(epoch: str | Column) -> Column:
    return F.to_date(utc_time(epoch))


def partition_columns(epoch: str | Column, zone: str = LONDON) -> dict[str, Column]:
    """Zero-padded year, month and day of ``epoch`` in ``zone``."""
    stamp = local_time(epoch, zone)
    return {
        "year": F.date_format(stamp, "yyyy"),
        "month": F.date_format(stamp, "MM"),
        "day": F.date_format(stamp, "dd"),
    }


def hour_angle(stamp: Column) -> Column:
    """Angle of the whole hour on a 24-hour dial."""
    return F.hour(stamp) * F.lit(2 * 3.141592653589793) / 24


def is_weekend(stamp: Column) -> Column:
    return (F.weekday(stamp) >= 5).cast("int")


def service_day(epoch: str | Column, zone: str = SYDNEY, reset_hour: int = 3) -> Column:
    """Local date, where the hours before ``reset_hour`` belong to the day before."""
    stamp = local_time(epoch, zone)
    return F.when(F.hour(stamp) < reset_hour, F.date_sub(F.to_date(stamp), 1)).otherwise(
        F.to_date(stamp)
    )


def starts_new_service_day(prev: Column, cur: Column, zone: str, reset_hour: int) -> Column:
    """True where ``cur`` lies on another local date than ``prev`` and past ``reset_hour``."""
    now = local_time(cur, zone)
    return (
        prev.isNotNull()
        & (F.to_date(local_time(prev, zone)) != F.to_date(now))
        & (F.hour(now) >= reset_hour)
    )


def file_time(file_name: str | Column) -> Column:
    """Wall time written in a raw file name, or null."""
    text = F.regexp_extract(_col(file_name), FILE_NAME_PATTERN, 1)
    return _parse_ntz(text, FILE_NAME_FORMAT)


def _parse_ntz(text: Column, fmt: str) -> Column:
    # Parsing as UTC and reading back in UTC keeps the session zone out.
    stamp = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(fmt + " Z"))
    return F.timestamp_add("SECOND", F.unix_seconds(stamp), F.expr(_EPOCH))


def parse_time(text: str | Column, formats: tuple[str, ...] = DAY_FIRST_FORMATS) -> Column:
    """First matching format wins; null where none matches."""
    return F.coalesce(*[_parse_ntz(_col(text), fmt) for fmt in formats])


def parse_time_strict(text: str | Column, formats: tuple[str, ...] = DAY_FIRST_FORMATS) -> Column:
    """Like :func:`parse_time`, but a text no format matches fails the query."""
    message = F.concat(F.lit("Invalid datetime format: "), _col(text))
    return F.coalesce(parse_time(text, formats), F.raise_error(message).cast("timestamp_ntz"))


def clock_seconds(text: str | Column) -> Column:
    """Seconds after midnight of ``HH:MM:SS``; the hour may pass 23."""
    parts = [F.split_part(_col(text), F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    return parts[0] * 3600 + parts[1] * 60 + parts[2]


def minute_of_parts(text: str | Column, year: Column, month: Column, day: Column) -> Column:
    """Epoch of a ``YYYY-DD-MM-HH-MM`` London stamp, null unless it matches the partition."""
    stamp = _parse_ntz(_col(text), MINUTE_NAME_FORMAT)
    same = (F.year(stamp) == year) & (F.month(stamp) == month) & (F.dayofmonth(stamp) == day)
    return F.when(same, epoch_of_local(stamp, LONDON))
