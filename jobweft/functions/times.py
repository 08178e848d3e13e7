"""Timestamps from epoch numbers and ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweft.functions.text import strip

# Numbers above this are milliseconds, others seconds.
_MILLIS_ABOVE = 10_000_000_000
# First and last second of the years 1 to 9999.
_MIN_SECOND, _MAX_SECOND = -62135596800, 253402300799

_DAY = r"(\d{4})-?(\d{2})-?(\d{2})"
_ISO = (
    r"^(?=\d{4}-\d{2}-\d{2}|\d{8})" + _DAY
    + r"(?:[\s\S](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    + r"(?:(Z)|([+-]\d{2}):?(\d{2})?)?)?$"
)


def timestamp_from_number(value: Column) -> Column:
    """Epoch seconds or milliseconds; NULL outside the years 1 to 9999."""
    number = value.cast("double")
    seconds = number / F.when(number > _MILLIS_ABOVE, 1000).otherwise(1)
    inside = F.when(seconds.between(F.lit(_MIN_SECOND), F.lit(_MAX_SECOND)), seconds)
    return F.timestamp_micros(F.rint(inside * 1_000_000).cast("bigint"))


def timestamp_from_text(value: Column) -> Column:
    """ISO-8601 date or date-time; without an offset it is UTC. NULL if malformed.

    One expression brings the accepted forms to a single one, with zeros for the
    parts left out, before the cast: a plain cast would also accept a bare year
    or a bare time of day.
    """
    parts = F.regexp_replace(strip(value), _ISO, "$1-$2-$3 0$4:0$5:0$6.$7_$9:0$10")
    # Two digits of every clock part: a leading zero stands for a missing one.
    clock = F.regexp_replace(parts, r"(?<=[ :])0(\d{2})(?!\d)", "$1")
    clock = F.regexp_replace(clock, r"(?<=[ :])0(?=[:.]|$)", "00")
    zoned = F.replace(F.replace(clock, F.lit("._"), F.lit("_")), F.lit("_:"), F.lit("_+00:"))
    stamp = F.replace(zoned, F.lit("_"), F.lit(""))
    shaped = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?[+-]\d{2}:\d{2}$"
    return F.regexp_extract(stamp, shaped, 0).try_cast("timestamp")


def timestamp_of(kind: Column, shown: Column) -> Column:
    """Timestamp of a JSON member: text is ISO-8601, numbers and truth are epochs."""
    flag = F.when(shown == "True", 1.0).when(shown == "False", 0.0)
    return F.when(kind == "STRING", timestamp_from_text(shown)).otherwise(
        timestamp_from_number(F.when(kind == "BOOLEAN", flag).otherwise(shown.try_cast("double")))
    )


def timestamp_error(stamp: Column, shown: Column) -> Column:
    """Message for a member that is given but gave no timestamp."""
    text = strip(shown)
    return F.when(
        stamp.isNull() & (text != ""),
        F.concat(F.lit("Invalid isoformat string: '"), text, F.lit("'")),
    )
