"""Time expressions in UTC, whatever the time zone of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOUR = 3_600_000_000
_DAY = 24 * _HOUR

# Fixed pattern: full date and time, optional fraction, mandatory offset.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})\z"


def parse_rfc3339(value: Column) -> Column:
    """The instant of a strict RFC 3339 text; NULL if it is anything else."""
    return F.when(value.rlike(RFC3339), value.try_cast("timestamp"))


def rfc3339_text(instant: Column) -> Column:
    """UTC text with the trailing zeros of the fraction removed."""
    # A time without a zone is written as it is; its text has no trailing zeros.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    plain = F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    return F.concat(F.translate(plain.cast("string"), " ", "T"), F.lit("Z"))


def hour_of_day(us: Column) -> Column:
    """Hour 0 to 23 in UTC of epoch microseconds."""
    return F.floor(F.pmod(us, F.lit(_DAY)) / _HOUR).cast("int")


def weekday(us: Column) -> Column:
    """0 for Monday to 6 for Sunday in UTC; the epoch began on a Thursday."""
    days = (us - F.pmod(us, F.lit(_DAY))) / _DAY
    return F.pmod(days.cast("bigint") + 3, F.lit(7)).cast("int")


def micros(instant: Column) -> Column:
    return F.unix_micros(instant)


def seconds_floor(us: Column) -> Column:
    """Whole seconds of an epoch-microsecond column, rounded down."""
    return F.unix_seconds(F.timestamp_micros(us))
