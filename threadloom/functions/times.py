"""Time functions, Column -> Column. All values are UTC."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import defaults


def epoch_to_ntz(epoch: Column) -> Column:
    """Epoch seconds (float, rounded half up) -> TIMESTAMP_NTZ, whatever the session zone."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return start + F.make_dt_interval(secs=F.round(epoch))


def epoch_to_timestamp(epoch: Column) -> Column:
    """Epoch seconds with their fraction -> TIMESTAMP."""
    return F.timestamp_micros(F.round(epoch * 1000000).cast("bigint"))


def parse_utc(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(defaults.UTC_FORMAT))


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, defaults.UTC_FORMAT)


def as_literal(as_of: datetime | Column | None) -> Column:
    """A caller-supplied moment (naive means UTC), or the current time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(round(as_of.timestamp() * 1000000)))


def micros_since(ts: Column, as_of: datetime | Column | None) -> Column:
    return F.timestamp_diff("MICROSECOND", ts.cast("timestamp"), as_literal(as_of))


def is_stale(
    last_run: Column,
    as_of: datetime | Column | None = None,
    ttl_hours: float = defaults.DATA_TTL_HOURS,
) -> Column:
    """True if never ingested or strictly older than the time to live."""
    return last_run.isNull() | (micros_since(last_run, as_of) / 3_600_000_000 > ttl_hours)


def freshness_label(last_run: Column, as_of: datetime | Column | None = None) -> Column:
    seconds = F.floor(micros_since(last_run, as_of) / 1_000_000)

    def ago(unit_seconds: int, unit: str) -> Column:
        n = F.floor(seconds / unit_seconds)
        plural = F.when(n > 1, "s").otherwise("")
        return F.format_string(f"Last updated: %d {unit}%s ago", n, plural)

    return (
        F.when(last_run.isNull(), "Never ingested")
        .when(seconds < 60, "Last updated: just now")
        .when(seconds < 3600, ago(60, "minute"))
        .when(seconds < 86400, ago(3600, "hour"))
        .otherwise(ago(86400, "day"))
    )
