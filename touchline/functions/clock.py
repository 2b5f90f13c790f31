"""Hit time, and the day / hour / minute-bucket labels derived from it (UTC)."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from touchline.fixed_values import DEFAULT_INTERVAL_MINUTES
from touchline.functions.text import strip

INTERVAL_CONF = "spark.touchline.partitionIntervalMinutes"

# 9999-12-31T23:59:59Z: later seconds have no four-digit year, hence no label.
LAST_LABELLED_SECOND = 253402300799
DIGITS = r"^([0-9]+)\z"


def resolve_interval(value=None, spark: SparkSession | None = None) -> int:
    """Minutes per bucket: the argument, else the session setting, else the default.

    A setting that is no number falls back to the default; a number outside 1-60 is an error.
    """
    if value is None and spark is not None:
        value = spark.conf.get(INTERVAL_CONF, None)
    try:
        minutes = int(str(value).strip())
    except ValueError:
        minutes = DEFAULT_INTERVAL_MINUTES
    if not 1 <= minutes <= 60:
        raise ValueError(f"the partition interval must be 1 to 60 minutes, not {minutes}")
    return minutes


def valid_minute_buckets(interval=None) -> list[str]:
    """The bucket labels an hour can have."""
    return [f"{m:02d}" for m in range(0, 60, resolve_interval(interval))]


def hit_ts(c: Column) -> Column:
    """Unix seconds as bigint; anything but plain digits (or digits too many) is 0."""
    digits = F.regexp_extract(strip(c.cast("string")), DIGITS, 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def event_ts(seconds: Column) -> Column:
    """Unix seconds as timestamp; null and negative count as 0."""
    return F.when(
        F.coalesce(seconds, F.lit(0)) <= LAST_LABELLED_SECOND,
        F.timestamp_seconds(F.greatest(seconds, F.lit(0))),
    )


def dt_label(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def hour_label(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def minute_bucket(ts: Column, interval=None) -> Column:
    """Start minute of the bucket; buckets restart every hour, so the last may be short."""
    minutes = resolve_interval(interval)
    minute = F.minute(ts)
    return F.lpad((minute - minute % F.lit(minutes)).cast("string"), 2, "0")


def partition_prefix(dt: Column, hour: Column, minute: Column) -> Column:
    return F.concat(F.lit("dt="), dt, F.lit("/hour="), hour, F.lit("/minute="), minute)
