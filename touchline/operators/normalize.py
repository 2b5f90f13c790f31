"""From a landed table to the hits frame the other operators take."""

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.fixed_values import REQUIRED_HIT_COLUMNS
from touchline.functions import clock
from touchline.functions.text import text_or_empty

TEXT_COLUMNS = [c for c in REQUIRED_HIT_COLUMNS if c != "hit_time_gmt"]


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    lower = [c.lower() for c in df.columns]
    twice = sorted(c for c, n in Counter(lower).items() if n > 1)
    if twice:
        raise ValueError(f"columns differ only in case: {twice}")
    return df.toDF(*lower)


def require_hit_columns(df: DataFrame) -> DataFrame:
    missing = sorted(set(REQUIRED_HIT_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"hit columns missing: {missing}; found: {sorted(df.columns)}")
    return df


def normalize_types(df: DataFrame) -> DataFrame:
    """Text for the text columns, '' for null; bytes are decoded, bad ones replaced."""
    binary = {f.name for f in df.schema if isinstance(f.dataType, T.BinaryType)}
    return df.withColumns(
        {
            c: F.make_valid_utf8(text_or_empty(F.col(c))) if c in binary
            else text_or_empty(F.col(c))
            for c in TEXT_COLUMNS
        }
    )


def normalize_hits(df: DataFrame) -> DataFrame:
    """Names, required columns, types, and `hit_ts`."""
    hits = normalize_types(require_hit_columns(normalize_columns(df)))
    return hits.withColumn("hit_ts", clock.hit_ts(F.col("hit_time_gmt")))


def with_time_partition(df: DataFrame, interval=None) -> DataFrame:
    """Add event_ts, dt, hour and minute, all from the hit's own time."""
    minutes = clock.resolve_interval(interval, df.sparkSession)
    ts = F.col("event_ts")
    return df.withColumn("event_ts", clock.event_ts(F.col("hit_ts"))).withColumns(
        {
            "dt": clock.dt_label(ts),
            "hour": clock.hour_label(ts),
            "minute": clock.minute_bucket(ts, minutes),
        }
    )


def earliest_partition(
    df: DataFrame, by: list[str] | None = None, interval=None, ignore_zero: bool = False
) -> DataFrame:
    """Partition of the earliest hit, per group if `by` is given; no hits means now."""
    time = F.when(F.col("hit_ts") != 0, F.col("hit_ts")) if ignore_zero else F.col("hit_ts")
    first = df.groupBy(*(by or [])).agg(
        F.coalesce(F.min(time), F.unix_seconds(F.current_timestamp())).alias("hit_ts")
    )
    labelled = with_time_partition(first, interval)
    return labelled.select(*(by or []), F.col("hit_ts").alias("min_hit_ts"), "dt", "hour", "minute")
