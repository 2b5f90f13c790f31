"""Checks on what a run wrote."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_sinks(facts: DataFrame, insights: DataFrame, run_date: str, now: Column) -> DataFrame:
    """One row: facts of the date, and insights processed in the two hours before `now`."""
    of_date = F.col("event_date") == F.lit(run_date).cast("date")
    recent = F.col("last_processed_at") >= now - F.expr("INTERVAL 2 HOURS")
    fresh = insights.where(recent).agg(F.count(F.lit(1)).alias("n"))
    return facts.where(of_date).agg(F.count(F.lit(1)).alias("fact_rows")).select(
        "fact_rows", fresh.scalar().alias("recent_insights")
    )


def require_synced(checked: DataFrame) -> None:
    """Fail if the run left no facts or no fresh insights."""
    row = checked.first()
    if row["fact_rows"] < 1:
        raise ValueError("no facts for the run date")
    if row["recent_insights"] < 1:
        raise ValueError("no insights processed in the last two hours")
