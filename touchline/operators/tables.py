"""Fact and insight tables: replace a day, keep the latest row, update or insert."""

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import settle

FACT_SCHEMA = (
    "event_date date, search_engine_domain string, search_keyword string,"
    " total_revenue decimal(18,2)"
)
INSIGHT_SCHEMA = (
    "keyword_id bigint, search_engine_domain string, search_keyword string,"
    " revenue_impact_score double, last_processed_at timestamp"
)
KEY = ["search_engine_domain", "search_keyword"]
_NUMBER_BUCKET_HEX = 4


def check_table_name(name: str) -> str:
    if not re.fullmatch(r"[a-zA-Z_][a-zA-Z0-9_]*", name or ""):
        raise ValueError(f"not a plain table name: {name!r}")
    return name


def to_facts(totals: DataFrame, run_date: str) -> DataFrame:
    return totals.select(
        F.lit(run_date).cast("date").alias("event_date"),
        F.col("engine_domain").alias("search_engine_domain"),
        F.col("keyword").alias("search_keyword"),
        F.col("revenue").cast("decimal(18,2)").alias("total_revenue"),
    )


def replace_date(existing: DataFrame, new: DataFrame, run_date: str) -> DataFrame:
    """The facts with those of one date exchanged, even for none."""
    other_days = ~F.col("event_date").eqNullSafe(F.lit(run_date).cast("date"))
    return existing.where(other_days).unionByName(new)


def dedupe_insights(insights: DataFrame) -> DataFrame:
    """Per engine and keyword the row with the highest id.

    An aggregate rather than a ranking, so that many copies of one key are reduced before
    the shuffle. Rows with a null in the key equal no other row and all stay.
    """
    others = [c for c in insights.columns if c not in KEY]
    alone = F.when(
        F.col(KEY[0]).isNull() | F.col(KEY[1]).isNull(), F.col("keyword_id")
    ).alias("_alone")
    latest = insights.groupBy(*KEY, alone).agg(
        F.max_by(F.struct(*others), "keyword_id").alias("_row")
    )
    return latest.select(*(c if c in KEY else F.col(f"_row.{c}").alias(c) for c in insights.columns))


def number_rows(df: DataFrame, key: list[str], out: str) -> DataFrame:
    """Add consecutive numbers from 1, without one task seeing all rows.

    Rows are numbered within 65,536 buckets of the key's digest, and each bucket starts
    where the ones before it end; only the bucket sizes are ever ranked as a whole.
    """
    digest = F.md5(F.concat_ws("\u0001", *key).cast("binary"))
    bucketed = df.withColumn("_bucket", F.substring(digest, 1, _NUMBER_BUCKET_HEX))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    return (
        bucketed.withColumn("_rank", within)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(out, F.col("_start") + F.col("_rank"))
        .drop("_bucket", "_rank", "_start")
    )


def number_sorted(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add consecutive numbers from 1 in an order; only the sizes of the ranges meet in one task."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = settle(ranged.withColumn("_id", F.monotonically_increasing_id()))
    # The id is the range's number, times 2^33, and the place in it.
    placed = placed.withColumn("_range", F.shiftright("_id", 33))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.col("_start") + F.col("_id") - F.shiftleft("_range", 33) + 1
    # No more rows than ranges.
    numbered = placed.join(F.broadcast(starts), "_range").withColumn(out, place)
    return numbered.drop("_id", "_range", "_start")


def upsert_insights(
    existing: DataFrame, new: DataFrame, now: Column, highest: int | None = None
) -> DataFrame:
    """Existing insights with the scores of `new` (engine_domain, keyword, revenue).

    Known keys keep their id, new ones get the next ids after `highest`, the highest id given so
    far; it is looked up in `existing` if it isn't known. Untouched rows keep their time. Both
    sides are joined once; what the join gave is written, as it is read several times.
    """
    scores = new.select(
        F.col("engine_domain").alias(KEY[0]),
        F.col("keyword").alias(KEY[1]),
        F.col("revenue").cast("double").alias("_score"),
    )
    joined = settle(dedupe_insights(existing).join(scores, KEY, "full_outer"))
    score = F.coalesce("_score", "revenue_impact_score")
    time = F.when(F.col("_score").isNotNull(), now).otherwise(F.col("last_processed_at"))
    updated = joined.where(F.col("keyword_id").isNotNull()).select(
        "keyword_id", *KEY, score.alias("revenue_impact_score"), time.alias("last_processed_at")
    )
    # Of the rows with one key the highest id is kept, so this is the highest of all.
    looked_up = joined.agg(F.coalesce(F.max("keyword_id"), F.lit(0)).alias("n")).scalar()
    last = looked_up if highest is None else F.lit(highest).cast("bigint")
    fresh = joined.where(F.col("keyword_id").isNull())
    inserted = number_rows(fresh, KEY, "_number").select(
        (last + F.col("_number")).alias("keyword_id"),
        *KEY,
        F.col("_score").alias("revenue_impact_score"),
        now.alias("last_processed_at"),
    )
    return updated.unionByName(inserted)
