"""Revenue by engine and keyword."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.fixed_values import CURATED_NAMES
from touchline.functions.money import cents, money


def keyword_totals(purchases: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exact sum per engine and keyword (and `by`); partial sums before the shuffle."""
    return purchases.groupBy(*(by or []), "engine_domain", "keyword").agg(
        F.sum(money(F.col("revenue"))).alias("revenue")
    )


def keyword_revenue(purchases: DataFrame) -> DataFrame:
    """The same, highest revenue first."""
    return keyword_totals(purchases).orderBy(F.desc("revenue"), "engine_domain", "keyword")


def to_display(df: DataFrame) -> DataFrame:
    """Curated names, revenue in cents."""
    return df.select(
        F.col("engine_domain").alias(CURATED_NAMES["engine_domain"]),
        F.col("keyword").alias(CURATED_NAMES["keyword"]),
        cents(F.col("revenue")).alias(CURATED_NAMES["revenue"]),
    )
