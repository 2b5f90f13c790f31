"""The batch job: landing to staging, curated results and tables."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from touchline.operators.attribution import attributed_purchases
from touchline.operators.revenue import keyword_revenue, keyword_totals
from touchline.session import persisted, settled
from touchline.sinks.files import utc_today, write_curated, write_staging
from touchline.sinks.tables import sync_facts, sync_insights
from touchline.sources.landing import read_hits, scan_path


def search_revenue(hits: DataFrame, **options) -> DataFrame:
    """Keyword revenue of a hits frame; options as for attributed_purchases."""
    return keyword_revenue(attributed_purchases(hits, **options))


def run_batch(
    spark: SparkSession,
    landing: str,
    curated: str,
    fmt: str = "parquet",
    staging: str | None = None,
    tables: str | None = None,
    run_date: str | None = None,
    interval=None,
    dt=None,
    hour=None,
    minute=None,
    staging_parts: int = 0,
    curated_files: int | None = None,
    skip_if_empty: bool = False,
    now: datetime | None = None,
    persist: bool = False,
    **attribution,
) -> str:
    """One run; returns the curated folder.

    Staging scans the landing once more rather than caching it: the two need different
    columns and a cache of a whole landing would not fit. Where it does fit, as with one
    partition of a landing of many small text files, `persist` reads it once for both. The
    totals are small by comparison; they are written once and feed all sinks.
    """
    date = run_date or utc_today()
    landed = read_hits(spark, landing, fmt, dt=dt, hour=hour, minute=minute, interval=interval)
    with persisted(landed, persist and bool(staging)) as hits:
        if staging:
            source = scan_path(landing, dt, hour, minute, interval)
            write_staging(hits, staging, interval, staging_parts, source=source)
        sales = attributed_purchases(hits, **attribution)
        with settled(keyword_totals(sales), bool(tables)) as totals:
            path = write_curated(totals, curated, date, curated_files)
            if tables:
                sync_facts(totals, tables, date, skip_if_empty=skip_if_empty)
                sync_insights(totals, tables, now)
    return path
