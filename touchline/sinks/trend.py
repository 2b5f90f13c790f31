"""The revenue trend, kept beside the history and brought up to date run by run.

A date's figures come from its own run alone, so they are stored once per date and read back as
they are. With them goes a digest of the names of the run's files, which are new names whenever a
run is written again: only runs that are new or were written again are read.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.money import MONEY, mean
from touchline.operators.report import revenue_trend
from touchline.session import remove_folder
from touchline.sources.folders import matching
from touchline.sources.layers import history_folders, read_runs

_STORED = f"total_revenue {MONEY}, unique_keywords bigint, unique_search_engines bigint, files string, date string"


def _file_digests(spark: SparkSession, root: str, folders: dict[str, str]) -> dict[str, str]:
    """Per date a digest of its run's file names."""
    names: dict[str, list[str]] = {folder: [] for folder in folders.values()}
    for file in matching(spark, f"{root.rstrip('/')}/*/part-*"):
        folder, _, name = file.rpartition("/")
        if folder in names:
            names[folder].append(name)
    return {
        date: hashlib.sha256("\n".join(sorted(names[folder])).encode()).hexdigest()
        for date, folder in folders.items()
    }


def _stored(spark: SparkSession, store: str) -> DataFrame:
    if not matching(spark, f"{store}/date=*"):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(store)


def update_trend(spark: SparkSession, root: str, store: str) -> list[str]:
    """Bring the stored trend up to the history below `root`; returns the dates that were read.

    Dates whose run has gone are removed. What is known is one short row per date.
    """
    store = store.rstrip("/")
    folders = history_folders(spark, root)
    digests = _file_digests(spark, root, folders)
    known = {r["date"]: r["files"] for r in _stored(spark, store).select("date", "files").collect()}
    stale = [date for date in folders if known.get(date) != digests[date]]
    if stale:
        runs = spark.createDataFrame([(d, digests[d]) for d in stale], "date string, files string")
        figures = revenue_trend(read_runs(spark, [folders[d] for d in stale]))
        # A run without rows is stored, too, so that it is not read again.
        rows = runs.join(figures.drop("avg_revenue_per_keyword"), "date", "left")
        (
            rows.select("total_revenue", "unique_keywords", "unique_search_engines", "files", "date")
            .repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("date").parquet(store)
        )
    for date in known.keys() - folders.keys():
        remove_folder(spark, f"{store}/date={date}")
    return stale


def read_trend(
    spark: SparkSession, store: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The stored trend as revenue_trend gives it, of a range of dates if asked."""
    rows = _stored(spark, store.rstrip("/")).where(F.col("total_revenue").isNotNull())
    if since is not None:
        rows = rows.where(F.col("date") >= since)
    if until is not None:
        rows = rows.where(F.col("date") <= until)
    return rows.select(
        "date", "total_revenue", "unique_keywords", "unique_search_engines",
        mean(F.col("total_revenue"), F.col("unique_keywords")).alias("avg_revenue_per_keyword"),
    ).orderBy("date")
