"""Keeping the fact and insight tables as Parquet."""

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.fixed_values import FACT_TABLE, INSIGHT_TABLE
from touchline.operators.tables import (
    FACT_SCHEMA,
    INSIGHT_SCHEMA,
    KEY,
    check_table_name,
    to_facts,
    upsert_insights,
)
from touchline.session import remove_folder, settled
from touchline.sources.folders import matching


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{check_table_name(name)}"


def sync_facts(
    totals: DataFrame, root: str, run_date: str, table: str = FACT_TABLE,
    skip_if_empty: bool = False,
) -> None:
    """Replace the facts of one date; no other date's files are touched."""
    if skip_if_empty and totals.isEmpty():
        return
    day = to_facts(totals, run_date).drop("event_date")
    day.write.mode("overwrite").parquet(f"{table_path(root, table)}/event_date={run_date}")


def read_facts(spark: SparkSession, root: str, table: str = FACT_TABLE) -> DataFrame:
    """The facts of all dates, none if there is no table yet."""
    path = table_path(root, table)
    if not matching(spark, f"{path}/event_date=*"):
        return spark.createDataFrame([], FACT_SCHEMA)
    return spark.read.schema(FACT_SCHEMA).parquet(path)


BUCKETS = 256
_MANIFEST = "bucket int, write long, rows long, highest long, buckets int"


class Manifest(NamedTuple):
    """One state of an insight table: which write holds each bucket that has rows.

    highest: the highest id ever given. buckets: into how many the keys are divided, which stays as
    it was when the table was made.
    """

    version: int
    highest: int
    buckets: int
    writes: dict[int, tuple[int, int]]  # bucket -> (write, rows)

    def folders(self, path: str, buckets: set[int] | None = None) -> list[str]:
        return [
            f"{path}/data/write={write}/bucket={bucket}"
            for bucket, (write, _) in sorted(self.writes.items()) if buckets is None or bucket in buckets
        ]


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete manifests, oldest first; found by name."""
    done = matching(spark, f"{path}/manifest/version=*/_SUCCESS")
    return sorted(int(p.split("/")[-2].removeprefix("version=")) for p in done)


def read_manifest(
    spark: SparkSession, path: str, version: int | None = None, buckets: int = BUCKETS
) -> Manifest:
    """The given or newest state; a table that isn't there yet is empty. At most a row per bucket."""
    if version is None:
        versions = _versions(spark, path)
        if not versions:
            return Manifest(0, 0, buckets, {})
        version = versions[-1]
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/version={version}").collect()
    writes = {r["bucket"]: (r["write"], r["rows"]) for r in rows if r["rows"]}
    return Manifest(version, max(r["highest"] for r in rows), rows[0]["buckets"], writes)


def key_bucket(buckets: int, key: list[str] = KEY) -> Column:
    """The bucket that a key belongs to."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _read_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], INSIGHT_SCHEMA)
    return spark.read.schema(INSIGHT_SCHEMA).parquet(*folders)


def read_insights(spark: SparkSession, root: str, table: str = INSIGHT_TABLE) -> DataFrame:
    """The newest state of the insights, none if there is no table yet."""
    path = table_path(root, table)
    return _read_folders(spark, read_manifest(spark, path).folders(path))


def sync_insights(
    totals: DataFrame, root: str, now: datetime | None = None, table: str = INSIGHT_TABLE,
    buckets: int = BUCKETS,
) -> None:
    """Update or insert the scores.

    The table lies in buckets of its keys. Only buckets that the new scores have keys of are read,
    and written anew beside the old ones; a manifest then says which write holds each bucket, and
    keeps the highest id, so no other bucket is looked at. A write that fails leaves the newest
    manifest as it was. The state before stays for those who read it just now; what only older
    manifests name is removed. A table keeps the number of buckets it was made with.
    """
    spark, path = totals.sparkSession, table_path(root, table)
    moment = now or datetime.now(timezone.utc)
    before = read_manifest(spark, path, buckets=buckets)
    bucket = key_bucket(before.buckets)
    with settled(totals) as scores:
        keyed = scores.select(F.col("engine_domain").alias(KEY[0]), F.col("keyword").alias(KEY[1]))
        touched = {r["b"] for r in keyed.select(bucket.alias("b")).distinct().collect()}
        version = before.version + 1
        written = f"{path}/data/write={version}"
        merged = upsert_insights(
            _read_folders(spark, before.folders(path, touched)), scores,
            F.timestamp_micros(F.lit(int(moment.timestamp()) * 1_000_000 + moment.microsecond)),
            before.highest,
        )
        (
            merged.withColumn("bucket", bucket).hint("rebalance", "bucket")
            .write.mode("overwrite").partitionBy("bucket").parquet(written)
        )
    now_there = spark.read.schema(f"{INSIGHT_SCHEMA}, bucket int").parquet(written)
    sizes = now_there.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.max("keyword_id").alias("highest")
    ).collect() if touched else []
    highest = max([before.highest, *(r["highest"] for r in sizes)])
    writes = before.writes | {r["bucket"]: (version, r["rows"]) for r in sizes}
    rows = [(b, w, n, highest, before.buckets) for b, (w, n) in writes.items()]
    manifest = spark.createDataFrame(rows or [(-1, version, 0, highest, before.buckets)], _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    _remove_unused(spark, path, Manifest(version, highest, before.buckets, writes), before)


def _remove_unused(spark: SparkSession, path: str, *states: Manifest) -> None:
    """Remove buckets and manifests of no given state: a listing of names, at most a bucket each."""
    used = {f for state in states for f in state.folders(path)}
    kept = {f.rpartition("/")[0] for f in used}
    for folder in matching(spark, f"{path}/data/write=*"):
        if path + folder[folder.rindex("/data/write="):] not in kept:
            remove_folder(spark, folder)
    for folder in matching(spark, f"{path}/data/write=*/bucket=*"):
        if path + folder[folder.rindex("/data/write="):] not in used:
            remove_folder(spark, folder)
    for number in _versions(spark, path):
        if number not in {state.version for state in states}:
            remove_folder(spark, f"{path}/manifest/version={number}")
