"""Merging the small files that many slices leave in one hour of the staging area.

A merged folder stands beside the slices' own ones and its rows say which slice they are from. A list
below the staging path says which folder holds which slice; a new version of it makes the switch, so
`read_staging` sees an hour as it was before or as it is after. What the switch gave up is removed
then: files and rows that count are all that stays, for those who read the files by themselves, too.
Staging a merged slice again takes its rows out of the merged folders in one more switch.
"""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import remove_folder, remove_folders, settle
from touchline.sources.folders import matching
from touchline.sources.layers import (
    MERGED,
    MERGED_COLUMN,
    MERGED_LIST,
    PARTITION_COLUMNS,
    SLICE_COLUMN,
    merged_slices,
    merged_versions,
    staged_rows,
)

#: Slices of an hour from which on they are merged.
LEAST_SLICES = 8

_KEY = [*PARTITION_COLUMNS, "label"]
#: How Spark names the folder of rows without a value.
_UNLABELLED = "__HIVE_DEFAULT_PARTITION__"


def _folders(spark: SparkSession, path: str) -> list[tuple[str, ...]]:
    """dt, hour, minute and slice of every folder, by name."""
    pattern = "/".join([path, *(f"{c}=*" for c in [*PARTITION_COLUMNS, SLICE_COLUMN])])
    return [tuple(p.partition("=")[2] for p in f.split("/")[-4:]) for f in matching(spark, pattern)]


def _folder(path: str, *values: str) -> str:
    names = zip([*PARTITION_COLUMNS, SLICE_COLUMN], values)
    return "/".join([path, *(f"{c}={v}" for c, v in names)])


def _frame(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def _labels(spark: SparkSession, path: str, known: DataFrame | None) -> DataFrame:
    """The slices that have rows in an hour (dt, hour, minute, label), by the names of folders and the
    list `known`; no rows are read. Hours without a label are never merged."""
    folders = [f for f in _folders(spark, path) if not f[-1].startswith(MERGED) and _UNLABELLED not in f]
    own = _frame(spark, folders, _KEY)
    return own if known is None else own.unionByName(known.select(*_KEY)).distinct()


def _switch(spark: SparkSession, path: str, hours: DataFrame, without: str | None = None) -> None:
    """Merge all slices of the given hours (dt, hour, minute) into new folders, but for the slice
    `without`, which stays by itself; then remove what no longer counts."""
    versions = merged_versions(spark, path)
    version = versions[-1] + 1 if versions else 1
    # A name of its own: a compaction that failed may have left files under any number.
    name = f"{MERGED}{version}-{uuid4().hex[:8]}"
    known = merged_slices(spark, path)
    # Names before rows: a slice that is staged meanwhile keeps its own folder.
    labels = _labels(spark, path, known).join(F.broadcast(hours), PARTITION_COLUMNS, "left_semi")
    live = staged_rows(spark, path).join(F.broadcast(hours), PARTITION_COLUMNS, "left_semi")  # names of folders
    if without is not None:
        labels, live = labels.where(F.col("label") != without), live.where(F.col("label") != without)
    rows = live.drop(SLICE_COLUMN).withColumnRenamed("label", MERGED_COLUMN).withColumn(SLICE_COLUMN, F.lit(name))
    parts = [*PARTITION_COLUMNS, SLICE_COLUMN]
    data = [c for c in rows.columns if c not in parts]
    (
        rows.select(*data, *parts).hint("rebalance", *PARTITION_COLUMNS)
        .write.mode("append").partitionBy(*parts).parquet(path)
    )
    moved = labels.select(*_KEY, F.lit(name).alias("folder"))
    if known is not None:
        moved = moved.unionByName(known.join(F.broadcast(hours), PARTITION_COLUMNS, "left_anti"))
    moved = settle(moved)
    moved.repartition(1).write.mode("overwrite").parquet(f"{path}/{MERGED_LIST}/version={version}")
    for old in versions[:-1]:
        remove_folder(spark, f"{path}/{MERGED_LIST}/version={old}")
    _remove_given_up(spark, path, moved)


def _remove_given_up(spark: SparkSession, path: str, moved: DataFrame) -> None:
    """Folders of slices that a merged one holds, and merged folders that hold none."""
    here = _folders(spark, path)
    folders = _frame(spark, here, [*PARTITION_COLUMNS, SLICE_COLUMN]) if here else None
    if folders is None:
        return
    is_merged = F.col(SLICE_COLUMN).startswith(MERGED)
    used = moved.select(*PARTITION_COLUMNS, F.col("folder").alias(SLICE_COLUMN)).distinct()
    empty = folders.where(is_merged).join(used, [*PARTITION_COLUMNS, SLICE_COLUMN], "left_anti")
    held = moved.select(*PARTITION_COLUMNS, F.col("label").alias(SLICE_COLUMN))
    doubled = folders.where(~is_merged).join(held, [*PARTITION_COLUMNS, SLICE_COLUMN], "left_semi")
    # No more names than were listed above.
    remove_folders(spark, [_folder(path, *row) for row in empty.unionByName(doubled).collect()])


def compact_staging(spark: SparkSession, path: str, least: int = LEAST_SLICES, dt: str | None = None) -> int:
    """Merge the slices of every hour that has `least` folders or more, of one day only if asked;
    returns how many hours that were. What a compaction that failed left behind goes, too."""
    path = path.rstrip("/")
    counts: dict[tuple[str, ...], int] = {}
    for *hour, _ in _folders(spark, path):
        if dt is None or hour[0] == dt:
            counts[tuple(hour)] = counts.get(tuple(hour), 0) + 1
    chosen = [hour for hour, n in counts.items() if n >= max(2, least)]
    if chosen:
        _switch(spark, path, _frame(spark, chosen, PARTITION_COLUMNS))
    return len(chosen)


def release_slice(spark: SparkSession, path: str, label: str) -> None:
    """Take a slice that was written again out of the merged folders; its own folders count then."""
    path = path.rstrip("/")
    merged = merged_slices(spark, path)
    if merged is None:
        return
    hours = merged.where(F.col("label") == label).select(*PARTITION_COLUMNS).distinct().collect()
    if hours:
        _switch(spark, path, _frame(spark, [tuple(h) for h in hours], PARTITION_COLUMNS), without=label)
