"""Which folder each landed object was written to: an append log with snapshots.

Every write adds one entry per object before it writes data, so that a write that fails is known to
the one that repeats it. After each SNAPSHOT_EVERY entries the newest state of every object is
written as a snapshot, and what it replaces is removed. A look-up reads the newest snapshot and the
entries after it, so the number of files it reads doesn't grow with the number of writes.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import remove_folder
from touchline.sources.folders import matching

SNAPSHOT_EVERY = 10
ENTRY = "label string, folder string, number long"


class ObjectLog(NamedTuple):
    """Names of a log's complete parts: the number of the newest snapshot (0: none), later entries."""

    spark: SparkSession
    path: str
    snapshot: int
    entries: list[int]

    @property
    def newest(self) -> int:
        return max([self.snapshot, *self.entries])

    def folders(self) -> list[str]:
        """What a look-up reads."""
        state = [f"{self.path}/snapshot={self.snapshot}"] if self.snapshot else []
        return state + [f"{self.path}/entry={n}" for n in self.entries]

    def rows(self) -> DataFrame:
        """label, folder (null: none any more) and number of all that was written since the snapshot."""
        if not self.folders():
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*self.folders())


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    done = matching(spark, f"{path}/{kind}=*/_SUCCESS")
    return sorted(int(p.split("/")[-2].removeprefix(f"{kind}=")) for p in done)


def open_log(spark: SparkSession, path: str) -> ObjectLog:
    """The log as it is now; looks at names only."""
    snapshots = _numbers(spark, path, "snapshot")
    newest = snapshots[-1] if snapshots else 0
    return ObjectLog(spark, path, newest, [n for n in _numbers(spark, path, "entry") if n > newest])


def add_entry(log: ObjectLog, objects: DataFrame) -> ObjectLog:
    """Log objects(label, folder) that are about to be written; returns the log with them."""
    number = log.newest + 1
    entry = objects.select("label", "folder", F.lit(number).cast("long").alias("number"))
    entry.write.mode("overwrite").parquet(f"{log.path}/entry={number}")
    return log._replace(entries=[*log.entries, number])


def compact(log: ObjectLog, every: int = SNAPSHOT_EVERY) -> ObjectLog:
    """Write a snapshot if there are enough entries since the last one.

    To be called when the folders that the entries gave up are gone. An object's newest entry is
    found by an aggregate over its entries; objects without a folder are left out.
    """
    if len(log.entries) < every:
        return log
    newest = log.rows().groupBy("label").agg(
        F.max_by(F.struct("folder"), "number")["folder"].alias("folder"), F.max("number").alias("number")
    )
    state = f"{log.path}/snapshot={log.newest}"
    newest.where(F.col("folder").isNotNull()).write.mode("overwrite").parquet(state)
    for folder in log.folders():
        remove_folder(log.spark, folder)
    return log._replace(snapshot=log.newest, entries=[])
