"""Session settings, and the folder for what several jobs share."""

import atexit
import re
import uuid
from collections import deque
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

FOLDER = "touchline"
_REMOVALS = 16  # folders that are removed side by side


def tune(spark: SparkSession, large: bool = False, shuffle_partitions: int = 200) -> SparkSession:
    """UTC labels and text partition values; `large` adds the profile for big shuffles."""
    if shuffle_partitions < 1:
        raise ValueError("shuffle_partitions must be at least 1")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM only interprets methods above 8000 bytes, which is slower than no fusion.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    if large:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.set("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
    return spark


def shared_root(settings, master: str) -> str:
    """The folder of spark.checkpoint.dir, else one below the warehouse, which a cluster shares.

    A local warehouse is shared only where driver and executors are one process.
    """
    root = settings("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    warehouse = settings("spark.sql.warehouse.dir") or ""
    is_local_path = re.match(r"(?:file:|/|[A-Za-z]:[\\/]|[^:]*\Z)", warehouse) is not None
    if is_local_path and not re.fullmatch(r"local(?:\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/{FOLDER}-shared"


def _application_folder(spark: SparkSession) -> str:
    root = shared_root(lambda key: spark.conf.get(key, None), spark.sparkContext.master)
    return f"{root}/{spark.sparkContext.applicationId}"


_REGISTERED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see; it goes when the application ends, if not before."""
    folder = _application_folder(spark)
    if folder not in _REGISTERED:
        _REGISTERED.add(folder)
        atexit.register(_at_exit, spark, folder)
    return f"{folder}/{uuid.uuid4().hex}"


def _at_exit(spark: SparkSession, folder: str) -> None:
    with suppress(Exception):  # the session's process may have ended before this one
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there; does nothing once the session has ended."""
    context = spark.sparkContext
    if context._jsc is None:
        return
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop, True)


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """The same for many folders, some side by side, as a store takes its time for each."""
    with ThreadPoolExecutor(_REMOVALS) as pool:
        deque(pool.map(lambda path: remove_folder(spark, path), paths), maxlen=0)


def remove_shared(spark: SparkSession) -> None:
    """Delete all that this application has written to the shared folder."""
    remove_folder(spark, _application_folder(spark))


#: Folders to remove at the end of each open scratch() block, the innermost last.
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def settle(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write a frame that several consumers read to the shared folder and read it back.

    Survives the loss of executors, unlike a cache, and ends the lineage. Within a scratch() block
    the table goes with the block; `keep` leaves it to the block around that one, if any.
    """
    path = shared_folder(df.sparkSession)
    blocks = _BLOCKS.get()[: -1 if keep else None]
    if blocks:
        blocks[-1].append(path)
    return _written(df, path)


@contextmanager
def scratch(spark: SparkSession):
    """A block whose settled tables are removed at its end, once what it gives has been settled with
    `keep`. Long jobs of many steps so hold on the disk only what later steps read."""
    folders: list[str] = []
    token = _BLOCKS.set((*_BLOCKS.get(), folders))
    try:
        yield
    finally:
        _BLOCKS.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settled(df: DataFrame, enabled: bool = True):
    """The same while the block runs; the files go with it."""
    if not enabled:
        yield df
        return
    path = shared_folder(df.sparkSession)
    try:
        yield _written(df, path)
    finally:
        remove_folder(df.sparkSession, path)


@contextmanager
def persisted(df: DataFrame, enabled: bool = True):
    """The frame, kept in memory and on disk while the block runs."""
    if not enabled:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
