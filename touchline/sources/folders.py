"""Names of files and folders, from whatever store the session reads; contents are not read."""

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with wildcards; all names come over in one call."""
    store, where = _store(spark, pattern)
    found = store.globStatus(where)
    if not found:
        return []
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
    return jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\0").split("\0")


def files_below(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder (or the file itself) but hidden ones, with something in them.

    Spark lists them, in tasks if there are many folders, and hands over all names at once.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(path) from error
    return sorted(r["path"] for r in found.where("length > 0").select("path").collect())


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    store, where = _store(spark, path)
    stream = store.open(where)
    try:
        return bytes(b for b in (stream.read() for _ in range(n)) if b >= 0)
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    store, where = _store(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    store.mkdirs(target.getParent())
    if not store.rename(where, target):
        raise OSError(f"{path} can't become {to}")
