"""Reading what earlier runs wrote."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.fixed_values import CURATED_NAMES, CURATED_SUFFIX
from touchline.sources.folders import matching

PARTITION_COLUMNS = ["dt", "hour", "minute"]
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
SLICE_COLUMN = "slice"


def curated_path(root: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/{run_date}_{CURATED_SUFFIX}"


def _report_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({shown: name for name, shown in CURATED_NAMES.items()})


MERGED = "merged-"
MERGED_COLUMN = "merged_slice"
MERGED_LIST = "_merged"
_MERGED_ROWS = "dt string, hour string, minute string, label string, folder string"


def merged_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete lists of merged slices, oldest first; found by name."""
    done = matching(spark, f"{path.rstrip('/')}/{MERGED_LIST}/version=*/_SUCCESS")
    return sorted(int(p.split("/")[-2].removeprefix("version=")) for p in done)


def merged_slices(spark: SparkSession, path: str) -> DataFrame | None:
    """Which folder holds a slice of an hour that was merged: dt, hour, minute, label, folder."""
    versions = merged_versions(spark, path)
    if not versions:
        return None
    return spark.read.schema(_MERGED_ROWS).parquet(f"{path.rstrip('/')}/{MERGED_LIST}/version={versions[-1]}")


def staged_rows(spark: SparkSession, path: str) -> DataFrame:
    """All staged rows that count, with the slice that each is from, as `label`.

    Of a slice that was merged with others the rows in the merged folder count, of any other slice
    those in its own folder.
    """
    merged = merged_slices(spark, path)
    df = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in df.schema}
    fields = [f for f in df.schema.fields if f.name != MERGED_COLUMN]
    partitions = [*PARTITION_COLUMNS, SLICE_COLUMN]
    if merged is not None or any(kinds[c] != T.StringType() for c in PARTITION_COLUMNS):
        # The session infers partition types: state them, or '06' would come back as 6. And only
        # merged files have the column of slices.
        fields = [T.StructField(f.name, T.StringType()) if f.name in partitions else f for f in fields]
        first = [f for f in fields if f.name not in partitions]
        last = [f for f in fields if f.name in partitions]
        both = [*first, T.StructField(MERGED_COLUMN, T.StringType()), *last]
        df = spark.read.schema(T.StructType(both)).parquet(path)
    else:
        df = df.withColumn(MERGED_COLUMN, F.lit(None).cast("string"))
    df = df.withColumn("label", F.coalesce(MERGED_COLUMN, SLICE_COLUMN)).drop(MERGED_COLUMN)
    if merged is None:
        return df.where(~F.col(SLICE_COLUMN).startswith(MERGED))
    # Few rows beside the hits; whether they are broadcast is left to their size.
    joined = df.join(merged, [*PARTITION_COLUMNS, "label"], "left")
    counts = F.coalesce(F.col("folder") == F.col(SLICE_COLUMN), ~F.col(SLICE_COLUMN).startswith(MERGED))
    return joined.where(counts).select(*df.columns)


def read_staging(spark: SparkSession, path: str, dt=None, hour=None, minute=None) -> DataFrame:
    """Staged hits of all slices; the filters are on partition columns, so other folders are not read."""
    df = staged_rows(spark, path)
    for name, value, width in zip(PARTITION_COLUMNS, (dt, hour, minute), (0, 2, 2)):
        if value is not None:
            df = df.where(F.col(name) == str(value).zfill(width))
    return df.drop(SLICE_COLUMN, "label")


def read_curated(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """One run's keyword revenue, under report names."""
    try:
        df = spark.read.parquet(curated_path(root, run_date))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no curated files for {run_date} under {root}") from error
    if df.isEmpty():
        raise ValueError(f"the curated files for {run_date} under {root} hold no rows")
    return _report_names(df)


HISTORY_SCHEMA = "date string, engine_domain string, keyword string, revenue double"


def history_folders(
    spark: SparkSession, root: str, since: str | None = None, until: str | None = None
) -> dict[str, str]:
    """Folder of each run date from `since` to `until`, both included; looks at names only."""
    folders = {}
    for folder in matching(spark, f"{root.rstrip('/')}/*_{CURATED_SUFFIX}"):
        date = folder.rpartition("/")[2].removesuffix(f"_{CURATED_SUFFIX}")
        if _DATE.fullmatch(date) and (since or date) <= date <= (until or date):
            folders[date] = folder
    return dict(sorted(folders.items()))


def read_history(
    spark: SparkSession, root: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Keyword revenue of all runs, with the run date; of some dates only, if a range is given.

    Folders outside the range are never listed.
    """
    if since is None and until is None:
        return read_runs(spark, [f"{root.rstrip('/')}/*_{CURATED_SUFFIX}"])
    return read_runs(spark, list(history_folders(spark, root, since, until).values()))


def read_runs(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Keyword revenue of given run folders, with the run date."""
    if not folders:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    df = spark.read.parquet(*folders)
    date = F.regexp_extract("_metadata.file_path", rf"(\d{{4}}-\d{{2}}-\d{{2}})_{CURATED_SUFFIX}", 1)
    return _report_names(df.select(date.alias("date"), *CURATED_NAMES.values()))


def output_exists(spark: SparkSession, root: str, run_date: str) -> bool:
    """Whether a result of the run date lies below the root; looks at matching names only."""
    name, root = f"*{run_date}_{CURATED_SUFFIX}*", root.rstrip("/")
    below = "/".join(f"{c}=*" for c in PARTITION_COLUMNS)
    folders = (f"{root}/{name}", f"{root}/{below}/{name}")
    return any(matching(spark, f"{folder}/part-*") for folder in folders)
