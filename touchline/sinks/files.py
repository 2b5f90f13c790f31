"""Writing hits and results to files."""

import hashlib
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.fixed_values import CURATED_NAMES, CURATED_SUFFIX
from touchline.functions.privacy import mask_pii
from touchline.operators.attribution import SOURCE_FILE
from touchline.functions.money import cents
from touchline.operators.normalize import earliest_partition, with_time_partition
from touchline.operators.revenue import to_display
from touchline.session import remove_folder, settle
from touchline.sinks.compaction import release_slice
from touchline.sinks.object_log import add_entry, compact, open_log
from touchline.sources.folders import matching
from touchline.sources.layers import PARTITION_COLUMNS, SLICE_COLUMN, curated_path


def utc_today() -> str:
    return datetime.now(timezone.utc).date().isoformat()


def _ranged(df: DataFrame, files: int | None) -> DataFrame:
    """Highest revenue first within and across files.

    By default the sort decides the number of files: adaptive execution merges small
    partitions, so a small result is one file and a large one is never squeezed into one.
    """
    order = [F.desc("revenue"), F.col("engine_domain"), F.col("keyword")]
    if files is None:
        return df.orderBy(*order)
    if files < 1:
        raise ValueError("files must be at least 1")
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def write_curated(
    df: DataFrame, root: str, run_date: str | None = None, files: int | None = None
) -> str:
    """Keyword revenue of one run as Parquet; replaces an earlier write of the same run."""
    path = curated_path(root, run_date or utc_today())
    to_display(_ranged(df, files)).write.mode("overwrite").parquet(path)
    return path


def write_tab(
    df: DataFrame, root: str, run_date: str | None = None, files: int | None = None
) -> str:
    """The same as tab-delimited text with a header and two decimals."""
    path = f"{curated_path(root, run_date or utc_today())}.tab"
    engine, keyword, revenue = CURATED_NAMES.values()
    text = _ranged(df, files).select(
        F.col("engine_domain").alias(engine),
        F.col("keyword").alias(keyword),
        F.format_string("%.2f", F.bround("revenue", 2).cast("double")).alias(revenue),
    )
    (
        text.write.mode("overwrite").option("header", "true").option("sep", "\t")
        .option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false").csv(path)
    )
    return path


def rebalanced(df: DataFrame, columns: list[str], parts: int = 0) -> DataFrame:
    """Rows of a folder together in few tasks, but a folder of any size in as many as it needs.

    A plain repartition would put a folder that holds a third of all hits in one task; the
    rebalance hint lets adaptive execution split it.
    """
    return df.hint("rebalance", *([parts] if parts else []), *columns)


def write_staging(
    hits: DataFrame, path: str, interval=None, n: int = 0, mask: bool = True, source: str = ""
) -> None:
    """Hits under dt / hour / minute of their own time, and below that by the slice they are from.

    `source` names what was read, such as the landing path. Writing a source again replaces its
    own rows, wherever they were, and no others: a late row of another slice adds to its hour.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    spark = hits.sparkSession
    label = hashlib.sha256(source.encode()).hexdigest()[:16]
    columns = [*PARTITION_COLUMNS, SLICE_COLUMN]
    staged = mask_pii(with_time_partition(hits, interval).drop("event_ts", SLICE_COLUMN), mask)
    own = "/".join([path.rstrip("/"), *(f"{c}=*" for c in PARTITION_COLUMNS), f"{SLICE_COLUMN}={label}"])
    before = set(matching(spark, f"{own}/part-*"))
    (
        rebalanced(staged.withColumn(SLICE_COLUMN, F.lit(label)), PARTITION_COLUMNS, n)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns).parquet(path)
    )
    # The write replaced the folders it has rows for; the source's other ones are out of date.
    for stale in {f.rpartition("/")[0] for f in before.intersection(matching(spark, f"{own}/part-*"))}:
        remove_folder(spark, stale)
    # And where its rows had been merged with those of others.
    release_slice(spark, path, label)


def object_stem(path: Column) -> Column:
    """File name without its last extension."""
    name = F.try_url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "")


def object_label(path: Column) -> Column:
    """Tells objects apart that share a name: a digest of the whole path."""
    return F.substring(F.sha2(path, 256), 1, 16)


def with_object_partition(results: DataFrame, hits: DataFrame, interval=None) -> DataFrame:
    """Attach to each result row the earliest partition of the object it came from.

    The smaller side is known only at run time, so the join is left to adaptive execution,
    which broadcasts the partitions if they are few and splits an object with many results.
    """
    first = earliest_partition(hits, by=[SOURCE_FILE], interval=interval).drop("min_hit_ts")
    return results.join(first, SOURCE_FILE)


OBJECT_LIST = "_objects"


def write_object_curated(
    results: DataFrame, hits: DataFrame, root: str, run_date: str | None = None,
    partitioned: bool = True, interval=None,
) -> None:
    """One folder per input object, below its earliest partition unless `partitioned` is off.

    `results` has source_file, engine_domain, keyword and revenue; `hits` has every hit of the
    objects. A log below the root says which folders an object has been written to. Writing an
    object again leaves it with the new folder only, or none if it has no revenue any more, even
    if its earliest time or the run date is another one, and also if a write of it failed before.
    """
    spark, root = results.sparkSession, root.rstrip("/")
    folders = [*(PARTITION_COLUMNS if partitioned else []), "output"]
    objects = earliest_partition(hits, by=[SOURCE_FILE], interval=interval).drop("min_hit_ts")
    suffix = f"_{run_date or utc_today()}_{CURATED_SUFFIX}"
    label = object_label(F.col(SOURCE_FILE))
    output = F.concat(object_stem(F.col(SOURCE_FILE)), F.lit("_"), label, F.lit(suffix))
    objects = settle(objects.withColumns({"label": label, "output": output}))
    named = results.join(objects, SOURCE_FILE).select(
        F.col("engine_domain").alias(CURATED_NAMES["engine_domain"]),
        F.col("keyword").alias(CURATED_NAMES["keyword"]),
        cents(F.col("revenue")).alias(CURATED_NAMES["revenue"]),
        *folders,
    )
    named = settle(named)
    filled = named.select(*folders).distinct().withColumn("filled", F.lit(True))
    folder = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), c) for c in folders))
    placed = objects.select("label", *folders).join(filled, folders, "left")
    now = settle(placed.select("label", F.when(F.col("filled"), folder).alias("folder")))
    before = open_log(spark, f"{root}/{OBJECT_LIST}")
    log = add_entry(before, now)
    (
        rebalanced(named, folders)
        .sortWithinPartitions(*folders, F.desc(CURATED_NAMES["revenue"]))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders).parquet(root)
    )
    # Folders to give up: those of this write's objects that it did not fill. An object has had one
    # folder at a time, so there are about as many as objects that moved.
    earlier = before.rows().join(now.select("label"), "label", "left_semi").where(F.col("folder").isNotNull())
    for row in earlier.select("folder").distinct().join(now, "folder", "left_anti").toLocalIterator():
        remove_folder(spark, f"{root}/{row['folder']}")
    compact(log)
