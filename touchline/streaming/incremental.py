"""Files as they arrive, each attributed on its own."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.attribution import (
    SOURCE_BLOCK,
    SOURCE_FILE,
    SOURCE_ROW,
    attributed_purchases,
)
from touchline.operators.normalize import TEXT_COLUMNS
from touchline.operators.revenue import keyword_totals
from touchline.session import settled
from touchline.sinks.files import utc_today, write_object_curated
from touchline.sources.landing import read_objects

MAX_FILES_PER_TRIGGER = 200
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    spark: SparkSession, src: str, max_files: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Stream of the paths of arriving files; their content is not read here.

    Paths rather than rows, because one stream has one schema and landed files may differ.
    """
    return (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
        .load(src).select("path")
    )


def object_totals(hits: DataFrame, identity: str = "raw") -> DataFrame:
    """Keyword revenue per source file; every file starts without memory of others."""
    purchases = attributed_purchases(hits, identity=identity, scope="file")
    return keyword_totals(purchases, by=[SOURCE_FILE])


def run_incremental(
    spark: SparkSession, src: str, out: str, checkpoint: str, run_date: str | None = None,
    identity: str = "raw", partitioned: bool = True, interval=None,
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Process all files that arrived since the last run and write one result per file.

    A batch that is repeated after a failure, also on another day, replaces what it wrote for its
    objects. `max_files` bounds a batch and does not change the result.
    """
    date = run_date or utc_today()

    def process(batch: DataFrame, _batch_id: int) -> None:
        # At most max_files names.
        paths = [row["path"] for row in batch.collect()]
        if not paths:
            return
        # Read once: the totals and the objects' earliest times both come from it.
        columns = [SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW, "hit_ts", *TEXT_COLUMNS]
        hits = read_objects(spark, paths)
        narrow = hits.select(*(c for c in columns if c in hits.columns))
        # A file may come in one piece (a Parquet row group, compressed text) whatever its size. Spread
        # by their places, its rows make as many tasks below as their volume asks for.
        with settled(narrow.repartition(SOURCE_ROW)) as narrow:
            write_object_curated(
                object_totals(narrow, identity), narrow, out, date, partitioned, interval
            )

    return (
        stream_files(spark, src, max_files).writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
