"""Exact duplicates by sorting contents.

The normalised texts are range-partitioned by sampled splitters and sorted within each range by
Spark's external sort, so equal texts stand next to each other; runs of equal neighbours, compared
in full, are the groups. Texts are equal when they are the same after lower-casing A-Z; a null
text is an empty one.

A group with more rows than a task should hold is found beforehand by counting 64-bit hashes of
the texts; its rows get a second sort key that deals them over several ranges, and its largest
doc_id and size come from an aggregate over its rows by SHA-256, combined before the shuffle. Without
such groups that aggregate is empty. Ranges are split by the first PREFIX characters, then by that
hash, so that many texts with one beginning are spread as well.

The row that stays is the one with the largest doc_id; among rows that share it (or have
none), one that is not named further. A null doc_id is smaller than any other.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import settle

#: The letters whose case is ignored.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of one text that are sorted together at most, about.
GROUP_ROWS = 1_000


#: Hashes of such groups that are broadcast at most; more are joined by shuffling.
BROADCAST_HASHES = 1_000_000
#: Characters that the range partitioning compares before it turns to the hash.
PREFIX = 64


def normalised(text):
    """Lower-cases A-Z only; lower() does so, and fast, where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _runs(documents: DataFrame, group_rows: int, carried: list[str]) -> DataFrame:
    """Each row with its run of equal neighbours: id, place in it, largest id, rows, and for split
    groups what the whole group has."""
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = F.struct(F.col("doc_id").cast("long").alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)])
    rows = documents.select(held.alias("held"), F.col("text").alias("body"))
    # Equal texts have equal hashes; that others may share one does no harm.
    rows = rows.withColumn("content_hash", F.xxhash64(F.lower(F.coalesce("body", F.lit("")))))
    hot = rows.groupBy("content_hash").agg(F.count("*").alias("hash_rows")).filter(F.col("hash_rows") > group_rows)
    hot = settle(hot.select("content_hash", F.ceil(F.col("hash_rows") / group_rows).alias("slices")))
    if hot.count() <= BROADCAST_HASHES:
        hot = F.broadcast(hot)
    sha = F.sha2(F.encode(normalised(F.col("body")), "UTF-8"), 256)
    split = rows.join(hot.select("content_hash"), "content_hash", "left_semi").select(F.col("held.id").alias("id"), sha.alias("sha"))
    groups = split.groupBy("sha").agg(F.max("id").alias("group_keep"), F.count("*").alias("group_rows"))
    dealt = rows.join(hot, "content_hash", "left").select(
        "*",
        F.coalesce(F.pmod(F.xxhash64("held.id"), F.col("slices")), F.lit(0)).alias("slice"),
        F.lower(F.substring(F.coalesce("body", F.lit("")), 1, PREFIX)).alias("beginning"),
    )
    placed = dealt.repartitionByRange(n, "beginning", "content_hash", "slice").withColumn("content", normalised(F.col("body")))
    # The range partitioning serves the window, which only adds the sort within each range.
    run = Window.partitionBy("beginning", "content_hash", "slice", "content")
    runs = placed.select(
        "held",
        "body",
        F.col("slices").isNotNull().alias("split"),
        F.row_number().over(run.orderBy(F.col("held.id").desc_nulls_last())).alias("place"),
        F.max("held.id").over(run).alias("run_keep"),
        F.count("*").over(run).alias("run_rows"),
        F.sha2(F.encode("content", "UTF-8"), 256).alias("text_sha256"),
    )
    return runs.join(groups, F.col("split") & (F.col("text_sha256") == F.col("sha")), "left")


def _stays():
    return (F.col("place") == 1) & (~F.col("split") | F.col("held.id").eqNullSafe(F.col("group_keep")))


def duplicate_groups(documents: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256."""
    return _runs(documents, group_rows, []).select(
        F.col("held.id").alias("doc_id"),
        F.when(F.col("split"), F.col("group_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(F.col("split"), F.col("group_rows")).otherwise(F.col("run_rows")).alias("group_size"),
        _stays().alias("kept"),
        "text_sha256",
    )


def drop_duplicates(documents: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row of each text, with all columns."""
    carried = [c for c in documents.columns if c.lower() != "text"]
    runs = _runs(documents, group_rows, carried).filter(_stays())
    return runs.select(*[F.col("body" if c.lower() == "text" else f"held.c{carried.index(c)}").alias(c) for c in documents.columns])
