"""Token ids of a corpus in ORC files, in ascending doc_id order.

Each row is a document: doc_id and its ids, end id included. ORC writes integers run-length
encoded, in stripes that are read in parallel; every `row_index_stride` rows have an index entry,
and a Bloom filter on doc_id lets a lookup skip stripes and row groups by metadata alone. Files
hold disjoint ranges of doc_id, so a document's place in the corpus is its place in its file plus
the ids in the files before; that index is written beside the data, a row per file.

A null text has no ids but the end id. A null doc_id sorts first. Rows that share a doc_id are
kept; they stand together, in the order of their texts. Extra columns are left out.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.bytes_text import text_slices
from touchline.llm.token_chunks import ChunkEncoder

WRITE_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(16 << 20),
    "orc.encoding.strategy": "SPEED",
    "compression": "zstd",
}


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with an end id after each document's, and where each document begins."""
    bounds = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(int(bounds[-1]), end_id, np.uint32)
    inside = np.ones(len(out), bool)
    inside[bounds[1:] - 1] = False
    out[inside] = ids
    return out, bounds


def write_token_orc(documents: DataFrame, path: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Tokenises whole texts and writes them, and the index of the files, below path."""
    spark = documents.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        encoder = shared_encoder(tokenizer)
        for rows, buf, offsets in text_slices(batches):
            ids, bounds = with_end(*encoder.encode(buf, offsets), end_id)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([rows["doc_id"].cast(pa.int64()), lists], ["doc_id", "ids"])

    ordered = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    writer = ordered.mapInArrow(run, "doc_id long, ids array<int>").write
    for key, value in WRITE_OPTIONS.items():
        writer = writer.option(key, value)
    writer.orc(f"{path}/data")
    counted = read_token_orc(spark, path).select("doc_id", F.size("ids").cast("long").alias("n"), F.col("_metadata.file_path").alias("file"))
    files = counted.groupBy("file").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("docs"), F.sum("n").alias("tokens"))
    # A row per file, so one task orders them.
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.orc(f"{path}/files")


_ENCODERS: dict[str, ChunkEncoder] = {}


def shared_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder: what it has met in one task serves the next ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids, as written."""
    return spark.read.schema("doc_id long, ids array<int>").orc(f"{path}/data")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Each document's place, number and checksum of ids, all from the files."""

    def run(batches):
        for batch in batches:
            lists = batch["ids"]
            ids = np.ascontiguousarray(lists.flatten().to_numpy(), "<i4")
            bounds = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(lists) else 0)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["file"], batch["row"], pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "file", "row", "n_tokens", "ids_crc32"])

    rows = read_token_orc(spark, path).select("doc_id", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"), "ids")
    rows = rows.mapInArrow(run, "doc_id long, file string, row long, n_tokens long, ids_crc32 long")
    files = spark.read.orc(f"{path}/files").select("file", F.col("start").alias("file_start"))
    # Within a file, ids rise, and rows of one id follow each other in the file.
    before = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "row").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return within.join(files, "file").select("doc_id", (F.col("file_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
