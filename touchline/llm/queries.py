"""The registered queries of this subpackage: each applies one operator to its whole table."""

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    content_sort,
    conversation_repair,
    decontaminate,
    fuzzy_lines,
    html_tree,
    license_scan,
    ngram_join,
    packing,
    ptolemaic,
    pu_toxicity,
    rule_quality,
    target_ratio,
    token_orc,
)
from touchline.session import settle, shared_folder

#: Rows that Spark hands to Python at a time.
ARROW_ROWS = 2_000


def read_table(spark: SparkSession, sf: str, table: str) -> DataFrame:
    # Workers import this package from where the driver does, unless told otherwise.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf}/{table}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.join_near_copies(read_table(spark, sf, "documents"))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents")
    return rule_quality.score_quality(documents, rule_quality.train(documents, read_table(spark, sf, "labels")))


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents")
    return pu_toxicity.score_toxicity(documents, pu_toxicity.train(documents, read_table(spark, sf, "labels")))


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return content_sort.duplicate_groups(read_table(spark, sf, "documents"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf, "documents")).drop("spans")


def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.cut_pieces(read_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_pieces(settle(pieces))


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    return html_tree.extract_text(pages, html_tree.train(pages))


def op8_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    return fuzzy_lines.line_decisions(read_table(spark, sf, "documents"), word_keys=True)


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")).drop("spans")


def op10_token_orc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    token_orc.write_token_orc(read_table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_orc.token_digest(spark, path)


def op11_target_ratio(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents")
    return target_ratio.judge(documents, target_ratio.train(documents, read_table(spark, sf, "labels")))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = conversation_repair.damage(read_table(spark, sf, "conversations"))
    return conversation_repair.digests(conversation_repair.repair(rows))


def op13_ptolemaic_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return ptolemaic.cluster(read_table(spark, sf, "embeddings"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_html_text": op7_html_text,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_decontamination": op9_decontamination,
    "op10_token_orc": op10_token_orc,
    "op11_target_ratio": op11_target_ratio,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ptolemaic_clusters": op13_ptolemaic_clusters,
}
