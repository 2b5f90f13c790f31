"""The stages against brute force, each on its own input; the queries that have SQL against it."""

import sys
from pathlib import Path

import pytest
from brute import contamination, exact_copies, lower, near_kept
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm.oracles import ORACLES
from touchline.llm.queries import QUERIES, read_table
from touchline.session import settle

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import duckdb_tables, oracle_rows, query_rows  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert query_rows(QUERIES[name](spark, SF)) == oracle_rows(duckdb_tables(SF), ORACLES[name])


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns, before = docs.columns, pairs(docs)
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF))
        assert docs.columns == columns
        after[name] = (before, pairs(docs))
        before = after[name][1]

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.filter("toxic = 0").collect()}
    given, kept = ({d for d, _ in x} for x in after["toxicity"])
    assert kept < given and not (given - kept) & clean
    assert len((given - kept) & toxic) >= 0.5 * len(given & toxic)

    given, kept = after["exact_dedup"]
    assert sorted(kept) == sorted((d, t) for d, t in given if exact_copies(given)[lower(t)][0] == d)

    given, kept = after["near_dedup"]
    assert sorted(kept) == sorted(near_kept(given, similar=80, n=5))

    given, kept = after["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r[0] for r in contamination(given, items) if not r[5]}
    assert sorted(kept) == sorted((d, t) for d, t in given if d in want)

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == want
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert used.filter("n > 4096 OR first != 0 OR n != end").count() == 0

    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect()))
