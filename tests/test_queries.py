import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from compare import duckdb_tables, oracle_rows, query_rows
from touchline.plans.oracles import ORACLES
from touchline.plans.queries import QUERIES, tuned

# Money that rounds from half a cent showed up on the second folder only.
FOLDERS = {"small": "/root/testdata/sf0.001", "larger": "/root/testdata/sf0.01"}
LARGER = [
    "keyword_revenue", "engine_metrics", "revenue_trend", "top_keywords", "report_rows",
    "insight_upsert", "last_touch_hot", "scan_schemas", "staging_reruns", "fact_replace",
]


@pytest.fixture(scope="module")
def tables():
    return {name: duckdb_tables(folder) for name, folder in FOLDERS.items()}


def test_entry(spark):
    assert entry(spark).count() == 14


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize(
    "size,name", [("small", n) for n in sorted(QUERIES)] + [("larger", n) for n in LARGER]
)
def test_query_equals_sql(spark, tables, size, name):
    names, rows = query_rows(tuned(QUERIES[name])(spark, FOLDERS[size]))
    want_names, want = oracle_rows(tables[size], ORACLES[name])
    assert rows
    assert names == want_names
    assert rows == want


def test_days_land_whole_from_a_table_in_parts(spark, tmp_path):
    """The stream's files are days, also where several tasks read the events."""
    events = spark.read.parquet(f"{FOLDERS['small']}/events.parquet")
    events.orderBy(F.rand(1)).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_ingest", "stream_same_names"):
        names, rows = query_rows(tuned(QUERIES[name])(spark, str(tmp_path)))
        con = duckdb.connect()
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        assert (names, rows) == oracle_rows(con, ORACLES[name])
