import random
import re

import pytest
from pyspark.sql import functions as F

from touchline.fixed_values import REQUIRED_HIT_COLUMNS
from touchline.operators import attribution, carry
from touchline.operators.attribution import attribute_last_touch, attributed_purchases
from touchline.operators.normalize import normalize_columns, normalize_hits
from touchline.plans.batch import search_revenue

GOOGLE = "http://www.google.com/search?hl=en&q=Ipod"
BING = "http://www.bing.com/search?q=Zune&form=QBLH"
YAHOO = "http://search.yahoo.com/search?p=cd+player&ei=UTF-8"
SHOP = "http://www.esshopzilla.com/cart/"

# Time, ip, events, products, referrer.
SAMPLE = [
    ("1254033280", "67.98.123.1", "", "", GOOGLE),
    ("1254033379", "23.8.61.21", "2", "Electronics;Zune - 328GB;1;;", BING),
    ("1254033478", "112.33.98.231", "", "", YAHOO),
    ("1254033577", "44.12.96.2", "", "", "http://www.google.com/search?q=ipod"),
    ("1254034666", "23.8.61.21", "1", "Electronics;Zune - 32GB;1;250;", SHOP),
    ("1254034963", "44.12.96.2", "1", "Electronics;Ipod - Nano - 8GB;1;190;", SHOP),
    ("1254035260", "67.98.123.1", "1", "Electronics;Ipod - Touch - 32GB;1;290;", SHOP),
]


def hits_frame(spark, rows):
    data = [(i, t, ip, "Mozilla/5.0", ref, ev, pr) for i, (t, ip, ev, pr, ref) in enumerate(rows)]
    names = ["row", *REQUIRED_HIT_COLUMNS]
    kinds = ["int"] + ["string"] * len(REQUIRED_HIT_COLUMNS)
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return normalize_hits(spark.createDataFrame(data, schema))


def revenue(spark, rows, **options):
    result = search_revenue(hits_frame(spark, rows), tie=["row"], **options)
    return [tuple(r) for r in result.collect()]


@pytest.mark.parametrize("hot_rows", [carry.HOT_ROWS, 0])
def test_sample(spark, hot_rows):
    assert revenue(spark, SAMPLE, hot_rows=hot_rows) == [
        ("google.com", "ipod", 480.0), ("bing.com", "zune", 250.0),
    ]


def test_no_purchase_and_no_search(spark):
    assert revenue(spark, SAMPLE[:4]) == []
    assert revenue(spark, SAMPLE[4:]) == []


A = "10.0.0.1"
LAPTOP = "http://www.google.com/search?q=laptop"


def test_variants(spark):
    two = [("1", A, "", "", LAPTOP), ("2", A, "1", "c;p;1;500;", SHOP), ("3", A, "1", "c;p;1;50;", SHOP)]
    assert revenue(spark, two) == [("google.com", "laptop", 550.0)]
    bad_time = [("bad", A, "", "", LAPTOP), ("2", A, "1", "c;p;1;500;", SHOP)]
    assert revenue(spark, bad_time) == [("google.com", "laptop", 500.0)]
    last = [("1", A, "", "", GOOGLE), ("2", A, "", "", "http://google.com/?q=MacBook"),
            ("3", A, "1", "c;p;1;500;", SHOP)]
    assert revenue(spark, last) == [("google.com", "macbook", 500.0)]
    reordered = [last[2], last[0], ("9", A, "", "", BING)]
    assert revenue(spark, reordered) == [("google.com", "ipod", 500.0)]
    own = [("1", A, "1", "c;p;1;5;", BING)]
    assert revenue(spark, own) == [("bing.com", "zune", 5.0)]
    refund = [("1", A, "", "", BING), ("2", A, "1", "c;p;1;5;,c;p;1;-9;", SHOP)]
    assert revenue(spark, refund) == []


def test_same_second_follows_the_tie(spark):
    rows = [("5", A, "1", "c;p;1;5;", SHOP), ("5", A, "", "", BING), ("5", A, "1", "c;p;1;7;", SHOP)]
    assert revenue(spark, rows) == [("bing.com", "zune", 7.0)]


def test_empty_ip(spark):
    rows = [("1", " ", "", "", BING), ("2", " ", "1", "c;p;1;5;", SHOP)]
    assert revenue(spark, rows) == []
    assert revenue(spark, rows, keep_empty_ip=True) == [("bing.com", "zune", 5.0)]
    assert revenue(spark, rows, identity="masked") == [("bing.com", "zune", 5.0)]


def test_masked_identity_merges_a_network(spark):
    rows = [("1", "10.0.0.1", "", "", BING), ("2", "10.0.0.2", "1", "c;p;1;5;", SHOP)]
    assert revenue(spark, rows) == []
    assert revenue(spark, rows, identity="masked") == [("bing.com", "zune", 5.0)]


def test_scope_of_a_file(spark):
    hits = hits_frame(spark, [("1", A, "", "", BING), ("2", A, "1", "c;p;1;5;", SHOP)])
    filed = hits.withColumn("source_file", F.col("row").cast("string"))
    assert search_revenue(filed, tie=["row"], scope="file").count() == 0
    assert search_revenue(filed, tie=["row"]).count() == 1


def test_order_and_partitioning_change_nothing(spark):
    shuffled = hits_frame(spark, SAMPLE).repartition(5, "ip", "referrer")
    for options in ({}, {"visitor_partitions": 3}, {"visitor_partitions": 3, "hot_rows": 1}):
        rows = search_revenue(shuffled, tie=["row"], **options).collect()
        assert [r["revenue"] for r in rows] == [480.0, 250.0]


def test_one_shuffle_of_the_hits(spark):
    """Without hot visitors: hits by visitor, sums by keyword, the final sort."""
    df = search_revenue(hits_frame(spark, SAMPLE), tie=["row"], visitor_partitions=4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 3
    assert "Python" not in plan


def test_tie_must_be_a_position(spark):
    hits = hits_frame(spark, SAMPLE)
    with pytest.raises(TypeError):
        attribute_last_touch(hits, tie=["referrer"])
    with pytest.raises(ValueError):
        attribute_last_touch(hits)
    with pytest.raises(ValueError):
        attributed_purchases(hits, tie=["row"], identity="none")


def expected(rows):
    """Brute force: walk each key's rows in order."""
    last, out = {}, {}
    for key, second, shard, row, value in sorted(rows, key=lambda r: r[:4]):
        last[key] = value if value is not None else last.get(key)
        out[row] = last[key]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_carry_equals_brute_force(spark, monkeypatch, seed):
    """One key with a third of the rows, a second with most of that, touches few or many."""
    monkeypatch.setattr(carry, "POSITIONS_PER_SLICE", 4)
    monkeypatch.setattr(carry, "SECONDS_PER_SLICE", 10)
    rng = random.Random(seed)
    rows = []
    for row in range(600):
        key = "hot" if row % 3 == 0 else f"k{rng.randrange(60)}"
        second = 0 if rng.random() < 0.5 else rng.randrange(100)
        value = f"v{row}" if rng.random() < (0.02, 0.1, 0.5, 0.9)[seed] else None
        rows.append((key, second, f"file{rng.randrange(2)}", row, value))
    df = spark.createDataFrame(rows, "key string, s bigint, shard string, row bigint, value string")
    want = expected(rows)
    for hot_rows in (carry.HOT_ROWS, 100, 5, 0):
        got = carry.carry_forward(
            df.repartition(3), ["key"], ["s", "shard", "row"], "value", "last", hot_rows=hot_rows
        )
        assert {r["row"]: r["last"] for r in got.collect()} == want


def test_the_sketch_shuffles_no_row_per_key(spark, monkeypatch):
    """Of many keys the hot ones are found, whatever the others, in a few rows per task."""
    monkeypatch.setattr(carry, "SKETCH_ITEMS", 64)
    written = {}
    monkeypatch.setattr(carry, "settle", lambda df: written.setdefault("df", df))
    ids = spark.range(0, 200_000, 1, 8)
    key = F.when(F.col("id") % 4 == 0, F.lit("a")).when(F.col("id") % 50 == 1, F.lit("b")).otherwise(F.col("id").cast("string"))
    hot = carry.hot_keys(ids.select(key.alias("key")), ["key"], 2_000)
    plan = written["df"]._jdf.queryExecution().executedPlan().toString()
    want = {r[0] for r in spark.createDataFrame([("a",), ("b",)], "key string").select(F.xxhash64("key")).collect()}
    assert {r["_key_hash"] for r in hot.collect()} == want
    assert "partial_approx_top_k" in plan and plan.count("Exchange hashpartitioning") == 1
    partial = ids.select(key.alias("key")).groupBy(F.spark_partition_id(), F.pmod(F.xxhash64("key"), F.lit(carry.SKETCHES))).count()
    assert partial.count() <= 8 * carry.SKETCHES


def test_hot_keys_are_looked_up_in_the_visitor_columns_only(spark, tmp_path, monkeypatch):
    """The job before the plan reads ip and user_agent, and runs no pattern on the referrer."""
    plans, look_up = [], attribution.hot_keys
    hits_frame(spark, SAMPLE).write.parquet(str(tmp_path / "hits"))

    def spy(df, keys, hot_rows):
        keyed = df.select(F.xxhash64(*keys))
        plans.append(keyed._jdf.queryExecution().executedPlan().toString())
        return look_up(df, keys, hot_rows)

    monkeypatch.setattr(attribution, "hot_keys", spy)
    stored = spark.read.parquet(str(tmp_path / "hits"))
    assert attributed_purchases(stored, tie=["row"]).count() == 3
    assert re.search(r"ReadSchema: struct<(ip:string,user_agent|user_agent:string,ip):string>", plans[0])
    assert "google" not in plans[0]


def test_hot_keys_are_counted_exactly(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "key string")
    assert carry.hot_keys(df, ["key"], 4).count() == 1
    assert carry.hot_keys(df, ["key"], 5).isEmpty()


def test_column_names(spark):
    upper = spark.createDataFrame([("1",)], "IP string")
    assert normalize_columns(upper).columns == ["ip"]
    with pytest.raises(ValueError, match="only in case"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["a", "b"]).toDF("Ip", "ip"))
    with pytest.raises(ValueError, match="referrer"):
        normalize_hits(upper)
