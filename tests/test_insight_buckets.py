"""The insight table in buckets: same results as one upsert over everything, less read and written."""

import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from touchline.fixed_values import INSIGHT_TABLE
from touchline.operators.tables import INSIGHT_SCHEMA, upsert_insights
from touchline.sinks.tables import read_insights, read_manifest, sync_insights


def moment(hour):
    return datetime(2024, 1, 2, hour, tzinfo=timezone.utc)


def totals(spark, rows):
    return spark.createDataFrame([(e, k, float(r)) for e, k, r in rows], "engine_domain string, keyword string, revenue double")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def part_files(root):
    return {str(f): f.stat().st_mtime_ns for f in Path(root, INSIGHT_TABLE, "data").rglob("*.parquet")}


@pytest.mark.parametrize("buckets", [7])
def test_same_as_one_upsert_over_all_rows(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    keys = [(f"e{i % 3}.com", f"k{i}") for i in range(30)]
    want = spark.createDataFrame([], INSIGHT_SCHEMA)
    for hour in range(4):
        batch = totals(spark, [(*key, rng.randrange(1, 900)) for key in rng.sample(keys, 8)] if hour != 2 else [])
        sync_insights(batch, str(tmp_path), moment(hour), buckets=buckets)
        now = F.timestamp_seconds(F.lit(int(moment(hour).timestamp())))
        # Collected, so that each round starts from values.
        want = spark.createDataFrame(upsert_insights(want, batch, now).collect(), INSIGHT_SCHEMA)
        assert rows(read_insights(spark, str(tmp_path))) == rows(want)
    manifest = read_manifest(spark, f"{tmp_path}/{INSIGHT_TABLE}")
    assert manifest.highest == want.count() == sum(n for _, n in manifest.writes.values())


def test_one_key_reads_and_rewrites_one_bucket(spark, tmp_path):
    root = str(tmp_path)
    many = [("e.com", f"k{i}", i + 1) for i in range(40)]
    sync_insights(totals(spark, many), root, moment(1), buckets=16)
    before = part_files(root)
    assert len({Path(f).parent.name for f in before}) > 10
    path = f"{root}/{INSIGHT_TABLE}"
    bucket = totals(spark, [("e.com", "new", 5)]).select(
        F.pmod(F.xxhash64("engine_domain", "keyword"), F.lit(16)).alias("b")
    ).first()["b"]
    for file in before:  # whoever reads another bucket now fails
        if Path(file).parent.name != f"bucket={bucket}":
            Path(file).write_bytes(b"not Parquet")
            (Path(file).parent / f".{Path(file).name}.crc").unlink(missing_ok=True)
    untouched = part_files(root)
    sync_insights(totals(spark, [("e.com", "new", 5)]), root, moment(2), buckets=16)
    after = part_files(root)
    assert {f: t for f, t in after.items() if f in untouched} == untouched
    assert {Path(f).parent for f in after.keys() - untouched.keys()} == {Path(path, "data", "write=2", f"bucket={bucket}")}
    manifest = read_manifest(spark, path)
    assert manifest.version == 2 and manifest.highest == 41 and manifest.buckets == 16
    assert {b for b, (write, _) in manifest.writes.items() if write == 2} == {bucket}


def test_number_of_buckets_stays(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/{INSIGHT_TABLE}"
    sync_insights(totals(spark, [("e", "a", 1)]), root, moment(1), buckets=4)
    sync_insights(totals(spark, [("e", "a", 2), ("e", "b", 3)]), root, moment(2), buckets=99)
    assert read_manifest(spark, path).buckets == 4
    assert sorted((r.keyword_id, r.revenue_impact_score) for r in read_insights(spark, root).collect()) == [(1, 2.0), (2, 3.0)]


def test_a_failed_write_changes_nothing_and_old_states_go(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/{INSIGHT_TABLE}"
    for hour in (1, 2, 3, 4):
        sync_insights(totals(spark, [("e", f"k{hour}", hour), ("e", "all", hour)]), root, moment(hour), buckets=3)
    kept = rows(read_insights(spark, root))
    Path(path, "manifest", "version=5").mkdir()  # a manifest that wasn't finished, and data of it
    Path(path, "data", "write=5", "bucket=0").mkdir(parents=True)
    assert rows(read_insights(spark, root)) == kept
    sync_insights(totals(spark, [("e", "k9", 9)]), root, moment(5), buckets=3)
    assert len(rows(read_insights(spark, root))) == len(kept) + 1
    assert {p.name for p in Path(path, "manifest").glob("version=*")} == {"version=4", "version=5"}
    used = set(read_manifest(spark, path, 4).folders(path)) | set(read_manifest(spark, path, 5).folders(path))
    assert {str(p) for p in Path(path, "data").glob("write=*/bucket=*")} == used


def test_no_totals_at_all(spark, tmp_path):
    sync_insights(totals(spark, []), str(tmp_path), moment(1))
    sync_insights(totals(spark, []), str(tmp_path), moment(2))
    assert read_insights(spark, str(tmp_path)).count() == 0
