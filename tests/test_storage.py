import re
import uuid
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_attribution import SAMPLE, hits_frame
from touchline import session
from touchline.fixed_values import REQUIRED_HIT_COLUMNS
from touchline.operators import tables
from touchline.operators.checks import check_sinks, require_synced
from touchline.operators.normalize import earliest_partition
from touchline.operators.revenue import keyword_totals
from touchline.plans.batch import run_batch, search_revenue
from touchline.session import persisted, remove_shared, settle, settled, shared_folder, shared_root
from touchline.sinks import files
from touchline.sinks import tables as stored
from touchline.sources import landing, layers
from touchline.streaming import incremental
from touchline.streaming.incremental import object_totals, run_incremental

HEADER = "hit_time_gmt\tdate_time\tuser_agent\tip\tevent_list\tgeo_city\tgeo_region\tgeo_country" \
         "\tpagename\tpage_url\tproduct_list\treferrer"


def tsv(rows, header=HEADER):
    lines = [header]
    for time, ip, events, products, referrer in rows:
        lines.append(
            f"{time}\t\tMozilla/5.0\t{ip}\t{events}\tSalem\tOR\tUS\tHome\thttp://shop/"
            f"\t{products}\t{referrer}"
        )
    return "\n".join(lines) + "\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


WANT = [("google.com", "ipod", 480.0), ("bing.com", "zune", 250.0)]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_tsv_and_parquet_give_the_same(spark, tmp_path):
    put(tmp_path / "tsv" / "deep" / "sample.tsv", tsv(SAMPLE))
    src, dst = str(tmp_path / "tsv"), str(tmp_path / "parquet")
    assert rows(search_revenue(landing.read_hits(spark, src, "tsv"))) == WANT
    landing.convert_tsv_to_parquet(spark, src, dst)
    assert dict(spark.read.parquet(dst).dtypes)["hit_time_gmt"] == "bigint"
    assert rows(search_revenue(landing.read_hits(spark, dst))) == WANT
    with pytest.raises(ValueError):
        landing.read_hits(spark, src, "csv")


def test_split_over_files(spark, tmp_path):
    for i, row in enumerate(SAMPLE):
        put(tmp_path / f"part-{i}.tsv", tsv([row]))
    assert rows(search_revenue(landing.read_hits(spark, str(tmp_path), "tsv"))) == WANT


def test_short_rows_and_quotes(spark, tmp_path):
    text = tsv([("1", "1.1.1.1", '"1,2"', "c;p;1;5;", "http://www.bing.com/?q=a")]) + "5\tx\tua\n"
    put(tmp_path / "a.tsv", text)
    hits = landing.read_hits(spark, str(tmp_path), "tsv").orderBy("hit_ts").collect()
    assert hits[0]["event_list"] == "1,2"
    assert hits[1]["ip"] == "" and hits[1]["referrer"] == ""


def test_other_header_fails(spark, tmp_path):
    put(tmp_path / "a.tsv", tsv(SAMPLE))
    turned = "\t".join(reversed(HEADER.split("\t")))
    put(tmp_path / "b.tsv", tsv(SAMPLE, turned))
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_hits(spark, str(tmp_path), "tsv").collect()


def test_conversion_needs_rows(spark, tmp_path):
    put(tmp_path / "a.tsv", HEADER + "\n")
    with pytest.raises(ValueError, match="no data rows"):
        landing.convert_tsv_to_parquet(spark, str(tmp_path), str(tmp_path / "out"))


def test_scan_path():
    assert landing.scan_path("/a/", None, "06", "15") == "/a"
    assert landing.scan_path("/a", "2024-01-01", None, "99") == "/a/dt=2024-01-01"
    assert landing.scan_path("/a", "2024-01-01", "6", "15") == "/a/dt=2024-01-01/hour=06/minute=15"
    with pytest.raises(ValueError, match="minute"):
        landing.scan_path("/a", "2024-01-01", "6", "10", 15)


def test_objects_that_disagree(spark, tmp_path):
    """Numbers in one file, text in another, and a tab-separated one with an extra column."""
    base = hits_frame(spark, SAMPLE).drop("hit_ts", "row")
    numbers = base.limit(0).union(base).withColumns(
        {"hit_time_gmt": F.col("hit_time_gmt").cast("bigint")}
    )
    base.where("event_list = ''").coalesce(1).write.parquet(str(tmp_path / "a"))
    numbers.where("event_list = '1'").coalesce(1).write.parquet(str(tmp_path / "b"))
    paths = [str(p) for d in "ab" for p in (tmp_path / d).glob("*.parquet")]
    paths.append(put(tmp_path / "c.tsv", tsv(SAMPLE[1:2])))
    hits = landing.read_objects(spark, paths)
    assert hits.count() == len(SAMPLE)
    assert rows(search_revenue(hits)) == WANT


def test_staging_keeps_other_days_and_text_labels(spark, tmp_path):
    path = str(tmp_path)
    hits = hits_frame(spark, SAMPLE)
    files.write_staging(hits, path, interval=15)
    labels = {(r["dt"], r["hour"], r["minute"]) for r in layers.read_staging(spark, path).collect()}
    assert labels == {("2009-09-27", "06", "30"), ("2009-09-27", "06", "45"), ("2009-09-27", "07", "00")}
    late = hits_frame(spark, [("86400", "1.1.1.1", "", "", "")])
    files.write_staging(late, path, n=2, source="late")
    files.write_staging(late, path, source="late")
    assert layers.read_staging(spark, path).count() == len(SAMPLE) + 1
    assert layers.read_staging(spark, path, dt="2009-09-27", hour=7).count() == 2
    assert "67.98.123.xxx" in {r["ip"] for r in layers.read_staging(spark, path).collect()}
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = layers.read_staging(spark, path, dt="2009-09-27")._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ = 2009-09-27", plan)
    with pytest.raises(ValueError):
        files.write_staging(late, path, n=-1)


def test_a_staged_source_is_replaced_and_no_other(spark, tmp_path):
    path = str(tmp_path)
    files.write_staging(hits_frame(spark, SAMPLE), path, source="a")
    files.write_staging(hits_frame(spark, SAMPLE[:1]), path, source="b")
    assert layers.read_staging(spark, path).count() == len(SAMPLE) + 1
    files.write_staging(hits_frame(spark, SAMPLE[-1:]), path, source="a")
    assert layers.read_staging(spark, path).count() == 2
    assert landing.read_hits(spark, path).count() == 2


def test_inferred_partition_types_are_text_again(spark, tmp_path):
    files.write_staging(hits_frame(spark, SAMPLE), str(tmp_path))
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(key, "true")
    try:
        hours = {r["hour"] for r in layers.read_staging(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set(key, "false")
    assert hours == {"06", "07"}


def totals(spark):
    return spark.createDataFrame(WANT, "engine_domain string, keyword string, revenue double")


@pytest.mark.parametrize("parts", [None, 1, 2])
def test_curated(spark, tmp_path, parts):
    path = files.write_curated(totals(spark), str(tmp_path), "2024-01-05", parts)
    assert path.endswith("/2024-01-05_SearchKeywordPerformance")
    assert spark.read.parquet(path).columns == ["Search Engine Domain", "Search Keyword", "Revenue"]
    assert sorted(rows(layers.read_curated(spark, str(tmp_path), "2024-01-05"))) == sorted(WANT)
    assert layers.output_exists(spark, str(tmp_path), "2024-01-05")
    assert not layers.output_exists(spark, str(tmp_path), "2024-01-06")
    assert not layers.output_exists(spark, str(tmp_path / "none"), "2024-01-06")
    files.write_curated(totals(spark), str(tmp_path), "2024-01-06")
    assert {r["date"] for r in layers.read_history(spark, str(tmp_path)).collect()} == {
        "2024-01-05", "2024-01-06",
    }
    if parts is None:
        assert len(list(Path(path).glob("*.parquet"))) == 1
        assert rows(spark.read.parquet(path)) == WANT


def test_curated_missing_or_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        layers.read_curated(spark, str(tmp_path), "2024-01-05")
    files.write_curated(totals(spark).limit(0), str(tmp_path), "2024-01-05")
    with pytest.raises(ValueError):
        layers.read_curated(spark, str(tmp_path), "2024-01-05")
    with pytest.raises(ValueError):
        files.write_curated(totals(spark), str(tmp_path), "2024-01-05", files=0)


def test_tab(spark, tmp_path):
    path = files.write_tab(totals(spark), str(tmp_path), "2024-01-05")
    text = "".join(p.read_text() for p in Path(path).glob("part-*"))
    assert text.splitlines() == [
        "Search Engine Domain\tSearch Keyword\tRevenue", "google.com\tipod\t480.00",
        "bing.com\tzune\t250.00",
    ]


def test_earliest_partition(spark):
    hits = hits_frame(spark, [("1254033280", "", "", "", ""), ("bad", "", "", "", "")])
    assert tuple(earliest_partition(hits).first()) == (0, "1970-01-01", "00", "00")
    assert earliest_partition(hits, ignore_zero=True).first()["minute"] == "30"
    assert earliest_partition(hits.limit(0)).first()["dt"] == files.utc_today()


def test_object_stem(spark):
    names = ["file:/x/a.b.tsv", "/x/.hidden", "plain", "file:/x/a%20b+c.parquet"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, p string")
    found = df.select(files.object_stem(F.col("p"))).collect()
    assert [r[0] for r in found] == ["a.b", ".hidden", "plain", "a b+c"]


def landed_stream(tmp_path):
    put(tmp_path / "landing" / "x" / "one.tsv", tsv(SAMPLE))
    searched = [("10", "10.0.0.1", "", "", "http://www.bing.com/?q=a")]
    bought = [("20", "10.0.0.2", "1", "c;p;1;5;", "http://shop/")]
    put(tmp_path / "landing" / "two.tsv", tsv(searched))
    put(tmp_path / "landing" / "three.tsv", tsv(bought))
    put(tmp_path / "landing" / "four.tsv", tsv(searched + bought))


def test_stream_equals_one_file_at_a_time(spark, tmp_path):
    landed_stream(tmp_path)
    where = [str(tmp_path / d) for d in ("landing", "out", "checkpoint")]

    def run():
        run_incremental(
            spark, *where, run_date="2024-01-05", max_files=2, identity="masked"
        ).awaitTermination()
        found = spark.read.parquet(where[1]).collect()
        assert all(r["output"].endswith("_2024-01-05_SearchKeywordPerformance") for r in found)
        return {(*r[:6], r["output"].split("_")[0]) for r in found}

    first = run()
    assert first == {
        ("google.com", "ipod", 480.0, "2009-09-27", "06", "30", "one"),
        ("bing.com", "zune", 250.0, "2009-09-27", "06", "30", "one"),
        ("bing.com", "a", 5.0, "1970-01-01", "00", "00", "four"),
    }
    put(tmp_path / "landing" / "five.tsv", tsv(SAMPLE[:1] + SAMPLE[-1:]))
    assert run() - first == {
        ("google.com", "ipod", 290.0, "2009-09-27", "06", "30", "five")
    }


def test_one_large_file_is_spread(spark, tmp_path, monkeypatch):
    """Rows of a file with one row group, which one task reads, are many tasks' after that."""
    searched = F.concat(F.lit("http://www.google.com/search?q="), F.sha2(F.col("id").cast("string"), 512))
    cells = {"hit_time_gmt": F.col("id").cast("string"), "ip": F.lit("10.0.0.1"), "referrer": searched}
    rows = spark.range(0, 40_000, 1, 1).select(
        *((cells.get(c, F.lit("")).alias(c)) for c in REQUIRED_HIT_COLUMNS)
    )
    rows.write.parquet(str(tmp_path / "landing"))
    seen = []
    monkeypatch.setattr(
        incremental, "write_object_curated", lambda totals, hits, *_: seen.append((len(hits.inputFiles()), hits.count()))
    )
    run_incremental(spark, *(str(tmp_path / d) for d in ("landing", "out", "c"))).awaitTermination()
    assert seen[0][0] > 1 and seen[0][1] == 40_000


def test_flat_object_output(spark, tmp_path):
    landed_stream(tmp_path)
    run_incremental(
        spark, str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "c"),
        run_date="2024-01-05", partitioned=False, identity="raw",
    ).awaitTermination()
    assert {r["output"][:3] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"one"}


def test_an_object_leaves_its_earlier_folders(spark, tmp_path):
    """Another earliest time, another run date, and no revenue any more."""
    root = str(tmp_path)

    def write(rows, day):
        hits = hits_frame(spark, rows).withColumn("source_file", F.lit("s3://b/x/one.tsv"))
        found = object_totals(hits.withColumn("source_row", F.col("row")))
        files.write_object_curated(found, hits, root, day)
        return {p.parent.name for p in tmp_path.glob("dt=*/**/part-*")}

    first = write(SAMPLE, "2024-01-05")
    assert len(first) == 1
    second = write(SAMPLE[1:], "2024-01-06")
    assert len(second) == 1 and second != first
    assert write(SAMPLE[:1], "2024-01-06") == set()


def insights(spark, data):
    kinds = "keyword_id bigint, search_engine_domain string, search_keyword string," \
            " revenue_impact_score double, last_processed_at timestamp"
    old = datetime(2020, 1, 1)
    return spark.createDataFrame([(*row, old) for row in data], kinds)


def test_dedupe_keeps_the_latest(spark):
    df = insights(spark, [(1, "e", "k", 1.0), (3, "e", "k", 3.0), (2, "e", "x", 2.0),
                          (4, None, "k", 4.0), (5, None, "k", 5.0)])
    assert sorted(r["keyword_id"] for r in tables.dedupe_insights(df).collect()) == [2, 3, 4, 5]


def test_upsert(spark):
    existing = insights(spark, [(1, "e", "k", 1.0), (7, "e", "k", 3.0), (2, "e", "x", 2.0)])
    new = spark.createDataFrame(
        [("e", "k", 9.0), ("f", "k", 1.0), ("g", "k", 2.0)],
        "engine_domain string, keyword string, revenue double",
    )
    now = F.lit("2024-01-05 00:00:00").cast("timestamp")
    found = {
        (r[1], r[2]): (r[0], r[3], r[4].year)
        for r in tables.upsert_insights(existing, new, now).collect()
    }
    assert found[("e", "k")] == (7, 9.0, 2024)
    assert found[("e", "x")] == (2, 2.0, 2020)
    assert {found[("f", "k")][0], found[("g", "k")][0]} == {8, 9}


def test_numbers_are_consecutive(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    numbers = tables.number_rows(df, ["k"], "n").agg(
        F.min("n"), F.max("n"), F.count_distinct("n")
    ).first()
    assert tuple(numbers) == (1, 5000, 5000)


def test_batch_and_tables(spark, tmp_path):
    put(tmp_path / "landing" / "sample.tsv", tsv(SAMPLE))
    where = {name: str(tmp_path / name) for name in ("curated", "staging", "tables")}
    now = datetime(2024, 1, 5, 12, tzinfo=timezone.utc)

    def run(day, moment):
        return run_batch(
            spark, str(tmp_path / "landing"), fmt="tsv", run_date=day, now=moment, **where
        )

    path = run("2024-01-05", now)
    assert rows(spark.read.parquet(path)) == WANT
    run("2024-01-05", now.replace(hour=13))
    run("2024-01-06", now.replace(day=6))
    facts = stored.read_facts(spark, where["tables"])
    assert facts.count() == 4
    assert facts.dtypes[-1][1] == "decimal(18,2)" or "decimal(18,2)" in dict(facts.dtypes).values()
    kept = stored.read_insights(spark, where["tables"])
    assert sorted(r["keyword_id"] for r in kept.collect()) == [1, 2]
    seen = F.lit("2024-01-06 13:00:00").cast("timestamp")
    checked = check_sinks(facts, kept, "2024-01-06", seen)
    assert tuple(checked.first()) == (2, 2)
    require_synced(checked)
    with pytest.raises(ValueError, match="no facts"):
        require_synced(check_sinks(facts, kept, "2030-01-01", seen))
    with pytest.raises(ValueError, match="no insights"):
        late = F.lit("2024-01-07 00:00:00").cast("timestamp")
        require_synced(check_sinks(facts, kept, "2024-01-06", late))
    assert layers.read_staging(spark, where["staging"]).count() == len(SAMPLE)


def test_facts_of_a_day_without_results(spark, tmp_path):
    root = str(tmp_path)
    stored.sync_facts(totals(spark), root, "2024-01-05")
    stored.sync_facts(totals(spark), root, "2024-01-06")
    stored.sync_facts(totals(spark).limit(0), root, "2024-01-05", skip_if_empty=True)
    assert stored.read_facts(spark, root).count() == 4
    stored.sync_facts(totals(spark).limit(0), root, "2024-01-05")
    assert stored.read_facts(spark, root).count() == 2
    replaced = tables.replace_date(
        stored.read_facts(spark, root), tables.to_facts(totals(spark).limit(0), "2024-01-06"),
        "2024-01-06",
    )
    assert replaced.count() == 0
    with pytest.raises(ValueError):
        stored.sync_facts(totals(spark), root, "2024-01-05", table="a; drop table b")


def test_shared_root():
    def settings(**given):
        return lambda key: given.get(key.replace("spark.", "").replace(".", "_"))

    set_ = settings(checkpoint_dir="s3a://b/c/", sql_warehouse_dir="/w")
    assert shared_root(set_, "yarn") == "s3a://b/c"
    assert shared_root(settings(sql_warehouse_dir="file:/w"), "local[8]").startswith("file:/w/")
    assert shared_root(settings(sql_warehouse_dir="hdfs://n/w"), "yarn").startswith("hdfs://n/w/")
    for local in ("file:/w", "/w", "w", ""):
        for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
            with pytest.raises(ValueError):
                shared_root(settings(sql_warehouse_dir=local), master)


def test_shared_folders_are_removed(spark):
    df = spark.range(3)
    with settled(df) as kept:
        assert kept.count() == 3
        where = Path(kept.inputFiles()[0].removeprefix("file:")).parent
        assert where.exists()
    assert not where.exists()
    other = Path(settle(df).inputFiles()[0].removeprefix("file:")).parent
    assert other.parent == Path(shared_folder(spark)).parent
    remove_shared(spark)
    assert not other.exists()


def test_settled_and_persisted(spark):
    df = keyword_totals(totals(spark))
    assert sorted(rows(settle(df))) == sorted(rows(df))
    with persisted(df) as kept:
        assert kept.is_cached
    assert not kept.is_cached
    with persisted(df, enabled=False) as same:
        assert same is df


def tables_below(folder):
    return {str(p.parent) for p in Path(folder).rglob("part-*.parquet")}


def test_scratch_leaves_what_is_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    df = spark.range(5)
    with session.scratch(spark):
        session.settle(df)
        with session.scratch(spark):
            inner = session.settle(session.settle(df).where("id > 1"), keep=True)
            assert len(tables_below(tmp_path)) == 3
        assert len(tables_below(tmp_path)) == 2 and inner.count() == 3
        outer = session.settle(inner.where("id > 2"), keep=True)
    assert len(tables_below(tmp_path)) == 1 and outer.count() == 2
    with pytest.raises(RuntimeError), session.scratch(spark):
        session.settle(df)
        raise RuntimeError
    assert len(tables_below(tmp_path)) == 1
    assert session.settle(df).count() == 5
