"""The stored trend: what is read again, ranges of dates, and one pass for the insights."""

from pathlib import Path

import pytest

from touchline.operators import report
from touchline.session import settle
from touchline.sinks.files import write_curated
from touchline.sinks.trend import read_trend, update_trend
from touchline.sources.layers import history_folders, read_history

COLUMNS = "engine_domain string, keyword string, revenue decimal(38,6)"


def run(spark, root, date, rows):
    from decimal import Decimal

    df = spark.createDataFrame([(e, k, Decimal(str(r))) for e, k, r in rows], COLUMNS)
    write_curated(df, root, date, files=1)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def history(spark, tmp_path):
    root = str(tmp_path / "curated")
    run(spark, root, "2024-01-01", [("g", "a", 1.25), ("b", "a", 2), ("g", "c", 3)])
    run(spark, root, "2024-01-02", [("g", "a", 5)])
    run(spark, root, "2024-01-03", [])
    return root, str(tmp_path / "trend")


def test_the_stored_trend_is_that_of_the_history(spark, history):
    root, store = history
    assert update_trend(spark, root, store) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert rows(read_trend(spark, store)) == rows(report.revenue_trend(read_history(spark, root)))
    assert update_trend(spark, root, store) == []
    assert rows(report.period_change(read_trend(spark, store))) == rows(report.period_change(report.revenue_trend(read_history(spark, root))))
    assert [r[0] for r in rows(read_trend(spark, store, since="2024-01-02"))] == ["2024-01-02"]
    assert [r[0] for r in rows(read_trend(spark, store, until="2024-01-01"))] == ["2024-01-01"]


def test_a_new_day_is_all_that_is_read(spark, history):
    root, store = history
    update_trend(spark, root, store)
    before = rows(read_trend(spark, store))
    for file in Path(root).rglob("*.parquet"):  # whoever reads an old day fails
        file.write_bytes(b"no Parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    run(spark, root, "2024-01-04", [("y", "z", 7)])
    assert update_trend(spark, root, store) == ["2024-01-04"]
    assert rows(read_trend(spark, store))[:2] == before
    assert rows(read_trend(spark, store))[2][0] == "2024-01-04"


def test_days_written_again_and_days_that_are_gone(spark, history):
    import shutil

    root, store = history
    update_trend(spark, root, store)
    run(spark, root, "2024-01-02", [("g", "a", 6), ("b", "x", 1)])
    run(spark, root, "2024-01-03", [("g", "a", 2)])
    shutil.rmtree(f"{root}/2024-01-01_SearchKeywordPerformance")
    assert update_trend(spark, root, store) == ["2024-01-02", "2024-01-03"]
    assert rows(read_trend(spark, store)) == rows(report.revenue_trend(read_history(spark, root)))


def test_history_of_a_range(spark, history):
    root, _ = history
    (Path(root) / "nonsense_SearchKeywordPerformance").mkdir()
    assert list(history_folders(spark, root)) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    got = read_history(spark, root, since="2024-01-02", until="2024-01-03")
    assert rows(got) == [("2024-01-02", "g", "a", 5.0)]
    assert all("2024-01-01" not in f for f in got.inputFiles())
    assert read_history(spark, root, since="2030-01-01").count() == 0


def test_nothing_stored_yet(spark, tmp_path):
    assert update_trend(spark, str(tmp_path / "none"), str(tmp_path / "store")) == []
    assert rows(read_trend(spark, str(tmp_path / "store"))) == []


def test_insights_scan_the_totals_once(spark):
    from decimal import Decimal

    data = [("g", f"k{i}", Decimal(i)) for i in range(1, 40)] + [("b", "k1", Decimal(900)), (None, None, None), ("g", None, Decimal(3))]
    totals = settle(spark.createDataFrame(data, COLUMNS))
    for frame in (report.insights(totals), report.recommendations(totals)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6])
def test_metrics_are_those_of_the_frames(spark, n):
    """Against the frames that each give one of them; with equal rows and null keys."""
    from decimal import Decimal

    data = [("g", "k", Decimal(3)), ("g", "k", Decimal(3)), (None, None, Decimal(9)), ("b", "", Decimal(9)), ("g", "z", Decimal(1)), ("c", "y", Decimal(5))]
    df = spark.createDataFrame(data[:n], COLUMNS)
    got = report._metrics(df, None).first()
    kpis = report.report_kpis(df).first()
    assert got.total_revenue == kpis.total_revenue and got.engines == min(2, kpis.total_search_engines)
    top, engine, top5 = report.top_keywords(df, 1).first(), report.engine_metrics(df).first(), report.top5_share(df).first()
    assert (got.top and (got.top.keyword, got.top.search_engine, got.top.revenue)) == (top and (top.keyword, top.search_engine, top.revenue))
    assert (got.engine and (got.engine.engine, got.engine.total_revenue)) == (engine and (engine.engine, engine.total_revenue))
    assert got.top5 == (top5 and top5.top5_revenue)
