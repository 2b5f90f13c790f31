import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchline.operators import report
from touchline.operators.revenue import keyword_totals

ROWS = [
    ("google.com", "ipod", 480.0), ("bing.com", "zune", 250.0), ("yahoo.com", "cd player", 150.0),
    ("google.com", "mp3 player", 120.0), ("bing.com", "music player", 80.0),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "engine_domain string, keyword string, revenue double")


def history(spark, *days):
    rows = [(day, "e", "k", revenue) for day, revenue in days]
    return spark.createDataFrame(
        rows, "date string, engine_domain string, keyword string, revenue double"
    )


def rules(df):
    return [r["rule"] for r in sorted(df.collect(), key=lambda r: r["pos"])]


def texts(df):
    return [r["text"] for r in sorted(df.collect(), key=lambda r: r["pos"])]


def test_kpis(spark):
    assert tuple(report.report_kpis(frame(spark, ROWS)).first()) == (1080.0, 5, 3, 216.0)
    assert tuple(report.report_kpis(frame(spark, [])).first()) == (0.0, 0, 0, 0.0)


def test_top_and_bottom(spark):
    top = report.top_keywords(frame(spark, ROWS)).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert [round(r["revenue_percentage"], 2) for r in top] == [44.44, 23.15, 13.89, 11.11, 7.41]
    assert report.bottom_keywords(frame(spark, ROWS)).collect() == top


def test_bottom_is_ranked_within_its_slice(spark):
    many = frame(spark, [("e", f"k{i:02d}", float(i)) for i in range(25)])
    bottom = report.bottom_keywords(many).collect()
    assert [r["keyword"] for r in bottom] == [f"k{i:02d}" for i in range(9, -1, -1)]
    assert [r["rank"] for r in bottom] == list(range(1, 11))


def test_ties_have_an_order(spark):
    same = frame(spark, [("b", "y", 1.0), ("a", "z", 1.0), ("a", "x", 1.0)])
    assert [r["keyword"] for r in report.top_keywords(same).collect()] == ["x", "z", "y"]
    assert [r["keyword"] for r in report.bottom_keywords(same, 2).collect()] == ["z", "y"]


def test_engines(spark):
    found = [
        (r[0], r[1], round(r[2], 2), r[3], r[4])
        for r in report.engine_metrics(frame(spark, ROWS)).collect()
    ]
    assert found == [
        ("google.com", 600.0, 55.56, 2, 300.0), ("bing.com", 330.0, 30.56, 2, 165.0),
        ("yahoo.com", 150.0, 13.89, 1, 150.0),
    ]


def test_insights_of_the_sample(spark):
    df = frame(spark, ROWS)
    assert texts(report.insights(df)) == [
        "Strong revenue performance with $1080.00 total revenue",
        "Top performing keyword 'ipod' on google.com generated $480.00 (44.4% of total)",
        "High concentration: top 5 keywords drive most revenue",
    ]
    assert rules(report.recommendations(df)) == ["concentration_high"]


@pytest.mark.parametrize(
    "days, rule, advice",
    [
        ([("d1", 100.0), ("d2", 116.0)], "growth_excellent", ["growth_excellent"] * 2),
        ([("d1", 100.0), ("d2", 115.0)], "growth", []),
        ([("d1", 100.0), ("d2", 100.0)], "decline", []),
        ([("d1", 100.0), ("d2", 80.0)], "decline", []),
        ([("d1", 100.0), ("d2", 79.0)], "drop_concerning", ["drop_concerning"] * 2),
        ([("d0", 1.0), ("d1", 0.0), ("d2", 5.0)], None, []),
        ([("d2", 5.0)], None, []),
    ],
)
def test_trend_rules(spark, days, rule, advice):
    df, past = frame(spark, ROWS), history(spark, *days)
    found = rules(report.insights(df, past))
    assert found == ["rev_strong", "top_keyword", *([rule] if rule else []), "concentration_high"]
    assert rules(report.recommendations(df, past)) == [*advice, "concentration_high"]


def test_low_revenue_and_one_engine(spark):
    df = frame(spark, [("bing.com", "High concentration", 50.0)])
    assert rules(report.insights(df)) == ["rev_low", "dominance"]
    assert rules(report.recommendations(df)) == ["rev_low", "rev_low", "one_engine"]
    assert rules(report.insights(frame(spark, []))) == ["rev_low"]
    worthless = frame(spark, [("bing.com", "x", 0.0)])
    assert rules(report.insights(worthless)) == ["rev_low", "single_engine"]
    moderate = frame(spark, [("bing.com", "x", 900.0), ("ask.com", "y", 100.0)])
    assert rules(report.insights(moderate)) == ["rev_moderate", "top_keyword", "dominance"]
    assert texts(report.recommendations(moderate)) == [
        "Explore opportunities on other search engines to reduce bing.com dependency"
    ]


def test_diversity(spark):
    even = frame(spark, [(f"e{i % 2}", f"k{i}", 10.0) for i in range(20)])
    assert rules(report.insights(even)) == ["rev_moderate", "diversity_good"]


def test_trend(spark):
    rows = [("d2", "e", "k", 3.0), ("d1", "e", "k", 1.0), ("d1", "f", "k", 2.0), (None, "e", "x", 4.0)]
    df = spark.createDataFrame(
        rows, "date string, engine_domain string, keyword string, revenue double"
    )
    assert [tuple(r) for r in report.revenue_trend(df).collect()] == [
        ("d1", 3.0, 1, 2, 3.0), ("d2", 3.0, 1, 1, 3.0), ("unknown", 4.0, 1, 1, 4.0),
    ]


def test_chart_labels(spark):
    df = frame(spark, [("e", "x" * 40, 2.345)])
    days = [(f"2024-01-{d:02d}", 1.0) for d in range(1, 32)]
    chart = report.chart_series(
        report.top_keywords(df), report.engine_metrics(df),
        report.revenue_trend(history(spark, *days)),
    ).collect()
    keyword = next(r for r in chart if r["series"] == "keywords")
    assert (keyword["label"], keyword["full_label"]) == ("x" * 40, "x" * 40 + " (e)")
    assert sorted(r["pos"] for r in chart if r["series"] == "trend") == list(range(1, 32))
    cut = report.chart_series(
        report.top_keywords(df), report.engine_metrics(df),
        report.revenue_trend(history(spark, *days)), top=0, dates=2, label_chars=3,
    ).collect()
    assert {r["label"] for r in cut} == {"e", "2024-01-30", "2024-01-31"}


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 1e12, -1e12 + 0.07, 2.675, 0.005] * 40
    df = frame(spark, [("e", f"k{i % 7}", v) for i, v in enumerate(values)])
    found = {
        tuple(map(str, report.engine_metrics(keyword_totals(df.repartition(n).orderBy(F.rand(n)))).first()))
        for n in (1, 3, 8)
    }
    assert len(found) == 1
    with pytest.raises(Exception, match="out of range"):
        keyword_totals(frame(spark, [("e", "k", 1e300)])).collect()


def test_halves_round_up(spark):
    df = frame(spark, [("e", f"k{i}", v) for i, v in enumerate((6532.965 * 4 - 3, 1.0, 1.0, 1.0))])
    assert report.engine_metrics(df).first()["avg_revenue_per_keyword"] == 6532.97


def test_report_as_json(spark, tmp_path):
    path = report.write_report_json(
        report.build_report(frame(spark, ROWS), run_date="2024-01-05", now=datetime(2024, 1, 5)), str(tmp_path), "2024-01-05"
    )
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    found = json.loads(text)
    assert found["report_date"] == "2024-01-05"
    assert found["data_partition"] is None
    assert found["total_keywords"] == 5
    assert [k["keyword"] for k in found["top_keywords"]][:2] == ["ipod", "zune"]
    assert [e["engine"] for e in found["search_engines"]] == ["google.com", "bing.com", "yahoo.com"]
    assert found["revenue_trend"] == []
    assert len(found["insights"]) == 3 and len(found["recommendations"]) == 1


def test_json_amounts_have_no_exponent(spark):
    """Plain digits from ten millions on; texts that look like amounts stay."""
    odd = 'x\n  "revenue" : 1.50,\n'
    rows = [("a.com", odd, 87552462.5), ("b.com", "k", 12345678901.25), ("c.com", "l", -0.1), ("d.com", "m", 30_000_000.0)]
    text = report.report_json(report.build_report(frame(spark, rows), history(spark, ("2024-01-01", 2e7)))).first()["json"]
    found = json.loads(text)
    assert [k["keyword"] for k in found["top_keywords"]] == ["k", odd, "m", "l"]
    assert [k["revenue"] for k in found["top_keywords"]] == [12345678901.25, 87552462.5, 30000000.0, -0.1]
    for plain in ('"total_revenue" : 12463231363.65,', '"revenue" : 87552462.5,', '"revenue" : 30000000.0,', '"total_revenue" : 20000000.0,', '"revenue" : -0.1,'):
        assert plain in text
