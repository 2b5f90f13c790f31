import random
from urllib.parse import parse_qsl, urlsplit

import pytest
from pyspark.sql import functions as F

from touchline.functions import clock, privacy, products, url

TOUCHES = [
    ("http://www.google.com/search?hl=en&q=Ipod", ("google.com", "ipod")),
    ("http://www.bing.com/search?q=Zune&form=QBLH", ("bing.com", "zune")),
    ("http://search.yahoo.com/search?p=cd+player&ei=UTF-8", ("yahoo.com", "cd player")),
    ("https://www.google.co.uk/search?q=Ipod", ("co.uk", "ipod")),
    ("http://www.esshopzilla.com/product/?pid=123", None),
    ("", None),
    ("http://www.google.com/", None),
    ("http://www.google.com/search?q=Laffy%20Taffy", ("google.com", "laffy taffy")),
    ("http://www.google.com/search?q=a b", ("google.com", "a b")),
    ("www.google.com/search?q=x", None),
    ("//www.google.com/search?q=x", ("google.com", "x")),
    ("http://u:p@WWW.google.com:80/?q=a&q=b", ("google.com", "a")),
    (" http://www.google.com/?q=1", ("google.com", "1")),
    ("http://[::1", None),
    ("http://[google.com]/?q=x", None),
    ("http://www.google.com./?q=a", ("com.", "a")),
    ("http://www.google.com?q=a;b&c", ("google.com", "a;b")),
    ("http://www.google.com/?q=&q=b", ("google.com", "b")),
    ("http://www.google.com/?q=%20&q=b", None),
    ("http://www.google.com/?q=%C2%A0", None),
    ("http://www.google.com/?%71=enc", ("google.com", "enc")),
    ("http://www.google.com/?Q=up", None),
    ("http://www.google.com/#?q=frag", None),
    ("http://www.google.com/?q", None),
    ("http://www.google.com/?q=%E4", ("google.com", "�")),
    ("http://www.google.com/?q=50%", ("google.com", "50%")),
    ("http://search_x.yahoo.com/?p=1", ("yahoo.com", "1")),
    ("http://flask.example.com/?ask=hi", ("example.com", "hi")),
    ("http://www.ask.com/?q=&ask=Two", ("ask.com", "two")),
    ("http://www.ask.com/?ask=Two&q=%20", ("ask.com", "two")),
    ("http://www.baidu.com/s?wd=%20&word=B%2Bc", ("baidu.com", "b+c")),
    ("http://google/?q=z", ("google", "z")),
    ("http://www.aol.com/s?query=A%26B", ("aol.com", "a&b")),
    ("http://ask.google.com/?ask=x", None),
    ("http://bing.google.com/?q=x", ("google.com", "x")),
    ("http://shop.com/?q=http://www.google.com", None),
    ("http://www.google.com/search?q=a=b", ("google.com", "a=b")),
    ("android-app://com.google/?q=z", ("com.google", "z")),
    ("http://www.google.com/?q=caf%C3%A9+X", ("google.com", "café x")),
    ("http://www.goo\tgle.com/?q=tab", ("google.com", "tab")),
    ("http://www.google.com/?" + "a=b&" * 20000 + "q=far", ("google.com", "far")),
    (None, None),
]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")



def by_index(df):
    return [row["r"] for row in sorted(df.collect(), key=lambda row: row["i"])]


def pairs(structs):
    return [tuple(s) if s is not None else None for s in structs]


def test_referrers_staged(spark):
    df = column(spark, [u for u, _ in TOUCHES])
    found = by_index(url.with_touch(df, "v").select("i", F.col("touch").alias("r")))
    assert pairs(found) == [want for _, want in TOUCHES]


def test_referrers_as_expression(spark):
    df = column(spark, [u for u, _ in TOUCHES])
    found = by_index(df.select("i", url.parse_search_referrer(F.col("v")).alias("r")))
    assert pairs(found) == [want for _, want in TOUCHES]


def test_first_filter_keeps_every_search(spark):
    urls = [u for u, want in TOUCHES if want]
    kept = by_index(column(spark, urls).select("i", url.is_search_like(F.col("v")).alias("r")))
    assert all(kept)


def test_label_match(spark):
    urls = ["http://flask.example.com/?ask=hi", "http://www.ask.com/?ask=hi"]
    df = url.with_touch(column(spark, urls), "v", match="label")
    assert pairs(by_index(df.select("i", F.col("touch").alias("r")))) == [None, ("ask.com", "hi")]


@pytest.mark.parametrize("seed", range(3))
def test_host_and_query_equal_the_standard_library(spark, seed):
    rng = random.Random(seed)

    def text(alphabet, most):
        return "".join(rng.choice(alphabet) for _ in range(rng.randrange(most)))

    urls = [
        (rng.choice(["http://", "//", "x-y:", "a.b", " HTTP://"]) + text("abG.@:/ %41", 15)
         + rng.choice(["", "?"]) + text("aq=&?#/:+%41E ", 25)).strip()
        for _ in range(2000)
    ]
    df = column(spark, urls).select(
        "i", F.struct(url.url_host(F.col("v")), url.query_pairs(F.col("v"))).alias("r")
    )
    for given, (host, found) in zip(urls, by_index(df)):
        split = urlsplit(given)
        assert host == ((split.hostname or "").lower() or None), given
        assert [tuple(p) for p in found] == parse_qsl(split.query), given


@pytest.mark.parametrize(
    "products_, want",
    [
        ("Electronics;Zune - 32GB;1;250;", 250.0),
        ("Computers;HP Pavillion;1;1000;200|201,Office Supplies;Red Folders;4;4.00;205", 1004.0),
        ("Electronics;Zune - 328GB;1;;", 0.0),
        ("", 0.0),
        ("a;b;1", 0.0),
        ("a;b;1; 7.5 ", 7.5),
        ("a;b;1;1_000;", 1000.0),
        ("a;b;1;1e2;,a;b;1;-5;", 95.0),
        ("a;b;1;nan;,a;b;1;inf;,a;b;1;1.0d;,a;b;1;2;", 2.0),
        ("a;b;1;1e999;,a;b;1;-1e999;,a;b;1;3;", 3.0),
        (";;;.5,;;;3.", 3.5),
    ],
)
def test_product_revenue(spark, products_, want):
    df = column(spark, [products_]).select("i", products.product_revenue(F.col("v")).alias("r"))
    assert by_index(df) == [want]


def test_events(spark):
    lists = ["1", "2, 1 ", "10,11", "", "12,1", "1 1", "1.0", "\t1 ,2", None]
    df = column(spark, lists).select("i", products.has_event(F.col("v")).alias("r"))
    assert by_index(df) == [True, True, False, False, True, False, False, True, None]
    arrays = column(spark, ["", " 2 ,1"]).select("i", products.event_array(F.col("v")).alias("r"))
    assert by_index(arrays) == [[""], ["2", "1"]]


def test_hit_ts(spark):
    values = ["1254033280", " 12 ", "bad", "", None, "-5", "9" * 30, "1.5", "12\n"]
    df = column(spark, values).select("i", clock.hit_ts(F.col("v")).alias("r"))
    assert by_index(df) == [1254033280, 12, 0, 0, 0, 0, 0, 0, 12]


@pytest.mark.parametrize(
    "interval, minutes, want",
    [
        (15, [0, 14, 15, 29, 30, 44, 45, 59], ["00", "00", "15", "15", "30", "30", "45", "45"]),
        (5, [7, 12], ["05", "10"]),
        (10, [25], ["20"]),
        (7, [6, 7, 59], ["00", "07", "56"]),
        (60, [59], ["00"]),
    ],
)
def test_minute_bucket(spark, interval, minutes, want):
    seconds = [1609459200 + 60 * m for m in minutes]
    df = column(spark, seconds, "bigint").select(
        "i", clock.minute_bucket(clock.event_ts(F.col("v")), interval).alias("r")
    )
    assert by_index(df) == want


def test_labels(spark):
    df = column(spark, [0, -1, None, 1718443800, 10**13], "bigint").select(
        "i", clock.event_ts(F.col("v")).alias("ts")
    )
    prefix = clock.partition_prefix(
        clock.dt_label(F.col("ts")), clock.hour_label(F.col("ts")), clock.minute_bucket(F.col("ts"))
    )
    epoch = "dt=1970-01-01/hour=00/minute=00"
    assert by_index(df.select("i", prefix.alias("r"))) == [
        epoch, epoch, epoch, "dt=2024-06-15/hour=09/minute=30", None,
    ]


def test_intervals(spark):
    assert clock.resolve_interval("x") == 15
    assert clock.resolve_interval(" 5 ") == 5
    assert clock.valid_minute_buckets(15) == ["00", "15", "30", "45"]
    assert len(clock.valid_minute_buckets(10)) == 6
    for wrong in (0, 61):
        with pytest.raises(ValueError):
            clock.resolve_interval(wrong)
    spark.conf.set(clock.INTERVAL_CONF, "20")
    try:
        assert clock.resolve_interval(None, spark) == 20
    finally:
        spark.conf.unset(clock.INTERVAL_CONF)


def test_masks(spark):
    df = column(spark, ["67.98.123.1", "::1", "", "1.2.3.4.5"])
    hidden = "xxx.xxx.xxx.xxx"
    assert by_index(df.select("i", privacy.mask_ip(F.col("v")).alias("r"))) == [
        "67.98.123.xxx", hidden, hidden, hidden,
    ]
    agent = column(spark, ["Mozilla/5.0"])
    assert by_index(agent.select("i", privacy.mask_user_agent(F.col("v")).alias("r"))) == [
        "ua_1066b482"
    ]


def test_mask_location(spark):
    places = [("Salem", "OR", "US"), ("Salem", "", ""), ("", "", "")]
    df = spark.createDataFrame(places, "geo_city string, geo_region string, geo_country string")
    assert sorted(map(tuple, privacy.mask_location(df).collect())) == sorted([
        ("masked_city", "masked_region", "US"), ("masked_city", "masked_region", "unknown"),
        ("", "", ""),
    ])
    assert privacy.mask_pii(df, enabled=False) is df


def test_revenue_reads_each_number_once(spark):
    """The test for infinite numbers takes the number that was read, not the text once more."""
    df = spark.createDataFrame([("a;b;1;1e999;,a;b;1;2_0.5;,a;b;1;x",), (None,), ("",)], "p string")
    total = df.select(products.product_revenue(F.col("p")).alias("r"))
    assert [r["r"] for r in total.collect()] == [20.5, None, 0.0]
    plan = total._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1
