"""SQL texts against the column functions and golden inputs."""

import pytest
from pyspark.sql import functions as F

from touchline import catalog
from touchline.functions import clock, privacy, products, url
from touchline.functions.money import cents, money
from touchline.operators.attribution import visitor_id
from touchline.operators.normalize import normalize_hits
from touchline.plans.queries import QUERIES, tuned

URLS = [
    "http://www.google.com/search?hl=en&q=Ipod", "https://GOOGLE.co.uk:443/?q=%20&q=x", "http://search.yahoo.com/search?p=cd+player",
    "http://www.ask.com/web?q=&ask=Two%2BOne", " http://user:pw@www.bing.com/search?q=Zune%zz\t&x=1 ", "http://[::1]:80/?q=google", "//msn.com/?q=a%26b",
    "mailto:a@google.com?q=x", "http://a_b.google.com/?q=C'est \"ça\"", "", None, "no url", "http://baidu.com/s?word=w&wd=", "http://x.yahoo.com/?p=a=b&p=c",
    "http://aol.com/?%71uery=Deep", "http://com./?q", "http://yandex.ru/?text= &text=y",
]
LISTS = ["Electronics;Ipod;1;190;", "a;b;1;1_0.5;,c;d;2; 3 ;x", "a;b;1", "", None, ";;;", "a;b;1;nan;", "x;y;1;-2e1;,x;y;1;1e999;", " a ; b ;c; 4;"]
EVENTS = ["1", " 2, 1 ", "10,11", "", None, "1.0", "2,,1"]
ADDRESSES = ["1.2.3.4", "1.2.3", "fe80::1", "", None, "1.2.3.4.5", " 1.2.3.4 ", "a.b.c.\n"]


def same(spark, values, kind, pairs):
    """pairs: SQL text over x, and the column of it."""
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    frame.createOrReplaceTempView("given")
    for text, column in pairs:
        got = [r[0] for r in spark.sql(f"SELECT {text} FROM given").collect()]
        assert got == [r[0] for r in frame.select(column).collect()], text


@pytest.fixture(scope="module", autouse=True)
def functions(spark):
    catalog.register_functions(spark)


def test_functions_are_the_columns(spark):
    x = F.col("x")
    engine = url.engine_of(url.url_host(x))
    same(spark, URLS, "string", [
        ("url_host(x)", url.url_host(x)), ("url_query(x)", url.url_query(x)), ("url_unescape(x)", url.url_unescape(x)),
        ("query_pairs(x)", url.query_pairs(x)), ("search_engine(url_host(x))", engine),
        ("engine_domain(url_host(x))", url.engine_domain(url.url_host(x))),
        ("search_keyword(search_engine(url_host(x)), url_query(x))", url.search_keyword(engine, url.url_query(x))),
        ("parse_search_referrer(x)", url.parse_search_referrer(x)),
    ])
    same(spark, LISTS, "string", [("product_lines(x)", products.product_lines(x)), ("product_revenue(x)", products.product_revenue(x))])
    same(spark, EVENTS, "string", [("event_items(x)", products.event_array(x)), ("is_purchase(x)", products.has_event(x)), ("has_event(x, '11')", products.has_event(x, "11"))])
    same(spark, ADDRESSES, "string", [("mask_ip(x)", privacy.mask_ip(x)), ("mask_user_agent(x)", privacy.mask_user_agent(x)), ("visitor_id(x, x)", visitor_id(x, x))])
    same(spark, ["12", " 7 ", "x", "", None, "9" * 30, "-1"], "string", [("hit_seconds(x)", clock.hit_ts(x))])
    ts = clock.event_ts(x)
    same(spark, [0, -5, None, 1704067199, 253402300799, 253402300800], "bigint", [
        ("event_time(x)", ts), ("day_label(event_time(x))", clock.dt_label(ts)), ("hour_label(event_time(x))", clock.hour_label(ts)),
        ("minute_bucket(event_time(x))", clock.minute_bucket(ts)), ("minute_bucket(event_time(x), 7)", clock.minute_bucket(ts, 7)),
    ])
    same(spark, [1.005, -2.5, 0.0, None], "double", [("cents(money(x))", cents(money(x)))])


def test_location_is_that_of_the_frame(spark):
    rows = [("", "", ""), ("a", None, ""), (None, None, None), ("", "b", "FR"), ("", "", "US")]
    frame = spark.createDataFrame(rows, "geo_city string, geo_region string, geo_country string")
    frame.createOrReplaceTempView("places")
    got = spark.sql("SELECT m.* FROM (SELECT mask_location(geo_city, geo_region, geo_country) AS m FROM places)")
    assert got.collect() == privacy.mask_location(frame).collect()


def hits(spark, rows):
    names = "hit_time_gmt string, ip string, user_agent string, referrer string, event_list string, product_list string, source_row long"
    return normalize_hits(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], names))


GOLDEN = [
    ("100", "67.98.123.1", "UA", "http://www.google.com/search?q=Ipod", "2", ""),
    ("110", "23.8.61.21", "UA", "http://www.bing.com/search?q=Zune", "2", ""),
    ("120", "67.98.123.1", "UA", "http://www.esshopzilla.com/cart/", "12", ""),
    ("130", "44.12.96.2", "UA", "http://search.yahoo.com/search?p=cd+player", "2", ""),
    ("140", "67.98.123.1", "UA", "https://www.esshopzilla.com/checkout/", "1", "Electronics;Ipod - Nano - 8GB;1;190;"),
    ("150", "23.8.61.21", "UA", "https://www.esshopzilla.com/checkout/", "1", "Electronics;Zune - 32GB;1;250;"),
    ("160", "44.12.96.2", "UA", "https://www.esshopzilla.com/checkout/", "2", "Electronics;CD;1;20;"),
]


def test_revenue_by_views_and_by_one_text(spark):
    catalog.register(spark, hits(spark, GOLDEN))
    want = [("bing.com", "zune", 250.0), ("google.com", "ipod", 190.0)]
    by_view = spark.sql("SELECT engine_domain, keyword, cents(revenue) FROM totals ORDER BY 1")
    assert [tuple(r) for r in by_view.collect()] == want
    by_text = spark.sql(
        "SELECT last_touch.engine_domain, last_touch.keyword, cents(sum(money(product_revenue(product_list))))"
        " FROM touched_hits WHERE is_purchase(event_list) AND last_touch IS NOT NULL GROUP BY 1, 2 ORDER BY 1"
    )
    assert [tuple(r) for r in by_text.collect()] == want


def test_views_of_stored_tables_and_prefixes(spark, tmp_path):
    catalog.register_views(spark, hits(spark, GOLDEN), tables=str(tmp_path), prefix="my_")
    assert spark.sql("SELECT count(*) FROM my_insights").first()[0] == 0
    assert spark.sql("SELECT count(*) FROM my_sales").first()[0] == 2


def test_sql_runs_in_the_jvm(spark):
    plan = tuned(QUERIES["sql_surface"])(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Window" in plan
