"""SQL access: the library's functions and frames under names that SQL texts can use.

Functions are SQL expressions that Catalyst puts in place of their calls, so a query that uses them
has no Python in its plan. They give what the column functions of the same meaning give. Views are
the frames of one set of hits; they hold no data and are computed by the query that reads them.
"""

from pyspark.sql import DataFrame, SparkSession

from touchline.fixed_values import (
    DEFAULT_INTERVAL_MINUTES,
    ENGINE_PARAMS,
    MASKED_CITY,
    MASKED_IP,
    MASKED_IP_PART,
    MASKED_REGION,
    UNKNOWN_COUNTRY,
    USER_AGENT_HEX,
    USER_AGENT_PREFIX,
)
from touchline.functions import clock, products, url
from touchline.functions.money import MONEY
from touchline.functions.text import WHITESPACE
from touchline.operators.attribution import attribute_last_touch, attributed_purchases
from touchline.operators.revenue import keyword_totals
from touchline.sinks.tables import read_facts, read_insights


def literal(text: str) -> str:
    """A text as SQL writes it."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _strip(c: str) -> str:
    return f"btrim({c}, {literal(WHITESPACE)})"


def _unbroken(c: str) -> str:
    for character in "\t\r\n":
        c = f"replace({c}, {literal(character)}, '')"
    return c


def _unescape(c: str) -> str:
    decoded = f"try_url_decode(regexp_replace({c}, {literal('%(?![0-9A-Fa-f]{2})')}, '%25'))"
    return f"CASE WHEN contains({c}, '%') OR contains({c}, '+') THEN {decoded} ELSE {c} END"


def _raw_keyword(slot: int) -> str:
    names = [name for name, params in ENGINE_PARAMS.items() if slot < len(params)]
    value = f"regexp_extract(concat(engine, '?', query), {literal(url.slot_regex(slot))}, 1)"
    return f"CASE WHEN engine IN ({', '.join(map(literal, names))}) THEN {value} END"


def _keyword(slot: int) -> str:
    return f"nullif(lower({_strip(_unescape(_raw_keyword(slot)))}), '')"


def _line_revenue(line: str) -> str:
    number = f"regexp_replace(regexp_extract({line}, {literal(products.LINE_REVENUE)}, 1), '_', '')"
    value = f"try_cast({number} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < double('Infinity') THEN {value} ELSE 0D END"


def _line_field(n: int) -> str:
    return _strip(f"get(split(line, ';'), {n})")


_LOCATION = "concat(coalesce(city, ''), coalesce(region, ''), coalesce(country, '')) <> ''"

#: Name, parameters, result and body of every function. A body may call functions before it, but
#: not within a lambda.
FUNCTIONS = [
    ("url_host", "url STRING", "STRING",
     f"nullif(lower(regexp_extract({_unbroken(_strip('url'))}, {literal(url.HOST)}, 1)), '')"),
    ("url_query", "url STRING", "STRING",
     f"regexp_extract({_unbroken(_strip('url'))}, {literal(url.QUERY)}, 1)"),
    ("url_unescape", "part STRING", "STRING", _unescape("part")),
    ("query_pairs", "url STRING", "ARRAY<STRUCT<name STRING, value STRING>>",
     f"""transform(filter(split(url_query(url), '&'), part -> part RLIKE {literal('(?s)^[^=]*=.')}),
      part -> named_struct('name', {_unescape("regexp_extract(part, '^([^=]*)=', 1)")},
        'value', {_unescape(f"regexp_extract(part, {literal('(?s)^[^=]*=(.*)' + chr(92) + 'z')}, 1)")}))"""),
    ("search_engine", "host STRING", "STRING", f"regexp_extract(host, {literal(url.ENGINE)}, 1)"),
    ("engine_domain", "host STRING", "STRING",
     f"regexp_extract(host, {literal(url.DOMAIN)}, 1)"),
    ("search_keyword", "engine STRING, query STRING", "STRING",
     f"coalesce({', '.join(_keyword(slot) for slot in url.SLOTS)})"),
    ("parse_search_referrer", "referrer STRING", "STRUCT<engine_domain STRING, keyword STRING>",
     f"""CASE WHEN referrer RLIKE {literal(url.SEARCH_LIKE)}
       AND search_keyword(search_engine(url_host(referrer)), url_query(referrer)) IS NOT NULL
     THEN named_struct('engine_domain', engine_domain(url_host(referrer)), 'keyword',
       search_keyword(search_engine(url_host(referrer)), url_query(referrer))) END"""),
    ("has_ip", "ip STRING", "BOOLEAN", f"{_strip('ip')} <> ''"),
    ("visitor_id", "ip STRING, user_agent STRING", "STRING",
     f"concat_ws('|', {_strip('ip')}, {_strip('user_agent')})"),
    ("event_items", "events STRING", "ARRAY<STRING>",
     f"transform(split(events, ','), item -> {_strip('item')})"),
    ("has_event", "events STRING, event STRING", "BOOLEAN",
     f"array_contains(transform(split(events, ','), item -> {_strip('item')}), event)"),
    ("is_purchase", "events STRING", "BOOLEAN",
     f"has_event(events, {literal(products.PURCHASE_EVENT)})"),
    ("product_lines", "list STRING",
     "ARRAY<STRUCT<category STRING, product STRING, quantity STRING, revenue DOUBLE>>",
     f"""transform(filter(split(list, ','), line -> size(split(line, ';')) >= 4),
      line -> named_struct('category', {_line_field(0)}, 'product', {_line_field(1)},
        'quantity', {_line_field(2)}, 'revenue', {_line_revenue('line')}))"""),
    ("product_revenue", "list STRING", "DOUBLE",
     f"aggregate(split(list, ','), 0D, (total, line) -> total + {_line_revenue('line')})"),
    ("mask_ip", "ip STRING", "STRING",
     f"""CASE WHEN ip RLIKE {literal('(?s)^[^.]*[.][^.]*[.][^.]*[.][^.]*' + chr(92) + 'z')}
     THEN concat(substring_index(ip, '.', 3), {literal('.' + MASKED_IP_PART)}) ELSE {literal(MASKED_IP)} END"""),
    ("mask_user_agent", "user_agent STRING", "STRING",
     f"concat({literal(USER_AGENT_PREFIX)}, substring(sha2(user_agent, 256), 1, {USER_AGENT_HEX}))"),
    ("mask_location", "city STRING, region STRING, country STRING",
     "STRUCT<geo_city STRING, geo_region STRING, geo_country STRING>",
     f"""named_struct('geo_city', CASE WHEN {_LOCATION} THEN {literal(MASKED_CITY)} ELSE city END,
      'geo_region', CASE WHEN {_LOCATION} THEN {literal(MASKED_REGION)} ELSE region END,
      'geo_country', CASE WHEN {_LOCATION} THEN coalesce(nullif(country, ''), {literal(UNKNOWN_COUNTRY)})
        ELSE country END)"""),
    ("hit_seconds", "hit_time STRING", "BIGINT",
     f"coalesce(try_cast(regexp_extract({_strip('hit_time')}, {literal(clock.DIGITS)}, 1) AS BIGINT), 0L)"),
    ("event_time", "seconds BIGINT", "TIMESTAMP",
     f"""CASE WHEN coalesce(seconds, 0) <= {clock.LAST_LABELLED_SECOND}
     THEN timestamp_seconds(greatest(seconds, 0)) END"""),
    ("day_label", "ts TIMESTAMP", "STRING", "CAST(to_date(ts) AS STRING)"),
    ("hour_label", "ts TIMESTAMP", "STRING", "lpad(CAST(hour(ts) AS STRING), 2, '0')"),
    ("minute_bucket", f"ts TIMESTAMP, minutes INT DEFAULT {DEFAULT_INTERVAL_MINUTES}", "STRING",
     "lpad(CAST(minute(ts) - minute(ts) % minutes AS STRING), 2, '0')"),
    ("money", "amount DOUBLE", MONEY.upper(), f"CAST(amount AS {MONEY})"),
    ("cents", f"amount {MONEY.upper()}", "DOUBLE", "CAST(round(amount, 2) AS DOUBLE)"),
]


def register_functions(spark: SparkSession) -> list[str]:
    """Create all functions in the session, replacing those of their names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [name for name, *_ in FUNCTIONS]


def register_views(
    spark: SparkSession, hits: DataFrame, tables: str | None = None, prefix: str = "", **attribution
) -> dict[str, DataFrame]:
    """Views of hits and what is derived from them; of the stored tables, too, if `tables` is given.

    hits: as read; touched_hits: with visitor_id, touch and last_touch; sales: purchases with the
    search they came from; totals: revenue by engine and keyword; facts and insights: as stored.
    """
    sales = attributed_purchases(hits, **attribution)
    touch = {k: v for k, v in attribution.items() if k != "keep"}
    views = {
        "hits": hits,
        "touched_hits": attribute_last_touch(hits, **touch),
        "sales": sales,
        "totals": keyword_totals(sales),
    }
    if tables is not None:
        views |= {"facts": read_facts(spark, tables), "insights": read_insights(spark, tables)}
    for name, frame in views.items():
        frame.createOrReplaceTempView(prefix + name)
    return views


def register(spark: SparkSession, hits: DataFrame, tables: str | None = None, **attribution) -> None:
    """All functions and views, for SQL texts over one set of hits."""
    register_functions(spark)
    register_views(spark, hits, tables, **attribution)
