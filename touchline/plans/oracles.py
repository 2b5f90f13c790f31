"""The same results in DuckDB SQL, written independently of the Spark expressions."""

from touchline.plans.hits import DUCKDB_HITS
from touchline.plans.queries import RUN_DATE, RUN_TIME, STAGING_INTERVAL

_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_FIELD4 = "trim(split_part(x, ';', 4))"
_LINE = (
    f"CASE WHEN regexp_full_match({_FIELD4}, '{_NUMBER}') THEN CAST({_FIELD4} AS DOUBLE) ELSE 0 END"
)
_REVENUE = f"list_sum(list_transform(string_split(product_list, ','), lambda x: {_LINE}))"
_SALE = (
    "(list_contains(list_transform(string_split(event_list, ','), lambda z: trim(z)), '1')"
    " AND trim(product_list) <> '')"
)
_MASK_IP = (
    "CASE WHEN len(string_split({ip}, '.')) = 4 THEN regexp_replace({ip}, '[^.]*$', 'xxx')"
    " ELSE 'xxx.xxx.xxx.xxx' END"
)
_MASK_UA = "concat('ua_', substr(sha256(user_agent), 1, 8))"


def _ratio(part, whole, times):
    """part / whole * times in two decimals, half up, by whole numbers of millionths."""
    p, w = (f"CAST({x} * 1000000 AS HUGEINT)" for x in (part, whole))
    hundredths = f"((abs({p}) * {200 * times} + {w}) // (2 * {w}))"
    return f"sign({part}) * CAST({hundredths} AS DOUBLE) / 100"


def _mean(total, n):
    p, w = f"CAST({total} * 1000000 AS HUGEINT)", f"CAST({n} AS HUGEINT) * 1000000"
    return f"sign({total}) * CAST((abs({p}) * 200 + {w}) // (2 * {w}) AS DOUBLE) / 100"


_TOTAL = "(SELECT total FROM kpis)"
_TS = "make_timestamp(hit_ts * 1000000)"


def _minute(interval):
    return f"lpad(CAST((minute({_TS}) // {interval}) * {interval} AS VARCHAR), 2, '0')"


_DT, _HOUR, _MINUTE = f"strftime({_TS}, '%Y-%m-%d')", f"strftime({_TS}, '%H')", _minute(15)

# Hits with everything the operators derive from a single row.
_DERIVED = f"""
timed AS (
  SELECT *, concat('/landing/hits-', substr(date_time, 1, 10), '.tsv') AS source_file,
    CASE WHEN regexp_full_match(trim(hit_time_gmt), '[0-9]+')
         THEN coalesce(try_cast(trim(hit_time_gmt) AS BIGINT), 0) ELSE 0 END AS hit_ts,
    CASE WHEN referrer LIKE '%google.com/search%' THEN 'google.com'
         WHEN referrer LIKE '%google.co.uk%' THEN 'co.uk'
         WHEN referrer LIKE '%bing.com%' THEN 'bing.com'
         WHEN referrer LIKE '%yahoo.com%' THEN 'yahoo.com'
         WHEN referrer LIKE '%ask.com%' THEN 'ask.com' END AS e,
    CASE WHEN e IS NOT NULL THEN lower(url_decode(replace(
      regexp_extract(referrer, '[?&](?:q|p|ask)=([^&]+)', 1), '+', ' '))) END AS k,
    {_SALE} AS sale, {_REVENUE} AS rv
  FROM hits),
base AS (SELECT *, {_DT} AS dt, {_HOUR} AS hour, {_MINUTE} AS minute FROM timed)"""
_BASE = f"""
hits AS ({DUCKDB_HITS}),{_DERIVED}"""


def _touched(vid, keep="true", scope=""):
    window = (
        f"(PARTITION BY {scope}{vid} ORDER BY hit_ts, event_id"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    return f"""{_BASE},
touched AS (
  SELECT *, last_value(e IGNORE NULLS) OVER w AS engine_domain,
    last_value(k IGNORE NULLS) OVER w AS keyword
  FROM base WHERE {keep} WINDOW w AS {window}),
sales AS (SELECT * FROM touched WHERE engine_domain IS NOT NULL AND sale AND rv > 0)"""


_RAW_VID = "concat(trim(ip), '|', user_agent)"
_MASKED_VID = f"concat({_MASK_IP.format(ip='trim(ip)')}, '|', {_MASK_UA})"
_RAW = _touched(_RAW_VID, "trim(ip) <> ''")
_MASKED = _touched(_MASKED_VID)
_BY_FILE = _touched(_RAW_VID, "trim(ip) <> ''", "source_file, ")
_MASKED_BY_FILE = _touched(_MASKED_VID, "true", "source_file, ")

_TOTALS = """,
totals AS (SELECT engine_domain, keyword, sum(CAST(rv AS DECIMAL(38, 6))) AS revenue FROM sales GROUP BY ALL)"""
_DAYS = """,
days AS (SELECT dt, engine_domain, keyword, sum(CAST(rv AS DECIMAL(38, 6))) AS revenue FROM sales GROUP BY ALL)"""

_KPIS = """,
kpis AS (SELECT sum(revenue) AS total, count(*) AS n, count(DISTINCT engine_domain) AS engines
  FROM totals),
ranked AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, engine_domain, keyword) AS best,
    row_number() OVER (ORDER BY revenue, engine_domain DESC, keyword DESC) AS worst FROM totals),
eng AS (SELECT engine_domain AS engine, sum(revenue) AS r, count(*) AS c FROM totals GROUP BY ALL)"""
_TREND = """,
trend AS (SELECT dt AS date, sum(revenue) AS r, count(DISTINCT keyword) AS kw,
    count(DISTINCT engine_domain) AS eg FROM days GROUP BY ALL),
change AS (SELECT date, r, lag(r) OVER (ORDER BY date) AS p FROM trend)"""
_CHANGE = """,
pc AS (SELECT date, r, p, CAST(r - p AS DOUBLE) / CAST(p AS DOUBLE) * 100 AS change FROM change
  WHERE p > 0 ORDER BY date DESC LIMIT 1)"""
_REPORT = f"{_RAW}{_TOTALS}{_DAYS}{_KPIS}{_TREND}{_CHANGE}"

# One row of all the report rules look at.
_METRICS = f"""{_REPORT},
m AS (SELECT *, CAST(five AS DOUBLE) / CAST(exact_total AS DOUBLE) * 100 AS top5 FROM (
  SELECT CAST(k.total AS DOUBLE) AS total, engines,
    (SELECT keyword FROM ranked WHERE best = 1) AS top_k,
    (SELECT engine_domain FROM ranked WHERE best = 1) AS top_e,
    (SELECT CAST(revenue AS DOUBLE) FROM ranked WHERE best = 1) AS top_r,
    (SELECT engine FROM eng ORDER BY r DESC, engine LIMIT 1) AS eng_name,
    (SELECT CAST(max(r) AS DOUBLE) FROM eng) / CAST(k.total AS DOUBLE) * 100 AS eng_share,
    (SELECT change FROM pc) AS change,
    CASE WHEN n >= 5 THEN (SELECT sum(revenue) FROM ranked WHERE best <= 5) END AS five,
    k.total AS exact_total
  FROM kpis k))"""

_URLS = f"""
hits AS ({DUCKDB_HITS}),
urls AS (SELECT 'hit' AS origin, event_id AS id, referrer AS url FROM hits
  UNION ALL SELECT 'page', page_id, url FROM pages),
hosts AS (SELECT *, nullif(lower(split_part(regexp_replace(
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':', 1)), '') AS host
  FROM urls)"""
# Fixed values, named here once more so that the SQL does not depend on the operators.
_ENGINES = ["google", "bing", "yahoo", "msn", "ask", "aol", "duckduckgo", "baidu", "yandex"]
_ENGINE = "CASE " + " ".join(f"WHEN contains(host, '{e}') THEN '{e}'" for e in _ENGINES) + " END"

_CORE = (
    f"WITH {_BASE} SELECT event_id, hit_ts, ip, user_agent, event_list, product_list, referrer"
    " FROM base"
)
_GEO = ", ".join(
    f"CASE WHEN concat(geo_city, geo_region, geo_country) <> '' THEN {mask} ELSE {c} END AS {c}"
    for c, mask in (
        ("geo_city", "'masked_city'"),
        ("geo_region", "'masked_region'"),
        ("geo_country", "coalesce(nullif(geo_country, ''), 'unknown')"),
    )
)
_DISPLAY = (
    'engine_domain AS "Search Engine Domain", keyword AS "Search Keyword",'
    ' CAST(round(revenue, 2) AS DOUBLE) AS "Revenue"'
)
_INSIGHT_ROWS = """,
ins AS (SELECT event_id AS keyword_id, engine_domain AS search_engine_domain,
    keyword AS search_keyword, rv AS score, hit_ts AS processed FROM sales)"""
_SHOWN = (
    "keyword_id, search_engine_domain, search_keyword,"
    " round(score, 2) AS revenue_impact_score, processed AS processed_seconds"
)
_LATEST = (
    "SELECT * FROM {t} QUALIFY row_number() OVER"
    " (PARTITION BY search_engine_domain, search_keyword ORDER BY keyword_id DESC) = 1"
)
_RUN_SECONDS = f"CAST(epoch(TIMESTAMP '{RUN_TIME}') AS BIGINT)"
_FILE_TOTALS = """,
ft AS (SELECT source_file, engine_domain, keyword, sum(CAST(rv AS DECIMAL(38, 6))) AS revenue FROM sales GROUP BY ALL),
first_hit AS (SELECT source_file, min(hit_ts) AS min_hit_ts FROM base GROUP BY ALL),
fp AS (SELECT source_file, min_hit_ts, strftime(make_timestamp(min_hit_ts * 1000000), '%Y-%m-%d') AS dt,
    strftime(make_timestamp(min_hit_ts * 1000000), '%H') AS hour,
    lpad(CAST(minute(make_timestamp(min_hit_ts * 1000000)) // 15 * 15 AS VARCHAR), 2, '0') AS minute
  FROM first_hit)"""
_KEYWORD_COLUMNS = (
    "keyword, engine_domain AS search_engine, CAST(round(revenue, 2) AS DOUBLE) AS revenue,"
    f" {_ratio('revenue', _TOTAL, 100)} AS revenue_percentage"
)
_KEYWORD_ROWS = "SELECT engine_domain, keyword, CAST(round(sum(CAST(rv AS DECIMAL(38, 6))), 2) AS DOUBLE) AS revenue FROM sales GROUP BY 1, 2"

_INSIGHTS = """
found_insights AS (
  SELECT 1 AS g, CASE WHEN total > 1000 THEN 'rev_strong' WHEN total > 100 THEN 'rev_moderate'
    ELSE 'rev_low' END AS rule, printf('%s revenue performance with $%.2f total revenue',
    CASE WHEN total > 1000 THEN 'Strong' WHEN total > 100 THEN 'Moderate' ELSE 'Low' END, total) AS text
    FROM m
  UNION ALL SELECT 2, 'top_keyword',
    printf('Top performing keyword ''%s'' on %s generated $%.2f (%.1f%% of total)',
      top_k, top_e, top_r, top_r / total * 100) FROM m WHERE top_r > 100
  UNION ALL SELECT 3, 'dominance', printf('%s dominates with %.1f%% of total revenue',
      eng_name, eng_share) FROM m WHERE eng_share > 70
  UNION ALL SELECT 3, 'single_engine', concat('Single search engine dependency: ', eng_name)
    FROM m WHERE eng_share <= 70 AND engines = 1
  UNION ALL SELECT 4,
    CASE WHEN change > 15 THEN 'growth_excellent' WHEN change < -20 THEN 'drop_concerning'
      WHEN change > 0 THEN 'growth' ELSE 'decline' END,
    printf('%s of %.1f%% vs previous period',
      CASE WHEN change > 15 THEN 'Excellent revenue growth' WHEN change < -20
        THEN 'Concerning revenue drop' WHEN change > 0 THEN 'Positive revenue growth'
        ELSE 'Revenue decline' END, abs(change)) FROM m WHERE change IS NOT NULL
  UNION ALL SELECT 5, 'concentration_high', 'High concentration: top 5 keywords drive most revenue'
    FROM m WHERE top5 > 80
  UNION ALL SELECT 5, 'diversity_good', 'Good keyword diversity with distributed revenue'
    FROM m WHERE top5 < 40),
insights AS (SELECT row_number() OVER (ORDER BY g) AS pos, rule, text FROM found_insights)"""
_RECOMMENDATIONS = """
found_recommendations AS (
  SELECT 1 AS g, 'rev_low' AS rule,
    'Consider optimizing SEO/SEM strategies for low-performing keywords' AS text FROM m WHERE total <= 100
  UNION ALL SELECT 2, 'rev_low', 'Review keyword bidding strategies and ad copy' FROM m WHERE total <= 100
  UNION ALL SELECT 3, 'one_engine',
    'Diversify traffic sources to reduce dependency on single search engine' FROM m WHERE engines = 1
  UNION ALL SELECT 4, 'dominance',
    printf('Explore opportunities on other search engines to reduce %s dependency', eng_name)
    FROM m WHERE engines > 1 AND eng_share > 70
  UNION ALL SELECT 5, 'drop_concerning', 'Investigate cause of revenue drop immediately'
    FROM m WHERE change < -20
  UNION ALL SELECT 6, 'drop_concerning', 'Consider promotional campaigns to boost performance'
    FROM m WHERE change < -20
  UNION ALL SELECT 7, 'growth_excellent', 'Analyze successful strategies and scale them'
    FROM m WHERE change > 15
  UNION ALL SELECT 8, 'growth_excellent', 'Consider increasing budget for high-performing keywords'
    FROM m WHERE change > 15
  UNION ALL SELECT 9, 'concentration_high',
    'Develop long-tail keyword strategy to reduce concentration risk' FROM m WHERE top5 > 80),
recommendations AS (SELECT row_number() OVER (ORDER BY g) AS pos, rule, text FROM found_recommendations)"""
_ALL = f"{_METRICS},{_INSIGHTS},{_RECOMMENDATIONS}"
_ROWS = f"""SELECT 'kpis' AS section, 1 AS pos, CAST(round(total, 2) AS DOUBLE) AS total_revenue, n AS total_keywords,
  engines AS total_search_engines, {_mean('total', 'n')} AS avg_revenue_per_keyword FROM kpis
UNION ALL BY NAME SELECT 'top_keywords' AS section, best AS pos, {_KEYWORD_COLUMNS} FROM ranked WHERE best <= 10
UNION ALL BY NAME SELECT 'bottom_keywords' AS section, row_number() OVER (ORDER BY worst DESC) AS pos,
  {_KEYWORD_COLUMNS} FROM ranked WHERE worst <= 10
UNION ALL BY NAME SELECT 'search_engines' AS section, row_number() OVER (ORDER BY r DESC, engine) AS pos, engine,
  CAST(round(r, 2) AS DOUBLE) AS total_revenue, {_ratio('r', _TOTAL, 100)} AS revenue_percentage,
  c AS keyword_count, {_mean('r', 'c')} AS avg_revenue_per_keyword FROM eng
UNION ALL BY NAME SELECT 'insights' AS section, pos, rule, text FROM insights
UNION ALL BY NAME SELECT 'recommendations' AS section, pos, rule, text FROM recommendations
UNION ALL BY NAME SELECT 'revenue_trend' AS section, row_number() OVER (ORDER BY date) AS pos, date,
  CAST(round(r, 2) AS DOUBLE) AS total_revenue, kw AS unique_keywords, eg AS unique_search_engines,
  {_mean('r', 'kw')} AS avg_revenue_per_keyword FROM trend"""
_JSON = f"""WITH {_ALL} SELECT '{RUN_DATE}' AS report_date, '{RUN_TIME.replace(' ', 'T')}' AS report_timestamp,
  CAST(CAST(round(total, 2) AS DOUBLE) AS VARCHAR) AS total_revenue, CAST(n AS VARCHAR) AS total_keywords,
  '00' AS minute_bucket, (SELECT keyword FROM ranked WHERE best = 1) AS top_keyword,
  (SELECT engine FROM eng ORDER BY r DESC, engine LIMIT 1) AS top_engine FROM kpis"""

ORACLES = {
    "keyword_revenue": f"WITH {_RAW} {_KEYWORD_ROWS}",
    "keyword_revenue_masked": f"WITH {_MASKED} {_KEYWORD_ROWS}",
    "scan_hits_parquet": _CORE,
    "scan_hits_tsv": _CORE,
    "scan_mixed": _CORE,
    "tsv_to_parquet": (
        f"WITH {_BASE} SELECT event_id, hit_ts AS hit_time_gmt, trim(ip) AS ip,"
        " trim(event_list) AS event_list, geo_city, product_list FROM base"
    ),
    "scan_pruned": (
        f"WITH {_BASE} SELECT event_id, hit_ts, ip, referrer FROM base"
        f" WHERE dt = '{RUN_DATE}' AND hour = '06'"
    ),
    "read_curated": f"WITH {_RAW} {_KEYWORD_ROWS}",
    "read_history": (
        f"WITH {_RAW}{_DAYS} SELECT dt AS date, engine_domain, keyword,"
        " CAST(round(revenue, 2) AS DOUBLE) AS revenue FROM days"
    ),
    "stream_ingest": (
        f"WITH {_MASKED_BY_FILE}{_FILE_TOTALS} SELECT dt, hour, minute, engine_domain, keyword,"
        " CAST(round(revenue, 2) AS DOUBLE) AS revenue FROM ft JOIN fp USING (source_file)"
    ),
    "norm_columns": (
        f"WITH {_BASE} SELECT event_id, hit_time_gmt, ip, user_agent, referrer FROM base"
    ),
    "norm_types": (
        f"WITH {_BASE} SELECT event_id, CASE WHEN ip = ' ' THEN '' ELSE ip END AS ip, user_agent,"
        " concat(length(event_list), '.0') AS event_list, event_list AS product_list, referrer"
        " FROM base"
    ),
    "hit_ts": f"WITH {_BASE} SELECT event_id, hit_ts FROM base",
    "curated_projection": f"WITH {_RAW}{_TOTALS} SELECT {_DISPLAY} FROM totals",
    "purchase_hits": f"WITH {_BASE} SELECT event_id, event_list, product_list FROM base WHERE sale",
    "attributed_purchases": (
        f"WITH {_RAW} SELECT event_id, engine_domain, keyword, round(rv, 2) AS revenue FROM sales"
    ),
    "check_output": (
        f"WITH {_RAW}{_TOTALS} SELECT d.run_date, d.run_date = '{RUN_DATE}'"
        " AND (SELECT count(*) FROM totals) > 0 AS found, (SELECT count(*) FROM totals) AS totals"
        f" FROM (VALUES ('{RUN_DATE}'), ('1999-12-31')) d(run_date)"
    ),
    "time_partitions": (
        f"WITH {_BASE} SELECT event_id, hit_ts, strftime({_TS}, '%Y-%m-%d %H:%M:%S') AS event_time,"
        " dt, hour, minute FROM base"
    ),
    "minute_bucket_15": f"WITH {_BASE} SELECT event_id, {_minute(15)} AS minute FROM timed",
    "minute_bucket_7": f"WITH {_BASE} SELECT event_id, {_minute(7)} AS minute FROM timed",
    "valid_buckets": (
        f"WITH {_BASE} SELECT b AS minute, count(*) AS hits FROM"
        f" (SELECT {_minute(5)} AS b FROM timed) WHERE CAST(b AS INT) % 15 = 0 GROUP BY 1"
    ),
    "partition_prefix": (
        f"WITH {_BASE} SELECT event_id,"
        " concat('dt=', dt, '/hour=', hour, '/minute=', minute) AS prefix FROM base"
    ),
    "earliest_partition": (
        f"WITH {_RAW}{_FILE_TOTALS} SELECT source_file, min_hit_ts, dt, hour, minute FROM fp"
    ),
    "url_host": f"WITH {_URLS} SELECT origin, id, host FROM hosts",
    "query_params": f"""WITH {_URLS},
parts AS (SELECT origin, id, list_filter(
    string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
    lambda x: regexp_matches(x, '^[^=]*=.')) AS p FROM urls),
flat AS (SELECT origin, id, unnest(p) AS x, generate_subscripts(p, 1) AS pos FROM parts)
SELECT origin, id, CAST(pos AS BIGINT) AS pos,
  url_decode(replace(split_part(x, '=', 1), '+', ' ')) AS name,
  url_decode(replace(substr(x, strpos(x, '=') + 1), '+', ' ')) AS value FROM flat""",
    "engine_class": f"WITH {_URLS} SELECT origin, id, {_ENGINE} AS engine FROM hosts",
    "engine_domain": (
        f"WITH {_URLS} SELECT origin, id,"
        " list_aggregate(string_split(host, '.')[-2:], 'string_agg', '.') AS engine_domain FROM hosts"
    ),
    "search_keyword": f"WITH {_BASE} SELECT event_id, k AS keyword FROM base",
    "referrer_touch": f"WITH {_BASE} SELECT event_id, e AS engine_domain, k AS keyword FROM base",
    "visitor_id": (
        f"WITH {_BASE} SELECT event_id, {_RAW_VID} AS visitor_id FROM base WHERE trim(ip) <> ''"
    ),
    "mask_ip": f"WITH {_BASE} SELECT event_id, {_MASK_IP.format(ip='ip')} AS ip FROM base",
    "mask_user_agent": f"WITH {_BASE} SELECT event_id, {_MASK_UA} AS user_agent FROM base",
    "mask_location": f"WITH {_BASE} SELECT event_id, {_GEO} FROM base",
    "mask_pii": (
        f"WITH {_BASE} SELECT event_id, {_MASK_IP.format(ip='ip')} AS ip,"
        f" {_MASK_UA} AS user_agent, {_GEO}, pagename FROM base"
    ),
    "event_array": f"""WITH {_BASE},
lists AS (SELECT event_id, string_split(event_list, ',') AS l FROM base)
SELECT event_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS pos, trim(unnest(l)) AS event
FROM lists""",
    "product_lines": f"""WITH {_BASE},
lists AS (SELECT event_id, string_split(product_list, ',') AS l FROM base),
lines AS (SELECT event_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS pos, unnest(l) AS x FROM lists)
SELECT event_id, pos, trim(split_part(x, ';', 1)) AS category, trim(split_part(x, ';', 2)) AS product,
  trim(split_part(x, ';', 3)) AS quantity, {_LINE} AS revenue FROM lines""",
    "product_revenue": f"WITH {_BASE} SELECT event_id, round(rv, 2) AS revenue FROM base",
    "last_touch": f"WITH {_RAW} SELECT event_id, engine_domain, keyword FROM touched",
    "last_touch_masked": f"WITH {_MASKED} SELECT event_id, engine_domain, keyword FROM touched",
    "last_touch_by_file": f"WITH {_BY_FILE} SELECT event_id, engine_domain, keyword FROM touched",
    "report_kpis": f"""WITH {_REPORT} SELECT CAST(round(total, 2) AS DOUBLE) AS total_revenue,
  n AS total_keywords, engines AS total_search_engines,
  {_mean('total', 'n')} AS avg_revenue_per_keyword FROM kpis""",
    "top_keywords": f"WITH {_REPORT} SELECT best AS rank, {_KEYWORD_COLUMNS} FROM ranked WHERE best <= 10",
    "bottom_keywords": f"""WITH {_REPORT} SELECT
  row_number() OVER (ORDER BY worst DESC) AS rank, {_KEYWORD_COLUMNS} FROM ranked WHERE worst <= 10""",
    "engine_metrics": f"""WITH {_REPORT} SELECT engine, CAST(round(r, 2) AS DOUBLE) AS total_revenue,
  {_ratio('r', _TOTAL, 100)} AS revenue_percentage, c AS keyword_count,
  {_mean('r', 'c')} AS avg_revenue_per_keyword FROM eng""",
    "revenue_trend": f"""WITH {_REPORT} SELECT date, CAST(round(r, 2) AS DOUBLE) AS total_revenue,
  kw AS unique_keywords, eg AS unique_search_engines,
  {_mean('r', 'kw')} AS avg_revenue_per_keyword FROM trend""",
    "period_change": f"""WITH {_REPORT} SELECT date, CAST(round(r, 2) AS DOUBLE) AS total_revenue,
  CAST(round(p, 2) AS DOUBLE) AS previous_revenue, {_ratio('(r - p)', 'p', 100)} AS change_percentage FROM pc""",
    "concentration": f"""WITH {_METRICS} SELECT CAST(round(five, 2) AS DOUBLE) AS top5_revenue,
  {_ratio('five', 'exact_total', 100)} AS top5_percentage FROM m WHERE five IS NOT NULL""",
    "insights": f"WITH {_METRICS},{_INSIGHTS} SELECT pos, rule, text FROM insights",
    "recommendations": f"WITH {_METRICS},{_RECOMMENDATIONS} SELECT pos, rule, text FROM recommendations",
    "chart_series": f"""WITH {_REPORT}
SELECT 'keywords' AS series, best AS pos, keyword AS label,
  concat(keyword, ' (', engine_domain, ')') AS full_label, CAST(round(revenue, 2) AS DOUBLE) AS value
FROM ranked WHERE best <= 10
UNION ALL SELECT 'engines', row_number() OVER (ORDER BY r DESC, engine), engine, engine, CAST(round(r, 2) AS DOUBLE)
FROM eng
UNION ALL SELECT 'trend', row_number() OVER (ORDER BY date), date, date, CAST(round(r, 2) AS DOUBLE)
FROM trend""",
    "insight_dedupe": (
        f"WITH {_RAW}{_INSIGHT_ROWS} SELECT {_SHOWN} FROM ({_LATEST.format(t='ins')})"
    ),
    "insight_upsert": f"""WITH {_RAW}{_TOTALS}{_INSIGHT_ROWS},
known AS (SELECT * FROM ins WHERE search_engine_domain <> 'google.com'),
latest AS ({_LATEST.format(t='known')}),
both_sides AS (SELECT l.keyword_id, l.score AS old, l.processed, t.revenue AS new,
    coalesce(l.search_engine_domain, t.engine_domain) AS search_engine_domain,
    coalesce(l.search_keyword, t.keyword) AS search_keyword
  FROM latest l FULL JOIN totals t
    ON l.search_engine_domain = t.engine_domain AND l.search_keyword = t.keyword),
numbered AS (SELECT *, row_number() OVER (PARTITION BY keyword_id IS NULL ORDER BY
    substr(md5(concat(search_engine_domain, chr(1), search_keyword)), 1, 4),
    search_engine_domain, search_keyword) AS n FROM both_sides)
SELECT coalesce(keyword_id, (SELECT max(keyword_id) FROM known) + n) AS keyword_id,
  search_engine_domain, search_keyword, round(coalesce(CAST(new AS DOUBLE), old), 2) AS revenue_impact_score,
  CASE WHEN new IS NULL THEN processed ELSE {_RUN_SECONDS} END AS processed_seconds FROM numbered""",
    "fact_replace": f"""WITH {_RAW}{_TOTALS}{_DAYS}
SELECT dt AS event_date, engine_domain AS search_engine_domain, keyword AS search_keyword,
  CAST(round(revenue, 2) AS DOUBLE) AS total_revenue FROM days WHERE dt <> '{RUN_DATE}'
UNION ALL SELECT '{RUN_DATE}', engine_domain, keyword, CAST(round(revenue, 2) AS DOUBLE) FROM totals""",
    "check_sinks": f"""WITH {_RAW}{_DAYS}{_INSIGHT_ROWS}
SELECT (SELECT count(*) FROM days WHERE dt = '{RUN_DATE}') AS fact_rows,
  (SELECT count(*) FROM ins WHERE processed >= {_RUN_SECONDS} - 7200) AS recent_insights""",
    "object_partition": (
        f"WITH {_BY_FILE}{_FILE_TOTALS} SELECT source_file, engine_domain, keyword,"
        " CAST(round(revenue, 2) AS DOUBLE) AS revenue, dt, hour, minute FROM ft JOIN fp USING (source_file)"
    ),
    "write_curated": f"WITH {_RAW}{_TOTALS} SELECT {_DISPLAY} FROM totals",
    "write_staging": (
        f"WITH {_BASE} SELECT event_id, hit_ts, {_MASK_IP.format(ip='ip')} AS ip,"
        f" {_MASK_UA} AS user_agent, CASE WHEN concat(geo_city, geo_region, geo_country) <> ''"
        " THEN 'masked_city' ELSE geo_city END AS geo_city, dt, hour,"
        f" {_minute(STAGING_INTERVAL)} AS minute FROM base"
    ),
    "write_tab": (
        f'WITH {_RAW}{_TOTALS} SELECT engine_domain AS "Search Engine Domain",'
        ' keyword AS "Search Keyword", printf(\'%.2f\', CAST(revenue AS DOUBLE)) AS "Revenue" FROM totals'
    ),
    "write_object_curated": f"""WITH {_BY_FILE}{_FILE_TOTALS} SELECT {_DISPLAY}, dt, hour, minute,
  concat(replace(split_part(source_file, '/', 3), '.tsv', ''), '_',
    substr(sha256(source_file), 1, 16), '_{RUN_DATE}_SearchKeywordPerformance') AS output
FROM ft JOIN fp USING (source_file)""",
    "late_rows": (
        f"WITH {_BASE} SELECT dt, hour, {_minute(STAGING_INTERVAL)} AS minute, count(*) AS hits"
        " FROM base GROUP BY ALL"
    ),
    "last_touch_hot": f"WITH {_RAW} SELECT event_id, engine_domain, keyword FROM touched",
    "scan_mixed_names": _CORE,
    "scan_staged": _CORE,
    "staging_reruns": _CORE,
    "staging_compacted": _CORE,
    "scan_schemas": (
        f"WITH {_BASE} SELECT event_id, hit_ts, ip, CASE WHEN hit_time_gmt = 'bad' THEN geo_city END"
        " AS geo_city, referrer FROM base"
    ),
    "stream_same_names": (
        f"WITH {_BY_FILE}{_FILE_TOTALS}".replace("substr(date_time, 1, 10)", "substr(date_time, 1, 9)")
        + " SELECT dt, hour, minute, engine_domain, keyword,"
        " CAST(round(revenue, 2) AS DOUBLE) AS revenue FROM ft JOIN fp USING (source_file)"
    ),
    "run_batch": (
        f"WITH {_RAW}{_TOTALS} SELECT {_DISPLAY}, (SELECT count(*) FROM totals) AS insights,"
        " (SELECT count(*) FROM base) AS staged FROM totals"
    ),
    "report_rows": f"WITH {_ALL} {_ROWS}",
    "report_row": f"""WITH {_ALL} SELECT '{RUN_DATE}' AS report_date,
  '{RUN_TIME.replace(' ', 'T')}' AS report_timestamp, '{RUN_DATE}' AS dt, '12' AS hour, '00' AS minute_bucket,
  CAST(round(total, 2) AS DOUBLE) AS total_revenue, n AS total_keywords, engines AS total_search_engines,
  {_mean('total', 'n')} AS avg_revenue_per_keyword,
  least(n, 10) AS n_top_keywords, least(n, 10) AS n_bottom_keywords,
  (SELECT count(*) FROM eng) AS n_search_engines, (SELECT count(*) FROM trend) AS n_revenue_trend,
  (SELECT count(*) FROM insights) AS n_insights, (SELECT count(*) FROM recommendations) AS n_recommendations,
  (SELECT keyword FROM ranked WHERE best = 1) AS top_keyword,
  (SELECT CAST(round(revenue, 2) AS DOUBLE) FROM ranked WHERE worst = least(n, 10)) AS bottom_revenue,
  (SELECT string_agg(engine, ',' ORDER BY r DESC, engine) FROM eng) AS engines,
  (SELECT string_agg(date, ',' ORDER BY date) FROM trend) AS dates,
  (SELECT coalesce(string_agg(text, '|' ORDER BY pos), '') FROM insights) AS insights,
  (SELECT coalesce(string_agg(text, '|' ORDER BY pos), '') FROM recommendations) AS recommendations
FROM kpis""",
    "scan_tsv_line_breaks": (
        f"WITH {_BASE} SELECT event_id, hit_ts, ip, event_list, product_list, referrer,"
        " CASE WHEN event_id % 10 = 3 AND CAST(substr(date_time, 9, 2) AS INT) % 2 = 0"
        " THEN concat(user_agent, chr(10), 'of two', chr(9), '\"lines\"') ELSE user_agent END AS user_agent FROM base"
    ),
    "read_history_range": (
        f"WITH {_RAW}{_DAYS} SELECT dt AS date, engine_domain, keyword, CAST(round(revenue, 2) AS DOUBLE) AS revenue"
        f" FROM days WHERE dt BETWEEN '{RUN_DATE}' AND '2024-01-20'"
    ),
    "revenue_trend_incremental": f"""WITH {_RAW}{_DAYS},
rounded AS (SELECT dt, keyword, engine_domain, CAST(round(revenue, 2) AS DECIMAL(38, 6)) AS revenue FROM days),
t AS (SELECT dt AS date, sum(revenue) AS r, count(DISTINCT keyword) AS kw, count(DISTINCT engine_domain) AS eg
  FROM rounded GROUP BY ALL)
SELECT date, CAST(round(r, 2) AS DOUBLE) AS total_revenue, kw AS unique_keywords, eg AS unique_search_engines,
  {_mean('r', 'kw')} AS avg_revenue_per_keyword FROM t""",
    "sql_surface": f"WITH {_RAW} {_KEYWORD_ROWS}",
    "sql_functions": f"""WITH {_URLS},{_DERIVED}
SELECT b.event_id, h.host, {_ENGINE.replace("contains(host", "contains(h.host")} AS engine, k AS keyword,
  {_RAW_VID} AS visitor, {_MASK_IP.format(ip='ip')} AS ip, {_MASK_UA} AS user_agent,
  CASE WHEN concat(geo_city, geo_region, geo_country) <> '' THEN coalesce(nullif(geo_country, ''), 'unknown')
    ELSE geo_country END AS geo_country,
  CAST(round(CAST(rv AS DECIMAL(38, 6)), 2) AS DOUBLE) AS revenue,
  list_contains(list_transform(string_split(event_list, ','), lambda z: trim(z)), '1') AS purchase,
  hit_ts, dt, hour, {_minute(7)} AS minute
FROM base b JOIN hosts h ON h.origin = 'hit' AND h.id = b.event_id""",
    "sql_tables": f"""WITH {_RAW}{_TOTALS}
SELECT engine_domain, count(*) AS keywords, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, count(*) AS insights,
  count(*) AS facts, CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE) AS fact_revenue
FROM totals GROUP BY engine_domain""",
    "report_json": _JSON,
    "write_report_json": _JSON,
    "sync_facts": f"""WITH {_RAW}{_TOTALS}{_DAYS}
SELECT dt AS event_date, engine_domain AS search_engine_domain, keyword AS search_keyword,
  CAST(round(revenue, 2) AS DOUBLE) AS total_revenue FROM days WHERE dt <> '{RUN_DATE}'
UNION ALL SELECT '{RUN_DATE}', engine_domain, keyword, CAST(round(revenue, 2) AS DOUBLE) FROM totals""",
    "sync_insights": f"""WITH {_RAW}{_TOTALS},
early AS (SELECT DISTINCT engine_domain, keyword FROM sales WHERE hit_ts // 3600 % 2 = 0),
keyed AS (SELECT t.*, e.keyword IS NULL AS fresh,
    substr(md5(concat(t.engine_domain, chr(1), t.keyword)), 1, 4) AS b
  FROM totals t LEFT JOIN early e ON t.engine_domain = e.engine_domain AND t.keyword = e.keyword)
SELECT row_number() OVER (ORDER BY fresh, b, engine_domain, keyword) AS keyword_id,
  engine_domain AS search_engine_domain, keyword AS search_keyword,
  CAST(round(revenue, 2) AS DOUBLE) AS revenue_impact_score, {_RUN_SECONDS} AS processed_seconds FROM keyed""",
}
