"""The hits frame the registered queries run on, derived from the `events` table."""

from pyspark.sql import DataFrame, SparkSession

from touchline.operators.normalize import normalize_hits

TIE = ["event_id"]

_TEMPLATE = """
SELECT event_id,
  CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST({EPOCH} AS {STR}) END AS hit_time_gmt,
  CAST(ts AS {STR}) AS date_time,
  concat('UA-', CAST(user_id % 2 AS {STR})) AS user_agent,
  CASE WHEN event_id % 89 = 0 THEN ' '
       WHEN user_id % 50 = 7 THEN concat('fe80::', CAST(user_id AS {STR}))
       ELSE concat('10.0.', CAST({DIV3} AS {STR}), '.', CAST(user_id % 3 + 1 AS {STR})) END AS ip,
  CASE event_type WHEN 'purchase' THEN '1' WHEN 'view' THEN '2, 1 '
       WHEN 'signup' THEN '10,11' WHEN 'click' THEN '12' ELSE '' END AS event_list,
  CASE WHEN user_id % 4 = 0 THEN '' ELSE concat('City', CAST(user_id % 9 AS {STR})) END AS geo_city,
  CASE WHEN user_id % 4 = 0 THEN '' ELSE 'OR' END AS geo_region,
  CASE WHEN user_id % 4 = 0 THEN '' WHEN user_id % 4 = 1 THEN '' ELSE 'US' END AS geo_country,
  event_type AS pagename,
  'http://www.esshopzilla.com' AS page_url,
  CASE WHEN event_id % 7 = 0 THEN 'Electronics;Blank;1;;'
       WHEN event_id % 13 = 0 THEN 'Electronics;Bad;1;n/a;,Gift;Card;1;nan;'
       WHEN event_id % 17 = 0 THEN concat('Returns;Refund;1;-5000;,Electronics;Item;1;',
            CAST(CAST(value AS DECIMAL(18,2)) AS {STR}), ';')
       WHEN event_id % 3 = 0 THEN concat('Computers;Item;1;',
            CAST(CAST(value AS DECIMAL(18,2)) AS {STR}), ';200|201,Office;Folder;4; 1.50 ;205')
       ELSE concat('Electronics;Item;1;',
            CAST(CAST(value AS DECIMAL(18,2)) AS {STR}), ';') END AS product_list,
  CASE event_id % 11
       WHEN 0 THEN concat('http://www.google.com/search?hl=en&q=Item%20', CAST(event_id % 5 AS {STR}))
       WHEN 1 THEN concat('http://www.bing.com/search?q=Zune+', CAST(event_id % 4 AS {STR}), '&form=QBLH')
       WHEN 2 THEN concat('http://search.yahoo.com/search?p=cd+player', CAST(event_id % 3 AS {STR}))
       WHEN 3 THEN 'https://www.google.co.uk/search?q=Ipod'
       WHEN 4 THEN 'http://www.google.com/'
       WHEN 5 THEN 'http://www.ask.com/web?q=&ask=Two%2BOne'
       ELSE 'http://www.esshopzilla.com/cart/?q=none' END AS referrer
FROM {EVENTS}
"""

DUCKDB_HITS = _TEMPLATE.format(
    EPOCH="epoch_us(ts) // 1000000", DIV3="user_id // 3", STR="VARCHAR", EVENTS="events"
)


def raw_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as landed hits, all text."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(
        _TEMPLATE.format(
            EPOCH="unix_seconds(CAST(ts AS TIMESTAMP))", DIV3="user_id div 3",
            STR="string", EVENTS="{events}",
        ),
        events=events,
    )


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, normalised."""
    return normalize_hits(raw_hits(spark, sf_dir))
