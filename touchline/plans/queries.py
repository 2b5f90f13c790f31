"""The registered queries: one per operator, each over the whole of its tables."""

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import catalog
from touchline.fixed_values import CURATED_NAMES, CURATED_SUFFIX
from touchline.functions import clock, privacy, products, url
from touchline.functions.money import cents
from touchline.operators import report
from touchline.operators.attribution import (
    SOURCE_FILE,
    attribute_last_touch,
    attributed_purchases,
    with_visitor,
)
from touchline.operators.checks import check_sinks
from touchline.operators.normalize import (
    TEXT_COLUMNS,
    earliest_partition,
    normalize_columns,
    normalize_types,
    require_hit_columns,
    with_time_partition,
)
from touchline.operators.revenue import keyword_revenue, keyword_totals, to_display
from touchline.operators.tables import dedupe_insights, replace_date, to_facts, upsert_insights
from touchline.plans.batch import run_batch
from touchline.plans.hits import TIE, event_hits, raw_hits
from touchline.session import remove_folder, settle, shared_folder, tune
from touchline.sinks.compaction import compact_staging
from touchline.sinks.files import (
    write_curated,
    write_object_curated,
    write_staging,
    write_tab,
    with_object_partition,
)
from touchline.sinks.tables import read_facts, read_insights, sync_facts, sync_insights
from touchline.sinks.trend import read_trend, update_trend
from touchline.sources.folders import files_below, matching, rename
from touchline.sources.landing import convert_tsv_to_parquet, read_hits
from touchline.sources.layers import (
    output_exists,
    read_curated,
    read_history,
    read_staging,
)
from touchline.streaming.incremental import run_incremental

RUN_DATE = "2024-01-02"
RUN_TIME = "2024-01-02 12:00:00"
STAGING_INTERVAL = 60

col = F.col


# Frames the queries share.


def _sales(spark, sf, **options) -> DataFrame:
    return attributed_purchases(event_hits(spark, sf), tie=TIE, **options)


def _totals(spark, sf) -> DataFrame:
    return keyword_totals(_sales(spark, sf))


def _settled_totals(spark, sf) -> DataFrame:
    """For reports, which read the totals several times."""
    return settle(_totals(spark, sf))


def _dated_totals(spark, sf) -> DataFrame:
    """Keyword revenue per day of the purchase."""
    return keyword_totals(with_time_partition(_sales(spark, sf)), by=["dt"])


def _history(spark, sf) -> DataFrame:
    return _dated_totals(spark, sf).withColumnRenamed("dt", "date")


def _day():
    return F.substring("date_time", 1, 10)


def _filed_hits(spark, sf) -> DataFrame:
    """Hits as if each day had landed as one file."""
    name = F.concat(F.lit("/landing/hits-"), _day(), F.lit(".tsv"))
    return event_hits(spark, sf).withColumn(SOURCE_FILE, name)


def _landed(df: DataFrame, path: str, fmt: str) -> None:
    """Write hits into one folder per day, as a landing zone receives them."""
    writer = df.withColumn("day", _day()).write.partitionBy("day")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        (
            writer.option("header", "true").option("sep", "\t").option("quote", '"')
            .option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false").csv(path)
        )


def _urls(spark, sf) -> DataFrame:
    """All URLs at hand: referrers of the hits, and the pages."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    hits = raw_hits(spark, sf)
    return hits.select(
        F.lit("hit").alias("origin"), col("event_id").alias("id"), col("referrer").alias("url")
    ).unionByName(
        pages.select(F.lit("page").alias("origin"), col("page_id").alias("id"), "url")
    )


def _cents(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: cents(col(n)) for n in names})


_CORE = ["event_id", "hit_ts", "ip", "user_agent", "event_list", "product_list", "referrer"]


def _core(df: DataFrame) -> DataFrame:
    return df.select(col("event_id").cast("bigint").alias("event_id"), *_CORE[1:])


# Scans.


def scan_hits_parquet(spark, sf):
    path = shared_folder(spark)
    _landed(raw_hits(spark, sf), path, "parquet")
    return _core(read_hits(spark, path))


def scan_hits_tsv(spark, sf):
    path = shared_folder(spark)
    _landed(raw_hits(spark, sf), path, "tsv")
    return _core(read_hits(spark, path, "tsv"))


def scan_tsv_line_breaks(spark, sf):
    """On every other day some user agents hold a line break, a tab and a quote."""
    path = shared_folder(spark)
    some = (col("event_id") % 10 == 3) & (F.substring("date_time", 9, 2).cast("int") % 2 == 0)
    broken = F.concat("user_agent", F.lit('\nof two\t"lines"'))
    hits = raw_hits(spark, sf).withColumn("user_agent", F.when(some, broken).otherwise(col("user_agent")))
    _landed(hits, path, "tsv")
    return _core(read_hits(spark, path, "tsv"))


def tsv_to_parquet(spark, sf):
    path = shared_folder(spark)
    _landed(raw_hits(spark, sf), f"{path}/tsv", "tsv")
    convert_tsv_to_parquet(spark, f"{path}/tsv", f"{path}/parquet")
    return spark.read.parquet(f"{path}/parquet").select(
        col("event_id").cast("bigint").alias("event_id"), "hit_time_gmt", "ip", "event_list",
        "geo_city", "product_list",
    )


def scan_pruned(spark, sf):
    path = shared_folder(spark)
    write_staging(event_hits(spark, sf), path, STAGING_INTERVAL, mask=False)
    hits = read_hits(spark, path, dt=RUN_DATE, hour="6")
    return hits.select("event_id", "hit_ts", "ip", "referrer")


def scan_mixed(spark, sf):
    path = shared_folder(spark)
    hits = raw_hits(spark, sf)
    is_sale = products.has_event(col("event_list"))
    _landed(hits.where(is_sale), f"{path}/a", "parquet")
    _landed(hits.where(~is_sale), f"{path}/b", "tsv")
    return _core(read_hits(spark, path, "auto"))


def read_curated_query(spark, sf):
    path = shared_folder(spark)
    write_curated(_totals(spark, sf), path, RUN_DATE)
    return read_curated(spark, path, RUN_DATE)


def _write_runs(days: DataFrame, path: str) -> None:
    """Each day's totals as the curated result of that day."""
    staged = f"{path}-runs-{uuid4().hex}"
    run = F.concat("dt", F.lit(f"_{CURATED_SUFFIX}")).alias("run")
    days.select("*", run).select(
        "run", *(cents(col(c)).alias(s) if c == "revenue" else col(c).alias(s)
                 for c, s in CURATED_NAMES.items())
    ).write.partitionBy("run").parquet(staged)
    for folder in matching(days.sparkSession, f"{staged}/run=*"):
        rename(days.sparkSession, folder, f"{path}/{folder.rpartition('run=')[2]}")


def read_history_query(spark, sf):
    path = shared_folder(spark)
    _write_runs(_dated_totals(spark, sf), path)
    return read_history(spark, path)


def stream_ingest(spark, sf):
    """Every day's hits land as one file, however many tasks read the table."""
    path = shared_folder(spark)
    _one_file_each(raw_hits(spark, sf), f"{path}/landing", "parquet", "hits.parquet", day=_day())
    _ingest(spark, path, identity="masked")
    return _object_results(spark, f"{path}/out")


def _ingest(spark, path, **options):
    run_incremental(
        spark, f"{path}/landing", f"{path}/out", f"{path}/checkpoint", run_date=RUN_DATE, **options
    ).awaitTermination()


def _object_results(spark, path):
    curated = spark.read.parquet(path).withColumnsRenamed(
        {shown: name for name, shown in CURATED_NAMES.items()}
    )
    return curated.select("dt", "hour", "minute", "engine_domain", "keyword", "revenue")


def _one_file_each(df: DataFrame, path: str, fmt: str, name: str, day=None) -> None:
    """The hits of ten days at a time as one file of a given name, in a folder of its own; or by the
    given `day`. A file holds its hits in the order they came in, as hits of one second are told
    apart by their place."""
    spark = df.sparkSession
    parts = f"{path}-parts"
    day = F.substring("date_time", 1, 9) if day is None else day
    # Without nulls, so that the order that the write asks for is the one the rows have.
    df = df.withColumn("day", F.coalesce(day, F.lit("")))
    df = df.repartition("day").sortWithinPartitions("day", "event_id")
    writer = df.write.partitionBy("day")
    if fmt == "parquet":
        writer.parquet(parts)
    else:
        writer.option("header", "true").option("sep", "\t").option("quote", '"').option(
            "escape", '"').option("ignoreLeadingWhiteSpace", "false").option(
            "ignoreTrailingWhiteSpace", "false").csv(parts)
    for file in files_below(spark, parts):
        rename(spark, file, f"{path}/{file.split('/')[-2].removeprefix('day=')}/{name}")


def stream_same_names(spark, sf):
    """Files of one name in many folders, one file per batch, processed twice."""
    path = shared_folder(spark)
    _one_file_each(raw_hits(spark, sf), f"{path}/landing", "parquet", "hits.parquet")
    _ingest(spark, path, max_files=1)
    remove_folder(spark, f"{path}/checkpoint")
    _ingest(spark, path, max_files=5)
    return _object_results(spark, f"{path}/out")


def scan_mixed_names(spark, sf):
    """Parquet and text told apart by content where the name does not tell."""
    path = shared_folder(spark)
    hits = raw_hits(spark, sf)
    id4 = col("event_id") % 4
    _one_file_each(hits.where(id4 == 0), f"{path}/in/a", "parquet", "hits.parq")
    _one_file_each(hits.where(id4 == 1), f"{path}/in/b", "parquet", "noext")
    _one_file_each(hits.where(id4 == 2), f"{path}/in/c", "parquet", "hits.tsv.parquet")
    _one_file_each(hits.where(id4 == 3), f"{path}/in/d", "tsv", "plain")
    return _core(read_hits(spark, f"{path}/in", "auto"))


def scan_schemas(spark, sf):
    """Times as numbers in some files and as text in others; a column that some files lack."""
    path = shared_folder(spark)
    hits = raw_hits(spark, sf)
    numeric = col("hit_time_gmt").rlike("^[0-9]+$")
    whole = hits.where(numeric).withColumn("hit_time_gmt", col("hit_time_gmt").cast("bigint"))
    _landed(whole.drop("geo_city"), f"{path}/a", "parquet")
    _landed(hits.where(~numeric), f"{path}/b", "parquet")
    found = read_hits(spark, path)
    return found.select(
        col("event_id").cast("bigint").alias("event_id"), "hit_ts", "ip", "geo_city", "referrer"
    )


def scan_staged(spark, sf):
    """Landed hits, staged, and read as hits once more."""
    path = shared_folder(spark)
    _landed(raw_hits(spark, sf), f"{path}/landing", "parquet")
    write_staging(read_hits(spark, f"{path}/landing"), f"{path}/staging", STAGING_INTERVAL, mask=False)
    return _core(read_hits(spark, f"{path}/staging"))


def staging_reruns(spark, sf):
    """Two landing slices whose rows share hours; the second is staged twice."""
    path = shared_folder(spark)
    hits = raw_hits(spark, sf)
    late = col("event_id") % 5 == 0
    slices = {"first": hits.where(~late), "second": hits.where(late)}
    for name, rows in slices.items():
        _landed(rows, f"{path}/{name}", "parquet")
    for name in ("first", "second", "second"):
        source = f"{path}/{name}"
        write_staging(
            read_hits(spark, source), f"{path}/staging", STAGING_INTERVAL, mask=False, source=source
        )
    return _core(read_staging(spark, f"{path}/staging"))


def staging_compacted(spark, sf):
    """Nine slices that share hours, merged, one staged again, and merged once more."""
    path = shared_folder(spark)
    landed, staged = f"{path}/landing", f"{path}/staging"
    event_hits(spark, sf).withColumn("part", col("event_id") % 9).write.partitionBy("part").parquet(landed)

    def stage(k):
        part = spark.read.parquet(f"{landed}/part={k}")
        write_staging(part, staged, STAGING_INTERVAL, mask=False, source=f"slice {k}")

    for k in range(9):
        stage(k)
    compact_staging(spark, staged)
    stage(4)
    compact_staging(spark, staged, least=2)
    return _core(read_staging(spark, staged))


# Normalisation.


def norm_columns(spark, sf):
    hits = raw_hits(spark, sf)
    shouted = hits.toDF(*(c.upper() if i % 2 else c.title() for i, c in enumerate(hits.columns)))
    fixed = require_hit_columns(normalize_columns(shouted))
    return fixed.select("event_id", "hit_time_gmt", "ip", "user_agent", "referrer")


def norm_types(spark, sf):
    odd = raw_hits(spark, sf).select(
        "event_id", "hit_time_gmt", "user_agent",
        F.when(col("ip") != " ", col("ip")).alias("ip"),
        F.length("event_list").cast("double").alias("event_list"),
        F.nullif(col("event_list"), F.lit("")).alias("product_list"),
        col("referrer").cast("binary").alias("referrer"),
    )
    return normalize_types(odd).select(
        "event_id", "ip", "user_agent", "event_list", "product_list", "referrer"
    )


def hit_ts(spark, sf):
    return event_hits(spark, sf).select("event_id", "hit_ts")


def curated_projection(spark, sf):
    return to_display(_totals(spark, sf))


# Filters.


def purchase_hits(spark, sf):
    hits = event_hits(spark, sf)
    sale = products.has_event(col("event_list")) & products.has_products(col("product_list"))
    return hits.where(sale).select("event_id", "event_list", "product_list")


def attributed_purchases_query(spark, sf):
    return _cents(
        _sales(spark, sf).select("event_id", "engine_domain", "keyword", "revenue"), "revenue"
    )


def check_output(spark, sf):
    path = shared_folder(spark)
    write_curated(_totals(spark, sf), path, RUN_DATE)
    days = _totals(spark, sf).agg(F.count(F.lit(1)).alias("totals"))
    found = {day: output_exists(spark, path, day) for day in (RUN_DATE, "1999-12-31")}
    asked = F.explode(F.create_map(*(F.lit(x) for pair in found.items() for x in pair)))
    return days.select(asked.alias("run_date", "found"), "totals")


# Time.


def time_partitions(spark, sf):
    parts = with_time_partition(event_hits(spark, sf))
    time = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_time")
    return parts.select("event_id", "hit_ts", time, "dt", "hour", "minute")


def _buckets(spark, sf, interval):
    ts = clock.event_ts(col("hit_ts"))
    return event_hits(spark, sf).select(
        "event_id", clock.minute_bucket(ts, interval).alias("minute")
    )


def minute_bucket_15(spark, sf):
    return _buckets(spark, sf, 15)


def minute_bucket_7(spark, sf):
    return _buckets(spark, sf, 7)


def valid_buckets(spark, sf):
    """Buckets of 5 minutes that are buckets of 15 minutes, too."""
    valid = col("minute").isin(clock.valid_minute_buckets(15))
    return _buckets(spark, sf, 5).where(valid).groupBy("minute").agg(
        F.count(F.lit(1)).alias("hits")
    )


def partition_prefix(spark, sf):
    prefix = clock.partition_prefix(col("dt"), col("hour"), col("minute"))
    return with_time_partition(event_hits(spark, sf)).select("event_id", prefix.alias("prefix"))


def earliest_partition_query(spark, sf):
    return earliest_partition(_filed_hits(spark, sf), by=[SOURCE_FILE])


# URLs, identity, masking.


def url_host(spark, sf):
    return _urls(spark, sf).select("origin", "id", url.url_host(col("url")).alias("host"))


def query_params(spark, sf):
    pairs = F.posexplode(url.query_pairs(col("url"))).alias("pos", "pair")
    return _urls(spark, sf).select("origin", "id", pairs).select(
        "origin", "id", (col("pos") + 1).cast("bigint").alias("pos"),
        col("pair.name").alias("name"), col("pair.value").alias("value"),
    )


def engine_class(spark, sf):
    return url_host(spark, sf).select(
        "origin", "id", F.nullif(url.engine_of(col("host")), F.lit("")).alias("engine")
    )


def engine_domain(spark, sf):
    return url_host(spark, sf).select(
        "origin", "id", url.engine_domain(col("host")).alias("engine_domain")
    )


def search_keyword(spark, sf):
    parts = event_hits(spark, sf).select(
        "event_id", url.engine_of(url.url_host(col("referrer"))).alias("engine"),
        url.url_query(col("referrer")).alias("query"),
    )
    return parts.select("event_id", url.search_keyword(col("engine"), col("query")).alias("keyword"))


def referrer_touch(spark, sf):
    touched = url.with_touch(event_hits(spark, sf))
    return touched.select(
        "event_id", col("touch.engine_domain").alias("engine_domain"),
        col("touch.keyword").alias("keyword"),
    )


def visitor_id(spark, sf):
    return with_visitor(event_hits(spark, sf)).select("event_id", "visitor_id")


def mask_ip(spark, sf):
    return event_hits(spark, sf).select("event_id", privacy.mask_ip(col("ip")).alias("ip"))


def mask_user_agent(spark, sf):
    masked = privacy.mask_user_agent(col("user_agent")).alias("user_agent")
    return event_hits(spark, sf).select("event_id", masked)


def mask_location(spark, sf):
    return privacy.mask_location(raw_hits(spark, sf)).select("event_id", *privacy.GEO_COLUMNS)


def mask_pii(spark, sf):
    return privacy.mask_pii(raw_hits(spark, sf)).select(
        "event_id", "ip", "user_agent", *privacy.GEO_COLUMNS, "pagename"
    )


# Lists.


def event_array(spark, sf):
    items = F.posexplode(products.event_array(col("event_list"))).alias("pos", "event")
    return event_hits(spark, sf).select("event_id", items).select(
        "event_id", (col("pos") + 1).cast("bigint").alias("pos"), "event"
    )


def product_lines(spark, sf):
    lines = F.posexplode(products.product_lines(col("product_list"))).alias("pos", "line")
    return event_hits(spark, sf).select("event_id", lines).select(
        "event_id", (col("pos") + 1).cast("bigint").alias("pos"), "line.*"
    )


def product_revenue(spark, sf):
    revenue = F.round(products.product_revenue(col("product_list")), 2).alias("revenue")
    return event_hits(spark, sf).select("event_id", revenue)


# Attribution and revenue.


def _touches(hits, **options):
    touched = attribute_last_touch(hits, tie=TIE, **options)
    return touched.select(
        "event_id", col("last_touch.engine_domain").alias("engine_domain"),
        col("last_touch.keyword").alias("keyword"),
    )


def last_touch(spark, sf):
    return _touches(event_hits(spark, sf))


def last_touch_masked(spark, sf):
    return _touches(event_hits(spark, sf), identity="masked")


def last_touch_hot(spark, sf):
    """With nearly every visitor taken for a hot one, so cut into slices."""
    return _touches(event_hits(spark, sf), hot_rows=20)


def last_touch_by_file(spark, sf):
    return _touches(_filed_hits(spark, sf), scope="file")


def keyword_revenue_query(spark, sf):
    return _cents(keyword_revenue(_sales(spark, sf)), "revenue")


def keyword_revenue_masked(spark, sf):
    return _cents(keyword_revenue(_sales(spark, sf, identity="masked")), "revenue")


# Reports.

_REPORT_CENTS = {"revenue", "total_revenue", "revenue_percentage", "avg_revenue_per_keyword",
                 "top5_revenue", "top5_percentage", "previous_revenue", "change_percentage"}


def _report(df: DataFrame) -> DataFrame:
    """Amounts and shares in two decimals, counts as bigint."""
    return df.select(
        *(
            cents(col(c)).alias(c) if c in _REPORT_CENTS
            else col(c).cast("bigint").alias(c) if kind in ("int", "bigint") else col(c)
            for c, kind in df.dtypes
        )
    )


def report_kpis(spark, sf):
    return _report(report.report_kpis(_totals(spark, sf)))


def top_keywords(spark, sf):
    return _report(report.top_keywords(_settled_totals(spark, sf)))


def bottom_keywords(spark, sf):
    return _report(report.bottom_keywords(_settled_totals(spark, sf)))


def engine_metrics(spark, sf):
    return _report(report.engine_metrics(_settled_totals(spark, sf)))


def revenue_trend(spark, sf):
    return _report(report.revenue_trend(_history(spark, sf)))


def revenue_trend_incremental(spark, sf):
    """The stored trend after a first half of the days, some days more, and a day written again."""
    path = shared_folder(spark)
    root, store = f"{path}/curated", f"{path}/trend"
    days = settle(_dated_totals(spark, sf))
    day = F.substring("dt", 9, 2).cast("int")
    _write_runs(days.where(day <= 15), root)
    update_trend(spark, root, store)
    _write_runs(days.where(day > 15), root)
    write_curated(days.where(col("dt") == RUN_DATE).drop("dt"), root, RUN_DATE)
    update_trend(spark, root, store)
    return _report(read_trend(spark, store))


def read_history_range(spark, sf):
    path = shared_folder(spark)
    _write_runs(_dated_totals(spark, sf), path)
    return read_history(spark, path, since=RUN_DATE, until="2024-01-20")


def period_change(spark, sf):
    return _report(report.period_change(report.revenue_trend(_history(spark, sf))))


def concentration(spark, sf):
    return _report(report.top5_share(_settled_totals(spark, sf)))


def _report_inputs(spark, sf):
    """Totals and history from one pass over the hits."""
    history = settle(_history(spark, sf))
    return keyword_totals(history), history


def insights(spark, sf):
    return _report(report.insights(*_report_inputs(spark, sf)))


def recommendations(spark, sf):
    return _report(report.recommendations(*_report_inputs(spark, sf)))


def chart_series(spark, sf):
    totals, history = _report_inputs(spark, sf)
    return _report(
        report.chart_series(
            report.top_keywords(totals), report.engine_metrics(totals),
            report.revenue_trend(history),
        )
    )


def report_rows(spark, sf):
    return report.report_rows(*_report_inputs(spark, sf))


def _built(spark, sf) -> DataFrame:
    totals, history = _report_inputs(spark, sf)
    return report.build_report(
        totals, history, RUN_DATE, datetime.fromisoformat(RUN_TIME), ("2024-01-02", "12", "00")
    )


def report_row(spark, sf):
    """The nested row, its lists written out as text."""
    built = _built(spark, sf)
    listed = [f.name for f in built.schema if isinstance(f.dataType, T.ArrayType)]
    return built.select(
        "report_date", "report_timestamp", "data_partition.*", "total_revenue", "total_keywords",
        "total_search_engines", "avg_revenue_per_keyword",
        *(F.size(c).cast("bigint").alias(f"n_{c}") for c in listed),
        col("top_keywords")[0]["keyword"].alias("top_keyword"),
        col("bottom_keywords")[0]["revenue"].alias("bottom_revenue"),
        F.array_join(F.transform("search_engines", lambda e: e["engine"]), ",").alias("engines"),
        F.array_join(F.transform("revenue_trend", lambda d: d["date"]), ",").alias("dates"),
        F.array_join("insights", "|").alias("insights"),
        F.array_join("recommendations", "|").alias("recommendations"),
    )


_JSON_TEXTS = ["report_date", "report_timestamp"]
_JSON_NUMBERS = ["total_revenue", "total_keywords"]


def _json_fields(df: DataFrame) -> DataFrame:
    """What the JSON text says, read back as text; numbers as they stand there, which Spark's JSON
    functions would write anew."""
    return df.select(
        *(F.get_json_object("json", f"$.{c}").alias(c) for c in _JSON_TEXTS),
        *(F.regexp_extract("json", rf'(?m)^  "{c}" : ([^,\s]+),?$', 1).alias(c) for c in _JSON_NUMBERS),
        F.get_json_object("json", "$.data_partition.minute_bucket").alias("minute_bucket"),
        F.get_json_object("json", "$.top_keywords[0].keyword").alias("top_keyword"),
        F.get_json_object("json", "$.search_engines[0].engine").alias("top_engine"),
    )


def report_json(spark, sf):
    return _json_fields(report.report_json(_built(spark, sf)))


def write_report_json(spark, sf):
    path = report.write_report_json(_built(spark, sf), shared_folder(spark), RUN_DATE)
    return _json_fields(spark.read.text(path, wholetext=True).withColumnRenamed("value", "json"))


# Tables.


def _insight_rows(spark, sf) -> DataFrame:
    """Insights as one row per sale, hence many per engine and keyword."""
    return _as_insights(_sales(spark, sf))


def _as_insights(sales: DataFrame) -> DataFrame:
    return sales.select(
        col("event_id").alias("keyword_id"),
        col("engine_domain").alias("search_engine_domain"),
        col("keyword").alias("search_keyword"),
        col("revenue").alias("revenue_impact_score"),
        F.timestamp_seconds("hit_ts").alias("last_processed_at"),
    )


def _shown_insights(df):
    return df.select(
        "keyword_id", "search_engine_domain", "search_keyword",
        F.round("revenue_impact_score", 2).alias("revenue_impact_score"),
        F.unix_seconds("last_processed_at").alias("processed_seconds"),
    )


def insight_dedupe(spark, sf):
    return _shown_insights(dedupe_insights(_insight_rows(spark, sf)))


def insight_upsert(spark, sf):
    sales = settle(_sales(spark, sf))
    known = _as_insights(sales).where(col("search_engine_domain") != "google.com")
    now = F.lit(RUN_TIME).cast("timestamp")
    return _shown_insights(upsert_insights(known, keyword_totals(sales), now))


def sync_insights_query(spark, sf):
    """Twice: what the sales of even hours say, then all of them; read back."""
    path = shared_folder(spark)
    sales = settle(_sales(spark, sf))
    first = sales.where(F.floor(col("hit_ts") / 3600) % 2 == 0)
    for totals, hour in ((keyword_totals(first), 9), (keyword_totals(sales), 12)):
        sync_insights(totals, path, datetime(2024, 1, 2, hour, tzinfo=timezone.utc))
    return _shown_insights(read_insights(spark, path))


def sync_facts_query(spark, sf):
    """Every day once, and one of them again with the totals of all days; read back."""
    path = shared_folder(spark)
    days = settle(_dated_totals(spark, sf))
    for row in days.select("dt").distinct().collect():
        sync_facts(days.where(col("dt") == row["dt"]), path, row["dt"])
    sync_facts(keyword_totals(days), path, RUN_DATE)
    return _shown_facts(read_facts(spark, path))


def run_batch_query(spark, sf):
    """The whole job over a landing, run twice, the second time with the landing kept; the curated
    result read back."""
    path = shared_folder(spark)
    _landed(raw_hits(spark, sf), f"{path}/landing", "parquet")
    for persist in (False, True):
        curated = run_batch(
            spark, f"{path}/landing", f"{path}/curated", staging=f"{path}/staging",
            tables=f"{path}/tables", run_date=RUN_DATE, interval=STAGING_INTERVAL, tie=TIE,
            now=datetime(2024, 1, 2, 12, tzinfo=timezone.utc), persist=persist,
        )
    insights = read_insights(spark, f"{path}/tables").agg(F.count(F.lit(1)).alias("n")).scalar()
    staged = read_staging(spark, f"{path}/staging").agg(F.count(F.lit(1)).alias("n")).scalar()
    return spark.read.parquet(curated).select(
        "*", insights.alias("insights"), staged.alias("staged")
    )


def _facts(spark, sf):
    return _as_facts(_dated_totals(spark, sf))


def _as_facts(days: DataFrame) -> DataFrame:
    return days.select(
        col("dt").cast("date").alias("event_date"),
        col("engine_domain").alias("search_engine_domain"),
        col("keyword").alias("search_keyword"),
        col("revenue").cast("decimal(18,2)").alias("total_revenue"),
    )


def fact_replace(spark, sf):
    days = settle(_dated_totals(spark, sf))
    new = to_facts(keyword_totals(days), RUN_DATE)
    return _shown_facts(replace_date(_as_facts(days), new, RUN_DATE))


def _shown_facts(facts: DataFrame) -> DataFrame:
    return facts.select(
        col("event_date").cast("string").alias("event_date"), "search_engine_domain",
        "search_keyword", col("total_revenue").cast("double").alias("total_revenue"),
    )


def check_sinks_query(spark, sf):
    now = F.lit(RUN_TIME).cast("timestamp")
    sales = settle(_sales(spark, sf))
    days = keyword_totals(with_time_partition(sales), by=["dt"])
    return check_sinks(_as_facts(days), _as_insights(sales), RUN_DATE, now)


# SQL texts over the library's functions and views.

_SQL_REVENUE = """
WITH visits AS (
  SELECT event_id, hit_ts, event_list, product_list, visitor_id(ip, user_agent) AS visitor,
    parse_search_referrer(referrer) AS touch
  FROM hits WHERE has_ip(ip)),
led AS (
  SELECT *, last_value(touch) IGNORE NULLS OVER (PARTITION BY visitor ORDER BY hit_ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS source
  FROM visits),
sold AS (
  SELECT source.engine_domain AS engine_domain, source.keyword AS keyword, product_revenue(product_list) AS revenue
  FROM led WHERE source IS NOT NULL AND is_purchase(event_list))
SELECT engine_domain, keyword, cents(sum(money(revenue))) AS revenue
FROM sold WHERE revenue > 0 GROUP BY engine_domain, keyword
"""

_SQL_COLUMNS = """
SELECT event_id, url_host(referrer) AS host, nullif(search_engine(url_host(referrer)), '') AS engine,
  parse_search_referrer(referrer).keyword AS keyword, visitor_id(ip, user_agent) AS visitor,
  mask_ip(ip) AS ip, mask_user_agent(user_agent) AS user_agent,
  mask_location(geo_city, geo_region, geo_country).geo_country AS geo_country,
  cents(money(product_revenue(product_list))) AS revenue, is_purchase(event_list) AS purchase,
  hit_seconds(hit_time_gmt) AS hit_ts, day_label(event_time(hit_ts)) AS dt,
  hour_label(event_time(hit_ts)) AS hour, minute_bucket(event_time(hit_ts), 7) AS minute
FROM hits
"""

_SQL_TABLES = """
SELECT t.engine_domain, count(*) AS keywords, cents(sum(t.revenue)) AS revenue,
  count(i.keyword_id) AS insights, count(f.search_keyword) AS facts,
  cents(sum(f.total_revenue)) AS fact_revenue
FROM totals t
LEFT JOIN insights i ON i.search_engine_domain = t.engine_domain AND i.search_keyword = t.keyword
LEFT JOIN facts f ON f.search_engine_domain = t.engine_domain AND f.search_keyword = t.keyword
GROUP BY t.engine_domain
"""


def sql_surface(spark, sf):
    """Last-touch revenue as one SQL text."""
    catalog.register(spark, event_hits(spark, sf), tie=TIE)
    return spark.sql(_SQL_REVENUE)


def sql_functions(spark, sf):
    catalog.register(spark, event_hits(spark, sf), tie=TIE)
    return spark.sql(_SQL_COLUMNS)


def sql_tables(spark, sf):
    """The stored tables beside the totals they were filled from."""
    path = shared_folder(spark)
    totals = settle(_totals(spark, sf))
    sync_facts(totals, path, RUN_DATE)
    sync_insights(totals, path, datetime(2024, 1, 2, 12, tzinfo=timezone.utc))
    catalog.register(spark, event_hits(spark, sf), tables=path, tie=TIE)
    return spark.sql(_SQL_TABLES)


# Sinks.


def object_partition(spark, sf):
    hits, totals = _file_totals(spark, sf)
    return _cents(with_object_partition(totals, hits), "revenue")


def _file_totals(spark, sf):
    """Hits of one scan, cut to what is needed, and their totals per file."""
    needed = [SOURCE_FILE, "event_id", "hit_ts", *TEXT_COLUMNS]
    hits = settle(_filed_hits(spark, sf).select(*needed))
    sales = attributed_purchases(hits, tie=TIE, scope="file")
    return hits, keyword_totals(sales, by=[SOURCE_FILE])


def write_curated_query(spark, sf):
    path = write_curated(_totals(spark, sf), shared_folder(spark), RUN_DATE, files=3)
    return spark.read.parquet(path)


def write_staging_query(spark, sf):
    path = shared_folder(spark)
    write_staging(event_hits(spark, sf), path, STAGING_INTERVAL)
    return read_staging(spark, path).select(
        "event_id", "hit_ts", "ip", "user_agent", "geo_city", "dt", "hour", "minute"
    )


def write_tab_query(spark, sf):
    path = write_tab(_totals(spark, sf), shared_folder(spark), RUN_DATE)
    return spark.read.option("header", "true").option("sep", "\t").csv(path)


def write_object_curated_query(spark, sf):
    path = shared_folder(spark)
    hits, totals = _file_totals(spark, sf)
    for _ in range(2):  # again: the objects' folders are replaced
        write_object_curated(totals, hits, path, RUN_DATE)
    return spark.read.parquet(path)


def late_rows(spark, sf):
    """Hits landed under the wrong hour, staged by their own time."""
    path = shared_folder(spark)
    _landed(raw_hits(spark, sf), f"{path}/landing/dt=2030-01-01/hour=00", "parquet")
    write_staging(read_hits(spark, f"{path}/landing"), f"{path}/staging", STAGING_INTERVAL)
    return read_staging(spark, f"{path}/staging").groupBy("dt", "hour", "minute").agg(
        F.count(F.lit(1)).alias("hits")
    )


QUERIES = {
    "keyword_revenue": keyword_revenue_query,
    "keyword_revenue_masked": keyword_revenue_masked,
    "scan_hits_parquet": scan_hits_parquet,
    "scan_hits_tsv": scan_hits_tsv,
    "tsv_to_parquet": tsv_to_parquet,
    "scan_pruned": scan_pruned,
    "scan_mixed": scan_mixed,
    "scan_mixed_names": scan_mixed_names,
    "scan_schemas": scan_schemas,
    "scan_staged": scan_staged,
    "staging_reruns": staging_reruns,
    "stream_same_names": stream_same_names,
    "read_curated": read_curated_query,
    "read_history": read_history_query,
    "stream_ingest": stream_ingest,
    "norm_columns": norm_columns,
    "norm_types": norm_types,
    "hit_ts": hit_ts,
    "curated_projection": curated_projection,
    "purchase_hits": purchase_hits,
    "attributed_purchases": attributed_purchases_query,
    "check_output": check_output,
    "time_partitions": time_partitions,
    "minute_bucket_15": minute_bucket_15,
    "minute_bucket_7": minute_bucket_7,
    "valid_buckets": valid_buckets,
    "partition_prefix": partition_prefix,
    "earliest_partition": earliest_partition_query,
    "url_host": url_host,
    "query_params": query_params,
    "engine_class": engine_class,
    "engine_domain": engine_domain,
    "search_keyword": search_keyword,
    "referrer_touch": referrer_touch,
    "visitor_id": visitor_id,
    "mask_ip": mask_ip,
    "mask_user_agent": mask_user_agent,
    "mask_location": mask_location,
    "mask_pii": mask_pii,
    "event_array": event_array,
    "product_lines": product_lines,
    "product_revenue": product_revenue,
    "last_touch": last_touch,
    "last_touch_masked": last_touch_masked,
    "last_touch_hot": last_touch_hot,
    "last_touch_by_file": last_touch_by_file,
    "report_kpis": report_kpis,
    "top_keywords": top_keywords,
    "bottom_keywords": bottom_keywords,
    "engine_metrics": engine_metrics,
    "revenue_trend": revenue_trend,
    "period_change": period_change,
    "concentration": concentration,
    "insights": insights,
    "recommendations": recommendations,
    "chart_series": chart_series,
    "report_row": report_row,
    "report_json": report_json,
    "report_rows": report_rows,
    "write_report_json": write_report_json,
    "sync_insights": sync_insights_query,
    "sync_facts": sync_facts_query,
    "run_batch": run_batch_query,
    "insight_dedupe": insight_dedupe,
    "insight_upsert": insight_upsert,
    "fact_replace": fact_replace,
    "check_sinks": check_sinks_query,
    "object_partition": object_partition,
    "write_curated": write_curated_query,
    "write_staging": write_staging_query,
    "write_tab": write_tab_query,
    "write_object_curated": write_object_curated_query,
    "late_rows": late_rows,
    "revenue_trend_incremental": revenue_trend_incremental,
    "read_history_range": read_history_range,
    "staging_compacted": staging_compacted,
    "scan_tsv_line_breaks": scan_tsv_line_breaks,
    "sql_surface": sql_surface,
    "sql_functions": sql_functions,
    "sql_tables": sql_tables,
}


def tuned(query):
    """The query under the session settings the labels depend on."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run
