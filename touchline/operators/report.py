"""Report frames over keyword revenue (engine_domain, keyword, revenue).

The input can be large (one row per distinct search), so every frame is an aggregate or a
top-n of it. Totals are attached as scalar subqueries: one value, no join.
"""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.fixed_values import (
    CONCERNING_DROP,
    DOMINANT_SHARE,
    EXCELLENT_GROWTH,
    HIGH_CONCENTRATION,
    HIGH_KEYWORD_REVENUE,
    INSIGHT_TEXT,
    LOW_CONCENTRATION,
    MODERATE_REVENUE,
    RECOMMENDATION_TEXT,
    STRONG_REVENUE,
)
from touchline.functions.money import MONEY, cents, mean, money, percent
from touchline.operators.tables import number_sorted
from touchline.session import settle

RULE_ROWS = "pos int, rule string, text string"


def _clean(df: DataFrame) -> DataFrame:
    return df.select(
        F.coalesce("engine_domain", F.lit("")).alias("engine_domain"),
        F.coalesce("keyword", F.lit("")).alias("keyword"),
        F.coalesce(money(F.col("revenue")), _nothing()).alias("revenue"),
    )


def _total(df: DataFrame) -> Column:
    """All revenue, 0 for an empty frame."""
    return df.agg(F.coalesce(F.sum("revenue"), _nothing()).alias("total")).scalar()


def _nothing() -> Column:
    return F.lit(0).cast(MONEY)


def report_kpis(df: DataFrame) -> DataFrame:
    """One row: revenue, rows, distinct engines, revenue per row."""
    rows = F.count(F.lit(1))
    total = F.coalesce(F.sum("revenue"), _nothing())
    return _clean(df).agg(
        total.alias("total_revenue"),
        rows.alias("total_keywords"),
        F.count_distinct("engine_domain").alias("total_search_engines"),
        mean(total, rows).alias("avg_revenue_per_keyword"),
    )


_BEST_FIRST = [F.desc, F.asc, F.asc]
_WORST_FIRST = [F.asc, F.desc, F.desc]
_SORT = ["revenue", "engine_domain", "keyword"]


def _ranked(slice_: DataFrame, df: DataFrame) -> DataFrame:
    """Rank and share for the n rows of a slice; the window sees no more than those."""
    best_first = Window.orderBy(*(by(c) for by, c in zip(_BEST_FIRST, _SORT)))
    return slice_.select(
        F.row_number().over(best_first).alias("rank"),
        "keyword",
        F.col("engine_domain").alias("search_engine"),
        "revenue",
        percent(F.col("revenue"), _total(df)).alias("revenue_percentage"),
    ).orderBy("rank")


def top_keywords(df: DataFrame, n: int = 10) -> DataFrame:
    rows = _clean(df)
    return _ranked(rows.orderBy(*(by(c) for by, c in zip(_BEST_FIRST, _SORT))).limit(n), rows)


def bottom_keywords(df: DataFrame, n: int = 10) -> DataFrame:
    """The last n, shown best first and ranked among themselves."""
    rows = _clean(df)
    return _ranked(rows.orderBy(*(by(c) for by, c in zip(_WORST_FIRST, _SORT))).limit(n), rows)


def engine_metrics(df: DataFrame) -> DataFrame:
    rows = _clean(df)
    return (
        rows.groupBy(F.col("engine_domain").alias("engine"))
        .agg(F.sum("revenue").alias("total_revenue"), F.count(F.lit(1)).alias("keyword_count"))
        .select(
            "engine",
            "total_revenue",
            percent(F.col("total_revenue"), _total(rows)).alias("revenue_percentage"),
            "keyword_count",
            mean(F.col("total_revenue"), F.col("keyword_count")).alias("avg_revenue_per_keyword"),
        )
        .orderBy(F.desc("total_revenue"), "engine")
    )


def revenue_trend(history: DataFrame) -> DataFrame:
    """Per date; the mean is per distinct keyword.

    Rows are first reduced to date, engine and keyword, so that a date with most of the
    rows is no heavier a group than any other.
    """
    day = F.coalesce(F.col("date").cast("string"), F.lit("unknown")).alias("date")
    keyed = history.select(
        day,
        F.coalesce("keyword", F.lit("")).alias("keyword"),
        F.coalesce("engine_domain", F.lit("")).alias("engine_domain"),
        F.coalesce(money(F.col("revenue")), _nothing()).alias("revenue"),
    )
    reduced = keyed.groupBy("date", "keyword", "engine_domain").agg(
        F.sum("revenue").alias("revenue")
    )
    return (
        reduced.groupBy("date")
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.count_distinct("keyword").alias("unique_keywords"),
            F.count_distinct("engine_domain").alias("unique_search_engines"),
        )
        .withColumn(
            "avg_revenue_per_keyword", mean(F.col("total_revenue"), F.col("unique_keywords"))
        )
        .orderBy("date")
    )


def period_change(trend: DataFrame) -> DataFrame:
    """Last date against the one before, in percent; no row without a comparable date."""
    latest = trend.orderBy(F.desc("date")).limit(2)
    return (
        latest.agg(
            F.max("date").alias("date"),
            F.max_by("total_revenue", "date").alias("total_revenue"),
            F.min_by("total_revenue", "date").alias("previous_revenue"),
            F.count(F.lit(1)).alias("_dates"),
        )
        .where((F.col("_dates") == 2) & (F.col("previous_revenue") > 0))
        .select(
            "date", "total_revenue", "previous_revenue",
            percent(F.col("total_revenue") - F.col("previous_revenue"), F.col("previous_revenue"))
            .alias("change_percentage"),
        )
    )


def top5_share(df: DataFrame) -> DataFrame:
    """Share of the five best keywords; no row if there are fewer."""
    return (
        top_keywords(df, 5)
        .agg(F.sum("revenue").alias("top5_revenue"), F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") == 5)
        .select("top5_revenue", percent(F.col("top5_revenue"), _total(_clean(df)))
                .alias("top5_percentage"))
    )


# What grouping_id() says of each grouping set of _metrics.
_OF_ROW, _OF_ENGINE, _OF_ALL = 0, 3, 7


def _metrics(df: DataFrame, history: DataFrame | None) -> DataFrame:
    """One row with all the insight rules look at; reads df once.

    Rows, sums by engine and the sum of all come from one aggregate with grouping sets. Of each the
    best five are kept, first in every task and then of all; one more aggregate puts them in a row.
    `engines` is 0, 1, or 2 for any more.
    """
    rows = _clean(df).withColumn("_row", F.monotonically_increasing_id())
    keys = ["engine_domain", "keyword", "_row"]
    sets = rows.groupingSets([keys, keys[:1], []], *keys).agg(
        F.grouping_id().alias("_level"), F.sum("revenue").alias("revenue"),
        F.min(F.col("engine_domain")).alias("_first"), F.max(F.col("engine_domain")).alias("_last"),
    )
    best = Window.partitionBy("_level").orderBy(*(by(c) for by, c in zip(_BEST_FIRST, _SORT)))
    ranked = sets.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= 5)

    def of(level: int, value: Column, places: int = 1) -> Column:
        return F.when((F.col("_level") == level) & (F.col("_place") <= places), value)

    revenue = F.col("revenue")
    top = F.struct("keyword", F.col("engine_domain").alias("search_engine"), "revenue")
    engine = F.struct(F.col("engine_domain").alias("engine"), revenue.alias("total_revenue"))
    engines = F.when(F.col("_first") == F.col("_last"), 1).otherwise(2)
    one = ranked.agg(
        F.coalesce(F.max(of(_OF_ALL, revenue)), _nothing()).alias("total_revenue"),
        F.coalesce(F.max(of(_OF_ALL, engines)), F.lit(0)).alias("engines"),
        F.max(of(_OF_ROW, top)).alias("top"),
        F.max(of(_OF_ENGINE, engine)).alias("engine"),
        F.sum(of(_OF_ROW, revenue, 5)).alias("_five"),
        F.count(of(_OF_ROW, revenue, 5)).alias("_rows"),
    )
    change = F.lit(None).cast(f"struct<total_revenue:{MONEY},previous_revenue:{MONEY}>")
    if history is not None:
        change = period_change(revenue_trend(history)).select(
            F.struct("total_revenue", "previous_revenue")
        ).scalar()
    return one.select(
        "total_revenue", "engines", "top", "engine", change.alias("change"),
        F.when(F.col("_rows") == 5, F.col("_five")).alias("top5"),
    )


def _above(part: Column, whole: Column, limit: float) -> Column:
    """Whether part is more than `limit` percent of whole, exactly."""
    return part * 100 > whole * F.lit(limit).cast("decimal(5,2)")


def _in_percent(part: Column, whole: Column) -> Column:
    """For texts, which round it themselves."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double") * 100).otherwise(F.lit(0.0))


def _money_or_share(c: Column, digits: int) -> Column:
    """Rounded half to even, as the texts expect; formatting alone rounds half up."""
    return F.bround(c, digits).cast("double")


def _insight_rules() -> list[Column]:
    """One (rule, text) or null per rule group, in output order."""
    total, top, engine = F.col("total_revenue"), F.col("top"), F.col("engine")
    top5, before = F.col("top5"), F.col("change.previous_revenue")
    moved_by = F.col("change.total_revenue") - before

    def say(rule, *values):
        text = F.format_string(INSIGHT_TEXT[rule], *values) if values else F.lit(INSIGHT_TEXT[rule])
        return F.struct(F.lit(rule).alias("rule"), text.alias("text"))

    money = _money_or_share(total, 2)
    moved = _money_or_share(F.abs(_in_percent(moved_by, before)), 1)
    of_engine = _in_percent(engine["total_revenue"], total)
    return [
        F.when(total > STRONG_REVENUE, say("rev_strong", money))
        .when(total > MODERATE_REVENUE, say("rev_moderate", money))
        .otherwise(say("rev_low", money)),
        F.when(
            top["revenue"] > HIGH_KEYWORD_REVENUE,
            say("top_keyword", top["keyword"], top["search_engine"],
                _money_or_share(top["revenue"], 2), _money_or_share(_in_percent(top["revenue"], total), 1)),
        ),
        F.when(
            _above(engine["total_revenue"], total, DOMINANT_SHARE),
            say("dominance", engine["engine"], _money_or_share(of_engine, 1)),
        ).when(F.col("engines") == 1, say("single_engine", engine["engine"])),
        F.when(_above(moved_by, before, EXCELLENT_GROWTH), say("growth_excellent", moved))
        .when(_above(-moved_by, before, CONCERNING_DROP), say("drop_concerning", moved))
        .when(moved_by > 0, say("growth", moved))
        .when(moved_by.isNotNull(), say("decline", moved)),
        F.when(_above(top5, total, HIGH_CONCENTRATION), say("concentration_high"))
        .when(_above(-top5, -total, LOW_CONCENTRATION), say("diversity_good")),
    ]


def _as_rows(metrics: DataFrame, rules: Column) -> DataFrame:
    found = metrics.select(F.posexplode(rules).alias("pos", "found"))
    return found.select(
        (F.col("pos") + 1).alias("pos"), F.col("found.rule").alias("rule"),
        F.col("found.text").alias("text"),
    )


def _present(rules: list[Column]) -> Column:
    return F.filter(F.array(*rules), lambda rule: rule.isNotNull())


def insights(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Rows (pos, rule, text) of the rules that apply."""
    return _as_rows(_metrics(df, history), _present(_insight_rules()))


def _recommendation_rules() -> list[Column]:
    total, engine, before = F.col("total_revenue"), F.col("engine"), F.col("change.previous_revenue")
    moved_by = F.col("change.total_revenue") - before
    dominant = _above(engine["total_revenue"], total, DOMINANT_SHARE)
    applies = {
        "rev_low": total <= MODERATE_REVENUE,
        "one_engine": F.col("engines") == 1,
        "dominance": (F.col("engines") > 1) & dominant,
        "drop_concerning": _above(-moved_by, before, CONCERNING_DROP),
        "growth_excellent": _above(moved_by, before, EXCELLENT_GROWTH),
        "concentration_high": _above(F.col("top5"), total, HIGH_CONCENTRATION),
    }
    return [
        F.when(
            applies[rule],
            F.struct(
                F.lit(rule).alias("rule"),
                (F.format_string(text, engine["engine"]) if "%s" in text else F.lit(text))
                .alias("text"),
            ),
        )
        for rule, texts in RECOMMENDATION_TEXT.items()
        for text in texts
    ]


def recommendations(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Rows (pos, rule, text), driven by the conditions, never by the wording of insights."""
    return _as_rows(_metrics(df, history), _present(_recommendation_rules()))


def chart_series(
    keywords: DataFrame, engines: DataFrame, trend: DataFrame,
    top: int | None = None, dates: int | None = None, label_chars: int | None = None,
) -> DataFrame:
    """Long frame (series, pos, label, full_label, value) of what the report charts show.

    Everything by default; a caller may ask for the `top` keywords, the newest `dates`, or
    labels of so many characters. Positions are numbered without a task that sees all rows.
    """
    shown = keywords if top is None else keywords.where(F.col("rank") <= top)
    label = F.col("keyword") if label_chars is None else F.substring("keyword", 1, label_chars)
    shown = shown.select(
        F.lit("keywords").alias("series"),
        F.col("rank").cast("bigint").alias("pos"),
        label.alias("label"),
        F.concat("keyword", F.lit(" ("), "search_engine", F.lit(")")).alias("full_label"),
        cents(F.col("revenue")).alias("value"),
    )
    by_revenue = [F.desc("total_revenue"), F.col("engine")]
    by_engine = number_sorted(engines, by_revenue, "pos").select(
        F.lit("engines").alias("series"), "pos", F.col("engine").alias("label"),
        F.col("engine").alias("full_label"), cents(F.col("total_revenue")).alias("value"),
    )
    newest = trend if dates is None else trend.orderBy(F.desc("date")).limit(dates)
    by_date = number_sorted(newest, [F.col("date")], "pos").select(
        F.lit("trend").alias("series"), "pos", F.col("date").alias("label"),
        F.col("date").alias("full_label"), cents(F.col("total_revenue")).alias("value"),
    )
    return reduce(DataFrame.unionByName, [shown, by_engine, by_date])


_NAMES = ["date", "keyword", "search_engine", "engine", "rule", "text"]
_AMOUNTS = ["revenue", "revenue_percentage", "total_revenue", "avg_revenue_per_keyword"]
_COUNTS = ["total_keywords", "total_search_engines", "keyword_count", "unique_keywords",
           "unique_search_engines"]


def report_rows(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The whole report as rows (section, pos, names and values); null where a section has none.

    Amounts are rounded to cents. However many engines and dates there are, no task holds them all.
    """
    engines = number_sorted(engine_metrics(df), [F.desc("total_revenue"), F.col("engine")], "pos")
    sections = {
        "kpis": report_kpis(df).withColumn("pos", F.lit(1)),
        "top_keywords": top_keywords(df).withColumn("pos", F.col("rank")),
        "bottom_keywords": bottom_keywords(df).withColumn("pos", F.col("rank")),
        "search_engines": engines,
        "insights": insights(df, history),
        "recommendations": recommendations(df, history),
    }
    if history is not None:
        sections["revenue_trend"] = number_sorted(revenue_trend(history), [F.col("date")], "pos")

    def shaped(name: str, frame: DataFrame) -> DataFrame:
        def column(c: str, kind: str) -> Column:
            if c not in frame.columns:
                return F.lit(None).cast(kind).alias(c)
            return (cents(F.col(c)) if kind == "double" else F.col(c).cast(kind)).alias(c)

        return frame.select(
            F.lit(name).alias("section"), F.col("pos").cast("bigint").alias("pos"),
            *(column(c, "string") for c in _NAMES), *(column(c, "double") for c in _AMOUNTS),
            *(column(c, "bigint") for c in _COUNTS),
        )

    return reduce(DataFrame.unionByName, [shaped(n, f) for n, f in sections.items()])


def build_report(
    df: DataFrame, history: DataFrame | None = None, run_date: str | None = None,
    now: datetime | None = None, partition: tuple[str, str, str] | None = None,
) -> DataFrame:
    """The whole report as one nested row, put together from `report_rows`.

    That row holds an entry per engine and per date by definition; report_rows does not need it.
    `now` and `partition` (dt, hour, minute bucket) are what the row says about its run.
    """
    with_trend = history is not None
    rows = settle(report_rows(settle(df), settle(history) if with_trend else None))
    ranked = ["keyword", "search_engine", "revenue", "revenue_percentage"]
    of_engine = ["engine", "total_revenue", "revenue_percentage", "keyword_count",
                 "avg_revenue_per_keyword"]
    of_date = ["date", "total_revenue", "unique_keywords", "unique_search_engines",
               "avg_revenue_per_keyword"]

    def listed(section: str, entry: Column) -> Column:
        found = F.collect_list(F.when(F.col("section") == section, F.struct("pos", entry.alias("e"))))
        return F.transform(F.array_sort(found), lambda item: item["e"]).alias(section)

    def single(name: str) -> Column:
        return F.first(F.when(F.col("section") == "kpis", F.col(name)), ignorenulls=True).alias(name)

    rank = F.col("pos").cast("int").alias("rank")
    moment = F.lit(now.isoformat()) if now else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    )
    place = F.lit(None).cast("struct<dt:string,hour:string,minute_bucket:string>")
    if partition:
        place = F.struct(*(F.lit(v).alias(n) for n, v in zip(("dt", "hour", "minute_bucket"), partition)))
    today = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    report = rows.agg(
        *(single(c) for c in ("total_revenue", "total_keywords", "total_search_engines",
                              "avg_revenue_per_keyword")),
        *(listed(s, F.struct(*ranked, rank)) for s in ("top_keywords", "bottom_keywords")),
        listed("search_engines", F.struct(*of_engine)),
        listed("revenue_trend", F.struct(*of_date)),
        listed("insights", F.col("text")),
        listed("recommendations", F.col("text")),
    )
    return report.select(
        (F.lit(run_date) if run_date else today).alias("report_date"),
        moment.alias("report_timestamp"), place.alias("data_partition"), "*",
    )


_CENTS = "decimal(38,2)"
# A field of the pretty text whose number ends in a spare 0. Line breaks within texts are escaped, so
# no text looks like that.
_SPARE_ZERO = r'(?m)^(\s*"\w+" : -?\d+\.\d)0(,?)$'


def report_json(report: DataFrame) -> DataFrame:
    """The report as text, null fields kept.

    Its amounts, all of two decimals, stand in plain digits whatever their size; as doubles they
    would have an exponent from ten millions on.
    """
    options = {"ignoreNullFields": "false", "pretty": "true"}
    plain = (F.col(c).cast(kind.replace("double", _CENTS)).alias(c) for c, kind in report.dtypes)
    text = F.regexp_replace(F.to_json(F.struct(*plain), options), _SPARE_ZERO, "$1$2")
    return report.select("report_date", text.alias("json"))


def write_report_json(report: DataFrame, root: str, run_date: str) -> str:
    path = f"{root.rstrip('/')}/bi-reports/{run_date}"
    report_json(report).select("json").write.mode("overwrite").text(path)
    return path
