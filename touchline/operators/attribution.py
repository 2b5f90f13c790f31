"""Which search, if any, led to each hit."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.privacy import mask_ip, mask_user_agent
from touchline.functions.products import has_event, product_revenue
from touchline.functions.text import strip
from touchline.functions.url import is_search_like, with_touch
from touchline.operators.carry import HOT_ROWS, carry_forward, hot_keys

SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW = "source_file", "source_block", "source_row"
DEFAULT_TIES = [SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW]


def has_ip(ip: Column) -> Column:
    return strip(ip) != ""


def visitor_id(ip: Column, user_agent: Column) -> Column:
    return F.concat_ws("|", strip(ip), strip(user_agent))


def is_attributed(touch: Column) -> Column:
    return touch.isNotNull()


def positive_revenue(revenue: Column) -> Column:
    return revenue > 0


def with_visitor(
    hits: DataFrame, identity: str = "raw", keep_empty_ip: bool = False
) -> DataFrame:
    """Add visitor_id and leave out the hits without one.

    Masked identity takes the /24 network and a hash for the visitor; an empty ip has the
    mask of all unreadable ones, so those hits stay in.
    """
    ip, user_agent = F.col("ip"), F.col("user_agent")
    if identity == "masked":
        return hits.withColumn("visitor_id", visitor_id(mask_ip(ip), mask_user_agent(user_agent)))
    if identity != "raw":
        raise ValueError(f"identity must be 'raw' or 'masked', not {identity!r}")
    kept = hits if keep_empty_ip else hits.where(has_ip(ip))
    return kept.withColumn("visitor_id", visitor_id(ip, user_agent))


def _ties(hits: DataFrame, tie: list[str] | None) -> list[str]:
    ties = tie if tie is not None else [c for c in DEFAULT_TIES if c in hits.columns]
    if not ties:
        raise ValueError("hits of one second need a tie-breaker: name its columns in `tie`")
    return list(ties)


def _keys(scope: str) -> list[str]:
    try:
        return {"dataset": ["visitor_id"], "file": [SOURCE_FILE, "visitor_id"]}[scope]
    except KeyError:
        raise ValueError(f"scope must be 'dataset' or 'file', not {scope!r}") from None


def attribute_last_touch(
    hits: DataFrame,
    identity: str = "raw",
    tie: list[str] | None = None,
    scope: str = "dataset",
    match: str = "substring",
    keep_empty_ip: bool = False,
    visitor_partitions: int = 0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All hits, with visitor_id, their own `touch` and the visitor's `last_touch` so far.

    A hit's own touch counts. scope="file" starts every source file afresh.
    """
    keys = _keys(scope)
    visitors = with_visitor(hits, identity, keep_empty_ip)
    return carry_forward(
        with_touch(visitors, match=match),
        keys,
        ["hit_ts", *_ties(hits, tie)],
        value="touch",
        out="last_touch",
        hot=hot_keys(visitors, keys, hot_rows),
        partitions=visitor_partitions,
    )


def attributed_purchases(
    hits: DataFrame,
    identity: str = "raw",
    tie: list[str] | None = None,
    scope: str = "dataset",
    match: str = "substring",
    keep_empty_ip: bool = False,
    visitor_partitions: int = 0,
    hot_rows: int = HOT_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Purchases with revenue and the search they came from.

    Only hits that look like a search or a sale can matter, and of those only a few columns,
    so the rest is dropped before the shuffle. The filter reads landed columns: one on
    `touch` or `revenue` would be pushed down and compute both twice. `keep` names hit
    columns to carry along.
    """
    keys, ties = _keys(scope), _ties(hits, tie)
    visitors = with_visitor(hits, identity, keep_empty_ip)
    carried = list(dict.fromkeys([*keys, "hit_ts", *ties, *(keep or [])]))
    # An empty product list has no revenue, so it needs no test of its own.
    sale = has_event(F.col("event_list"))
    # Revenue first: its array functions end a span of generated code, and one span for the
    # filter and all of the URL steps would be too long for the JVM to compile.
    matter = visitors.where(sale | is_search_like(F.col("referrer")))
    priced = matter.select(
        *carried, "referrer",
        F.when(sale, product_revenue(F.col("product_list"))).alias("revenue"),
    )
    candidates = with_touch(priced, match=match).drop("referrer")
    last = carry_forward(
        candidates, keys, ["hit_ts", *ties], value="touch", out="last_touch",
        hot=hot_keys(visitors, keys, hot_rows), partitions=visitor_partitions,
    )
    return last.where(
        is_attributed(F.col("last_touch")) & positive_revenue(F.col("revenue"))
    ).select(
        *carried,
        F.col("last_touch.engine_domain").alias("engine_domain"),
        F.col("last_touch.keyword").alias("keyword"),
        "revenue",
    )
