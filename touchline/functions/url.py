"""Search-referrer parsing as native expressions.

Spark's parse_url raises on, or gives null for, URLs that appear in real referrers
(blanks, '|', underscores in host names), hence the regular expressions. Each step reads its
input once: Catalyst copies expressions when it pushes a filter down, and inputs read many
times would multiply.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.fixed_values import ENGINE_PARAMS
from touchline.functions.text import WHITESPACE_CLASS, strip

_NAMES = "|".join(ENGINE_PARAMS)
SLOTS = range(max(map(len, ENGINE_PARAMS.values())))

# Authority, without user info and port; brackets are for IPv6 addresses only.
HOST = (
    rf"^{WHITESPACE_CLASS}*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?\[?"
    r"((?<=\[)[0-9A-Fa-f:.]+(?=\])"
    r"|(?<!\[)[^:\[\]/?#@]*(?=(?::[^\[\]/?#@]*)?(?:[/?#]|\z)))"
)
QUERY = r"^[^?#]*\?([^#]*)"

# An engine name in the authority and a filled parameter: all that can be a search. A URL
# with characters that clean_url removes passes too, so that it need not be cleaned first.
SEARCH_LIKE = rf"(?is)^[^/?#]*//[^/?#]*(?:{_NAMES})[^?#]*\?[^#]*=[^&#]|[\t\r\n]"

# The alternatives are tried in order, so the first listed engine wins, wherever it stands.
ENGINE = "(?s)^(?:" + "|".join(f".*?(?={n})" for n in ENGINE_PARAMS) + f")({_NAMES})"

# The last two labels of a host, or all of a one-label host.
DOMAIN = r"([^.]*\.[^.]*|^[^.]*)$"


def clean_url(c: Column) -> Column:
    """Trimmed, and without the tabs and line breaks a URL may not hold."""
    return _unbroken(strip(c))


def _unbroken(c: Column) -> Column:
    for character in "\t\r\n":
        c = F.replace(c, F.lit(character), F.lit(""))
    return c


def is_search_like(url: Column) -> Column:
    """False only for URLs that cannot be a search with a keyword; a cheap first filter."""
    return url.rlike(SEARCH_LIKE)


def _host(cleaned: Column) -> Column:
    return F.lower(F.regexp_extract(cleaned, HOST, 1))


def url_host(url: Column) -> Column:
    """Lower-cased host without user info and port; null if the URL has no authority."""
    return F.nullif(_host(clean_url(url)), F.lit(""))


def url_query(url: Column) -> Column:
    """The query string, '' if there is none."""
    return F.regexp_extract(clean_url(url), QUERY, 1)


def url_unescape(c: Column) -> Column:
    """Percent-decode, '+' to blank; a '%' that starts no escape stays as it is."""
    decoded = F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))
    return F.when(c.contains("%") | c.contains("+"), decoded).otherwise(c)


def query_pairs(url: Column) -> Column:
    """Array of (name, value) in order of appearance, blank values left out."""
    filled = F.filter(F.split(url_query(url), "&"), lambda part: part.rlike("(?s)^[^=]*=."))
    return F.transform(
        filled,
        lambda part: F.struct(
            url_unescape(F.regexp_extract(part, "^([^=]*)=", 1)).alias("name"),
            url_unescape(F.regexp_extract(part, r"(?s)^[^=]*=(.*)\z", 1)).alias("value"),
        ),
    )


def engine_of(host: Column, match: str = "substring") -> Column:
    """The first listed engine whose name occurs anywhere in the host; '' if none does.

    match="label" asks for a whole label of the host instead.
    """
    if match == "substring":
        return F.regexp_extract(host, ENGINE, 1)
    if match == "label":
        names = F.array(*map(F.lit, ENGINE_PARAMS))
        found = F.array_intersect(names, F.split(host, r"\."))
        return F.coalesce(F.get(found, F.lit(0)), F.lit(""))
    raise ValueError(f"match must be 'substring' or 'label', not {match!r}")


def engine_domain(host: Column) -> Column:
    """The last two labels of the host, or all of a one-label host."""
    return F.regexp_extract(host, DOMAIN, 1)


def _letter(c: str) -> str:
    """A letter of a parameter name, plain or percent-encoded."""
    high, low = f"{ord(c):02x}"
    return f"(?:{c}|%{high}[{low}{low.upper()}])" if low.isalpha() else f"(?:{c}|%{high}{low})"


def slot_regex(slot: int) -> str:
    """Over 'engine?query': first filled value of the engine's parameter number `slot`."""
    engines: dict[str, list[str]] = {}
    for name, params in ENGINE_PARAMS.items():
        if slot < len(params):
            engines.setdefault(params[slot], []).append(name)
    choices = (
        rf"(?:{'|'.join(names)})\?(?:|.*?&){''.join(map(_letter, param))}"
        for param, names in engines.items()
    )
    return f"(?s)^(?:{'|'.join(choices)})=([^&]+)"


def _raw_keyword(engine: Column, query: Column, slot: int) -> Column:
    """Value as it stands in the URL, null for engines without that many parameters."""
    engines = [name for name, params in ENGINE_PARAMS.items() if slot < len(params)]
    value = F.regexp_extract(F.concat(engine, F.lit("?"), query), slot_regex(slot), 1)
    return F.when(engine.isin(engines), value)


def _keyword(raw: Column) -> Column:
    return F.lower(strip(url_unescape(raw)))


def search_keyword(engine: Column, query: Column) -> Column:
    """Keyword of a search URL: the first parameter whose first filled value is not blank."""
    words = (_keyword(_raw_keyword(engine, query, slot)) for slot in SLOTS)
    return F.coalesce(*(F.nullif(word, F.lit("")) for word in words))


def with_touch(df: DataFrame, referrer: str = "referrer", match: str = "substring") -> DataFrame:
    """Add `touch`, a struct (engine_domain, keyword), null where the referrer is no search.

    Each step is a column of its own, computed once per row; URLs that cannot be a search
    skip all of them.
    """
    c = F.col
    words = [f"_word_{i}" for i in SLOTS]
    return (
        # Blanks around the URL do no harm below, so only breaks within it are removed.
        df.withColumn("_url", F.when(is_search_like(c(referrer)), _unbroken(c(referrer))))
        .withColumns({"_host": _host(c("_url")), "_query": F.regexp_extract("_url", QUERY, 1)})
        .withColumn("_engine", engine_of(c("_host"), match))
        .withColumns({w: _raw_keyword(c("_engine"), c("_query"), i) for i, w in enumerate(words)})
        .withColumns({w: _keyword(c(w)) for w in words})
        .withColumn("_word", F.coalesce(*(F.nullif(c(w), F.lit("")) for w in words)))
        .withColumn(
            "touch",
            F.when(
                c("_word").isNotNull(),
                F.struct(engine_domain(c("_host")).alias("engine_domain"),
                         c("_word").alias("keyword")),
            ),
        )
        .drop("_url", "_host", "_query", "_engine", "_word", *words)
    )


def parse_search_referrer(referrer: Column, match: str = "substring") -> Column:
    """The same as one expression, for ad-hoc use."""
    host = url_host(referrer)
    keyword = search_keyword(engine_of(host, match), url_query(referrer))
    return F.when(
        is_search_like(referrer) & keyword.isNotNull(),
        F.struct(engine_domain(host).alias("engine_domain"), keyword.alias("keyword")),
    )
