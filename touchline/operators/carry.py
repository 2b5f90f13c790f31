"""Running last value per key that survives keys of any size.

A window needs all rows of a key in one task. Keys with more than `hot_rows` rows are
therefore cut into slices of the order (hour, second, run of positions); each slice is a
window of its own, and what earlier slices of the key end with is carried in by a join.
The slices of a key are pre-aggregated before they are shuffled, so no task ever sees more
than one slice's rows, one second's runs, one hour's seconds or one key's hours.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import settle

HOT_ROWS = 1_000_000
SKETCHES = 64
SKETCH_ITEMS = 1024
SECONDS_PER_SLICE = 3600
POSITIONS_PER_SLICE = 1 << 20

_HASH, _HOT = "_key_hash", "_key_is_hot"
_HOUR, _SECOND, _RUN = "_hour", "_second", "_run"


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys).alias(_HASH)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of the keys with more than `hot_rows` rows, as far as a sketch tells; runs a job.

    Each task keeps SKETCHES sketches of the most frequent hashes, each over its own share of all
    hashes and of at most SKETCH_ITEMS of them, so what is shuffled doesn't grow with the number of
    keys. A key of more than about 1 / SKETCH_ITEMS of its share's rows is always found; counts may
    be a little too high or low. That is enough: which keys are taken for hot never changes a
    result, only how its rows are spread. Two keys with one hash are merely both taken for hot.
    The result stays a frame, and how it is joined is left to adaptive execution, which knows its
    size. Looking before the plan is built keeps that plan a single window where no key is hot, and
    lets all its parts agree on the hot keys.
    """
    share = F.pmod(F.col(_HASH), F.lit(SKETCHES))
    frequent = F.call_function("approx_top_k", F.col(_HASH), F.lit(SKETCH_ITEMS), F.lit(SKETCH_ITEMS))
    sketched = df.select(_key_hash(keys)).groupBy(share).agg(frequent.alias("_top"))
    counts = sketched.select(F.explode("_top").alias("_top"))
    found = counts.where(F.col("_top.count") > hot_rows)
    return settle(found.select(F.col("_top.item").alias(_HASH), F.lit(True).alias(_HOT)))


def _position_run(df: DataFrame, ties: list[str]) -> Column:
    """Ties with the last one coarsened; contiguous in the order of the ties."""
    *outer, last = ties
    if not isinstance(df.schema[last].dataType, T.IntegralType):
        raise TypeError(f"the last tie-breaker must be an integer position: {last}")
    run = F.floor(F.col(last) / F.lit(POSITIONS_PER_SLICE)).alias("run")
    return F.struct(*outer, run)


def _carried_in(hot: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per slice of the hot keys: the last value of the key before the slice.

    The slices' own last values are written once, as all levels start from them.
    """
    levels = [_HOUR, _SECOND, _RUN]

    def last_of(df, by, source, position):
        at = F.when(F.col(source).isNotNull(), position)
        return df.groupBy(*by).agg(F.max_by(source, at).alias("_last"))

    runs = settle(last_of(hot, keys + levels, value, F.struct(*order)))
    seconds = last_of(runs, keys + levels[:2], "_last", F.col(_RUN))
    hours = last_of(seconds, keys + levels[:1], "_last", F.col(_SECOND))

    carried = None
    for depth, table in enumerate([hours, seconds, runs]):
        parent = keys + levels[:depth]
        before = (
            Window.partitionBy(*parent).orderBy(levels[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        table = table.select(
            *parent, levels[depth],
            F.last("_last", ignorenulls=True).over(before).alias("_carried"),
        )
        if carried is not None:
            outer = carried.withColumnRenamed("_carried", "_outer")
            table = table.join(outer, parent).select(
                *parent, levels[depth], F.coalesce("_carried", "_outer").alias("_carried")
            )
        carried = table
    return carried


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    out: str,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    partitions: int = 0,
) -> DataFrame:
    """Add `out`: the last non-null `value` of the key up to and including the row.

    `order` is a column of seconds followed by tie-breakers, the last an integer position.
    `hot` may name the hot keys, for instance counted on a cheaper projection of the data.
    """
    seconds, *ties = order
    run = _position_run(df, ties) if ties else F.struct(F.lit(0).alias("run"))
    if hot is None:
        hot = hot_keys(df, keys, hot_rows)

    def upto(by):
        return (
            Window.partitionBy(*by).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def spread(rows, by):
        return rows.repartition(partitions, *by) if partitions else rows

    if hot.isEmpty():
        last = F.last(value, ignorenulls=True).over(upto(keys))
        return spread(df, keys).withColumn(out, last)

    marked = df.withColumn(_HASH, _key_hash(keys)).join(hot, _HASH, "left").drop(_HASH)
    # Null on the rows of other keys: one slice per key, and no match in the join below.
    is_hot = F.col(_HOT)
    marked = marked.withColumns(
        {
            _HOUR: F.when(is_hot, F.floor(F.col(seconds) / F.lit(SECONDS_PER_SLICE))),
            _SECOND: F.when(is_hot, F.col(seconds)),
            _RUN: F.when(is_hot, run),
        }
    )
    slices = keys + [_HOUR, _SECOND, _RUN]
    within = spread(marked, slices).withColumn(
        "_within", F.last(value, ignorenulls=True).over(upto(slices))
    )
    before = _carried_in(marked.where(is_hot), keys, order, value)
    return (
        within.join(before, slices, "left")
        .withColumn(out, F.coalesce("_within", "_carried"))
        .select(*df.columns, out)
    )
