"""Reading landed hits."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.clock import resolve_interval, valid_minute_buckets
from touchline.functions.text import strip, text_or_empty
from touchline.operators.attribution import SOURCE_BLOCK, SOURCE_FILE, SOURCE_ROW
from touchline.operators.normalize import normalize_columns, normalize_hits, require_hit_columns
from touchline.sources.discovery import PARQUET, TEXT, by_header, by_types, look_at
from touchline.sources.folders import files_below

FORMATS = ("parquet", "tsv", "auto")
_PROVENANCE = (SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW)


def scan_path(base: str, dt=None, hour=None, minute=None, interval=None) -> str:
    """The folder of one partition, so that only its files are listed.

    An hour needs a day and a minute needs an hour; without it they are left out.
    """
    path = base.rstrip("/")
    parts = [str(v).strip() if v is not None else "" for v in (dt, hour, minute)]
    if parts[2] and parts[0] and parts[1]:
        label, allowed = parts[2].zfill(2), valid_minute_buckets(interval)
        if label not in allowed:
            raise ValueError(f"minute must be one of {allowed}, not {label!r}")
    for name, value, width in zip(("dt", "hour", "minute"), parts, (0, 2, 2)):
        if not value:
            break
        path += f"/{name}={value.zfill(width)}"
    return path


def _placed(df: DataFrame, place: dict) -> DataFrame:
    """Add where each row came from; rows that bring it along, as staged ones do, keep theirs."""
    own = {c.lower(): c for c in df.columns}
    others = [c for c in df.columns if c.lower() not in _PROVENANCE]
    return df.select(
        *others,
        *(
            (F.coalesce(F.col(own[name]), value) if name in own else value).alias(name)
            for name, value in place.items()
        ),
        *(own[name] for name in own if name in _PROVENANCE and name not in place),
    )


def _one_schema(spark: SparkSession, *paths: str, glob: str = "*") -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    return _placed(
        reader.option("pathGlobFilter", glob).parquet(*paths),
        {SOURCE_FILE: F.col("_metadata.file_path"), SOURCE_ROW: F.col("_metadata.row_index")},
    )


def parquet_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of the Parquet files below the paths, with the place each row came from.

    Files may lack columns or store them as other types; what differs in type becomes text.
    """
    try:
        return normalize_columns(_one_schema(spark, *paths, glob="*.parquet"))
    except Exception as error:  # the reader raises it in more than one class
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    files = [f for p in paths for f in files_below(spark, p) if f.lower().endswith(".parquet")]
    groups = by_types(look_at(spark, files))
    return _unite([normalize_columns(_one_schema(spark, *members)) for members in groups])


# A line whose quoted cells all end on it. A cell is quoted if a quote is its first character.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^\t]*+|[^"\t][^\t]*+|)'
_CLOSED = rf"^{_CELL}(?:\t{_CELL})*+$"


def with_open_cells(lines: DataFrame) -> DataFrame:
    """Of files read as text, those with a line on which a quoted cell doesn't end; `file` each.

    An aggregate over splits of the files. A record that goes over several lines begins with such
    a line, so other files have none.
    """
    quoted = lines.where(F.col("value").contains('"') & ~F.col("value").rlike(_CLOSED))
    return quoted.select(F.col("_metadata.file_path").alias("file")).distinct()


def _tsv_reader(spark: SparkSession, multiline: bool, recursive: bool, glob: str | None):
    reader = (
        spark.read.option("header", "true").option("sep", "\t").option("quote", '"')
        .option("escape", '"').option("enforceSchema", "false")
        .option("multiLine", str(multiline).lower())
        .option("recursiveFileLookup", str(recursive).lower())
    )
    return reader.option("pathGlobFilter", glob) if glob else reader


def tsv_rows(
    spark: SparkSession, *paths: str, recursive: bool = True, multiline: bool | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Rows of tab-separated files, all text, columns named by their header.

    A file with other columns than the first fails the read rather than shifting values. By default
    files are scanned for line breaks within quotes first; only files that may have some are read
    whole by one task each, the others in splits. multiline=False takes every line for a row,
    multiline=True reads every file whole, and neither scans.
    """
    broken: list[str] = []
    if multiline is None:
        lines = spark.read.option("recursiveFileLookup", str(recursive).lower())
        lines = lines.option("pathGlobFilter", glob) if glob else lines
        broken = sorted(r["file"] for r in with_open_cells(lines.text(list(paths))).collect())
    place = {
        SOURCE_FILE: F.col("_metadata.file_path"),
        SOURCE_BLOCK: F.col("_metadata.file_block_start"),
        # Ascending within a block; blocks are ordered by the column before.
        SOURCE_ROW: F.monotonically_increasing_id(),
    }
    whole = _tsv_reader(spark, bool(multiline), recursive, glob).csv(list(paths))
    if not broken:
        return _placed(whole, place)
    # A filter on the file's path prunes files before they are read.
    apart = F.col("_metadata.file_path").isin(broken)
    split = _placed(whole.where(~apart), place)
    joined = _tsv_reader(spark, True, recursive, glob).csv(list(paths)).where(apart)
    return split.unionByName(_placed(joined, place))


def file_rows(
    spark: SparkSession, files: list[str], multiline: bool | None = None
) -> DataFrame:
    """Rows of files that need not agree in format, columns or column types; each is read once."""
    looks = look_at(spark, files)
    frames = [
        _one_schema(spark, *members)
        for members in by_types(look for look in looks if look.kind == PARQUET)
    ]
    for members in by_header(look for look in looks if look.kind == TEXT):
        frames.append(tsv_rows(spark, *members, multiline=multiline))
    return _unite([require_hit_columns(normalize_columns(df)) for df in frames])


def mixed_rows(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Everything below a path, Parquet and tab-separated text side by side."""
    files = files_below(spark, path)
    if not files:
        raise FileNotFoundError(f"no files below {path}")
    return file_rows(spark, files, multiline)


def _unite(frames: list[DataFrame]) -> DataFrame:
    """Rows of frames whose hit columns may differ in type: text unless all agree."""
    types: dict[str, set] = {}
    for df in frames:
        for name, kind in df.dtypes:
            types.setdefault(name, set()).add(kind)
    mixed = {name for name, kinds in types.items() if len(kinds) > 1}
    united = None
    for df in frames:
        df = df.withColumns({c: F.col(c).cast("string") for c in df.columns if c in mixed})
        united = df if united is None else united.unionByName(df, allowMissingColumns=True)
    return united


def read_hits(
    spark: SparkSession, path: str, fmt: str = "parquet", recursive: bool = True,
    dt=None, hour=None, minute=None, interval=None, multiline: bool | None = None,
) -> DataFrame:
    """Landed hits, normalised, from everything below the path or from one partition of it."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, not {fmt!r}")
    interval = resolve_interval(interval, spark)
    where = scan_path(path, dt, hour, minute, interval)
    if fmt == "parquet":
        rows = parquet_rows(spark, where)
    elif fmt == "tsv":
        rows = tsv_rows(spark, where, recursive=recursive, multiline=multiline)
    else:
        rows = mixed_rows(spark, where, multiline=multiline)
    return normalize_hits(rows)


def read_objects(spark: SparkSession, paths: list[str], multiline: bool | None = None) -> DataFrame:
    """Hits of given files, normalised."""
    return normalize_hits(file_rows(spark, paths, multiline))


def convert_tsv_to_parquet(
    spark: SparkSession, src: str, dst: str, mode: str = "error", multiline: bool | None = None
) -> None:
    """Tab-separated hits to landing Parquet: cells trimmed, times as bigint."""
    rows = tsv_rows(spark, src, multiline=multiline)
    columns = [c for c in rows.columns if c not in (SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW)]
    if not columns:
        raise ValueError(f"no header row in {src}")
    if rows.isEmpty():
        raise ValueError(f"no data rows in {src}")
    cells = {c: strip(text_or_empty(F.col(c))) for c in columns}
    if "hit_time_gmt" in cells:
        digits = F.regexp_extract(cells["hit_time_gmt"], r"^([0-9]+)\z", 1)
        cells["hit_time_gmt"] = F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))
    rows.select(*(cell.alias(c) for c, cell in cells.items())).write.mode(mode).parquet(dst)
