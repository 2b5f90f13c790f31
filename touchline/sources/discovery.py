"""What landed files are: their kind, and the schema that their header or footer states.

One job looks at all files, a few per task, and returns one row per file. A task reads no more of a
file than its first line or its footer. The few lines that run in Python here are per file, not per
row. A file that tasks can't open by themselves, as in a store that only Spark's readers know, is
looked at by a read of its own.
"""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.folders import first_bytes

#: Files that one task looks at, about.
FILES_PER_TASK = 32
#: Names that tell of text, whatever is in the file.
TEXT_NAME = r"(?i)\.(?:tsv|tab|txt|csv)(?:\.(?:gz|bz2|zst|lz4|snappy|deflate))?\Z"
_LOOKS = 16  # files that are looked at side by side where tasks can't

PARQUET, TEXT = "parquet", "tsv"
LOOKED = "path string, kind string, stated array<struct<name: string, type: string>>"


class Look(NamedTuple):
    """A file's kind, and its columns with their types; of text the header line alone."""

    path: str
    kind: str
    stated: tuple[tuple[str, str], ...]


def _looker(text_name: str, parquet: str, text: str):
    """The function that tasks run; it refers to nothing here, so workers need not have the package."""

    def look(batches):
        import re
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def opened(path):
            if re.match(r"file:|/", path):
                local = re.sub(r"^file:(?://(?=/))?", "", path)
                return fs.LocalFileSystem(), local
            return fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]:", "s3:", path), safe=":/@?=&"))

        def header(store, where):
            with store.open_input_stream(where, compression="detect") as stream:
                seen = b""
                while True:
                    more = stream.read(1 << 16)
                    seen += more
                    lines = re.split(rb"[\r\n]+", seen.lstrip(b"\r\n"), maxsplit=1)
                    if len(lines) > 1 or not more:
                        return lines[0].decode("utf-8", "replace")

        def seen(path):
            try:
                store, where = opened(path)
                kind = parquet if path.lower().endswith(".parquet") else text if re.search(text_name, path) else None
                if kind is None:
                    with store.open_input_file(where) as file:
                        kind = parquet if file.read(4) == b"PAR1" else text
                if kind == text:
                    return kind, [{"name": header(store, where), "type": ""}]
                with store.open_input_file(where) as file:
                    columns = pq.ParquetFile(file).schema
                    stated = [(c.path.lower(), f"{c.physical_type} {c.logical_type}") for c in map(columns.column, range(len(columns)))]
                return kind, [{"name": n, "type": t} for n, t in sorted(stated)]
            except (OSError, ValueError, NotImplementedError):
                return None, None

        kinds = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [seen(p) for p in paths]
            columns = [pa.array(paths), pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["path", "kind", "stated"])

    return look


def is_parquet(spark: SparkSession, path: str) -> bool:
    """By the last extension if it tells, else by the content: Parquet begins with PAR1."""
    import re

    if path.lower().endswith(".parquet"):
        return True
    return not re.search(TEXT_NAME, path) and first_bytes(spark, path, 4) == b"PAR1"


def _look_alone(spark: SparkSession, path: str) -> Look:
    """By Spark's readers, on the driver."""
    if is_parquet(spark, path):
        return Look(path, PARQUET, tuple(sorted((n.lower(), t) for n, t in spark.read.parquet(path).dtypes)))
    names = spark.read.option("header", "true").option("sep", "\t").csv(path).columns
    return Look(path, TEXT, (("\t".join(names), ""),))


def looked(spark: SparkSession, files: list[str]) -> DataFrame:
    """path, kind and stated columns of each file; kind is null where a task can't open it."""
    tasks = max(1, min(-(-len(files) // FILES_PER_TASK), 4 * spark.sparkContext.defaultParallelism))
    paths = spark.createDataFrame([(f,) for f in files], "path string").repartition(tasks)
    return paths.mapInArrow(_looker(TEXT_NAME, PARQUET, TEXT), LOOKED)


def look_at(spark: SparkSession, files: list[str]) -> list[Look]:
    """All files, in the order given."""
    if not files:
        return []
    rows = {r["path"]: r for r in looked(spark, files).collect()}
    closed = [f for f in files if rows[f]["kind"] is None]
    with ThreadPoolExecutor(_LOOKS) as pool:
        alone = dict(zip(closed, pool.map(lambda f: _look_alone(spark, f), closed)))
    return [
        alone[f] if f in alone else Look(f, rows[f]["kind"], tuple((c["name"], c["type"]) for c in rows[f]["stated"]))
        for f in files
    ]


def by_header(looks: Iterable[Look]) -> list[list[str]]:
    """Text files with one header together."""
    groups: dict[tuple, list[str]] = {}
    for look in looks:
        groups.setdefault(look.stated, []).append(look.path)
    return list(groups.values())


def by_types(looks: Iterable[Look]) -> list[list[str]]:
    """Parquet files together whose columns of one name have one type; some may lack columns."""
    schemas: dict[tuple, list[str]] = {}
    for look in looks:
        schemas.setdefault(look.stated, []).append(look.path)
    groups: list[tuple[dict[str, str], list[str]]] = []
    for stated, paths in schemas.items():
        for types, members in groups:
            if all(types.get(name, kind) == kind for name, kind in stated):
                types.update(stated)
                members += paths
                break
        else:
            groups.append((dict(stated), list(paths)))
    return [members for _, members in groups]
