"""Landed files of any kind and number: how they are looked at, and quoted line breaks."""

import gzip
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from touchline.fixed_values import HIT_COLUMNS
from touchline.sources import discovery, landing
from touchline.sources.discovery import Look, by_header, by_types, look_at
from touchline.sources.folders import files_below
from touchline.sources.landing import convert_tsv_to_parquet, read_hits, read_objects, tsv_rows

HEADER = "\t".join(HIT_COLUMNS)


def row(i, user_agent="UA"):
    cells = {c: "" for c in HIT_COLUMNS} | {"hit_time_gmt": str(100 + i), "ip": f"10.0.0.{i}", "event_list": "1", "product_list": f"a;b;1;{i};"}
    return "\t".join({**cells, "user_agent": user_agent}.values())


def write(path, *rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def parquet(path, i, **other):
    path.parent.mkdir(parents=True, exist_ok=True)
    cells = {c: [""] for c in HIT_COLUMNS} | {"hit_time_gmt": [str(i)], "ip": [f"10.1.0.{i}"]} | other
    pq.write_table(pa.table(cells), path)
    return str(path)


def jobs_of(spark, work):
    """Number of jobs that `work` starts."""
    context = spark.sparkContext
    name = uuid.uuid4().hex
    context.setJobGroup(name, "counted")
    try:
        result = work()
        return len(context.statusTracker().getJobIdsForGroup(name)), result
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def mixed(folder, n):
    for i in range(n):
        if i % 4 == 0:
            parquet(folder / f"p{i}" / "hits.parquet", i)
        elif i % 4 == 1:
            parquet(folder / f"q{i}" / "noext", i, hit_time_gmt=[i])
        elif i % 4 == 2:
            write(folder / f"t{i}" / "hits.tsv", row(i))
        else:
            write(folder / f"u{i}" / "plain", row(i), header="\t".join(reversed(HIT_COLUMNS)))


@pytest.fixture
def listing(spark):
    """Spark lists up to 32 paths by itself and more in a job; here it always takes the job."""
    name = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    yield
    spark.conf.set(name, before)


def test_jobs_do_not_grow_with_the_files(spark, tmp_path, listing):
    found = []
    for n in (20, 200):
        folder = tmp_path / str(n)
        mixed(folder, n)
        jobs, hits = jobs_of(spark, lambda folder=folder: read_hits(spark, str(folder), "auto"))
        assert hits.count() == n
        assert hits.where("hit_ts > 0").select("hit_ts").distinct().count() > n / 3
        found.append(jobs)
    assert found[0] == found[1]


def test_conflicting_types_take_as_many_jobs_for_any_number_of_files(spark, tmp_path, listing):
    found = []
    for n in (6, 60):
        folder = tmp_path / str(n)
        for i in range(n):
            parquet(folder / f"{i}.parquet", i, **({"hit_time_gmt": [i]} if i % 2 else {}))
        jobs, hits = jobs_of(spark, lambda folder=folder: read_hits(spark, str(folder)))
        assert sorted(r.hit_ts for r in hits.select("hit_ts").collect()) == list(range(n))
        found.append(jobs)
    assert found[0] == found[1]


def test_looks(spark, tmp_path):
    with gzip.open(tmp_path / "z.tsv.gz", "wt") as file:
        file.write("\n\na\tb\r\n1\t2\n")
    files = [
        parquet(tmp_path / "named.parquet", 1), parquet(tmp_path / "magic", 1), write(tmp_path / "x y%20z.txt", "v", header="h"),
        write(tmp_path / "parquet.tsv", "v", header="PAR1"), str(tmp_path / "z.tsv.gz"),
    ]
    for names in (files, [f"file:{f}" for f in files], [f"file://{f}" for f in files]):
        looks = look_at(spark, names)
        assert [x.path for x in looks] == names
        assert [x.kind for x in looks] == ["parquet", "parquet", "tsv", "tsv", "tsv"]
        assert [x.stated for x in looks[2:]] == [(("h", ""),), (("PAR1", ""),), (("a\tb", ""),)]
        assert looks[0].stated == looks[1].stated and len(looks[0].stated) == len(HIT_COLUMNS)
    assert look_at(spark, []) == []


def test_files_that_only_spark_can_open(spark, tmp_path, monkeypatch):
    mixed(tmp_path, 8)

    def blind(*_):
        def look(batches):
            import pyarrow as pa

            for b in batches:
                none = pa.nulls(b.num_rows)
                kinds = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
                yield pa.RecordBatch.from_arrays([b.column(0), none.cast(pa.string()), none.cast(kinds)], ["path", "kind", "stated"])

        return look

    monkeypatch.setattr(discovery, "_looker", blind)
    assert read_hits(spark, str(tmp_path), "auto").count() == 8


def test_groups():
    looks = [Look("a", "parquet", (("x", "int"),)), Look("b", "parquet", (("x", "int"), ("y", "int"))), Look("c", "parquet", (("x", "text"),)), Look("d", "parquet", (("y", "text"), ("z", "int")))]
    assert by_types(looks) == [["a", "b"], ["c", "d"]]
    assert by_header([Look("a", "tsv", (("h", ""),)), Look("b", "tsv", (("g", ""),)), Look("c", "tsv", (("h", ""),))]) == [["a", "c"], ["b"]]


def test_files_below_skips_hidden_and_empty_ones(spark, tmp_path):
    want = [write(tmp_path / "a" / "b c.tsv", "v"), write(tmp_path / "d.tsv", "v")]
    for hidden in ("_x/a.tsv", ".y/a.tsv", "_z.tsv", "a/.crc"):
        write(tmp_path / hidden, "v")
    (tmp_path / "empty.tsv").touch()
    assert files_below(spark, str(tmp_path)) == [f"file:{f}" for f in want]
    assert files_below(spark, want[1]) == [f"file:{want[1]}"]
    with pytest.raises(FileNotFoundError):
        files_below(spark, str(tmp_path / "none"))


BROKEN = '"Agent\nof two\tlines, ""quoted"""'


def quoted_landing(folder):
    write(folder / "a.tsv", row(1), row(2, BROKEN), row(3))
    write(folder / "b.tsv", row(4, '"quoted, one line"'), row(5, '6" phone'), row(6))
    write(folder / "c.tsv", row(7))
    return str(folder)


@pytest.mark.parametrize("fmt", ["tsv", "auto"])
def test_quoted_line_breaks_stay_in_their_cell(spark, tmp_path, fmt):
    hits = read_hits(spark, quoted_landing(tmp_path), fmt).orderBy("hit_ts").collect()
    assert [r.hit_ts for r in hits] == [101, 102, 103, 104, 105, 106, 107]
    assert hits[1].user_agent == 'Agent\nof two\tlines, "quoted"' and hits[1].event_list == "1"
    assert hits[4].user_agent == '6" phone'
    hits = read_objects(spark, [str(tmp_path / "a.tsv")]).collect()
    assert len(hits) == 3 and len({r.source_row for r in hits}) == 3


def test_conversion_keeps_quoted_line_breaks(spark, tmp_path):
    convert_tsv_to_parquet(spark, quoted_landing(tmp_path / "in"), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("hit_time_gmt").collect()
    assert [r.hit_time_gmt for r in rows] == list(range(101, 108))
    assert rows[1].user_agent == 'Agent\nof two\tlines, "quoted"' and rows[1].product_list == "a;b;1;2;"


def test_only_files_with_open_cells_are_read_whole(spark, tmp_path):
    folder = quoted_landing(tmp_path)
    lines = spark.read.text(folder)
    assert [r.file for r in landing.with_open_cells(lines).collect()] == [f"file:{tmp_path}/a.tsv"]
    with open(tmp_path / "b.tsv", "a") as file:
        file.write("".join(row(i % 200, '"quoted"') + "\n" for i in range(8, 20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        parts = tsv_rows(spark, folder).groupBy(F.element_at(F.split("source_file", "/"), -1).alias("file")).agg(F.countDistinct("source_block").alias("n"))
        blocks = {r.file: r.n for r in parts.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks["a.tsv"] == 1 and blocks["b.tsv"] > 1


@pytest.mark.parametrize("line,is_open", [
    ('a\tb', False), ('"a"\t"b"', False), ('"a', True), ('x\t"a""', True), ('"a""b"\tc', False), ('"a"b\tc', False), ('6" x\t"open', True),
    ('6" x\ty', False), ('""\t""', False), ('"""', True), ('""""', False), ('a\t"b\tc"', False), ("", False), ('\t\t"', True),
])
def test_open_cells(spark, tmp_path, line, is_open):
    (tmp_path / "f.tsv").write_text(line + "\n")
    assert (landing.with_open_cells(spark.read.text(str(tmp_path))).count() == 1) == is_open
