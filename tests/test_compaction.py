"""Merged slices of the staging area."""

from pathlib import Path

import pytest

from touchline.operators.normalize import normalize_hits
from touchline.sinks import compaction
from touchline.sinks.compaction import compact_staging
from touchline.sinks.files import write_staging
from touchline.sources.landing import read_hits
from touchline.sources.layers import read_staging
from touchline.fixed_values import REQUIRED_HIT_COLUMNS

DAY = 1704067200  # 2024-01-01


def hits(spark, rows):
    """rows: (number, second)."""
    cells = [(i, str(DAY + s), f"10.0.0.{i % 250}", *[""] * (len(REQUIRED_HIT_COLUMNS) - 2)) for i, s in rows]
    names = ["n bigint", "hit_time_gmt string", "ip string", *(f"{c} string" for c in REQUIRED_HIT_COLUMNS if c not in ("hit_time_gmt", "ip"))]
    return normalize_hits(spark.createDataFrame(cells, ", ".join(names)).coalesce(1))


def stage(spark, path, k, rows):
    write_staging(hits(spark, rows), path, 60, mask=False, source=f"slice {k}")


def numbers(df):
    return sorted(r["n"] for r in df.select("n").collect())


def files(path):
    return list(Path(path).glob("dt=*/**/*.parquet"))


@pytest.fixture
def staged(spark, tmp_path):
    """Six slices in two hours."""
    path = str(tmp_path / "staging")
    for k in range(6):
        stage(spark, path, k, [(k, 0), (10 + k, 3700)])
    return path


ALL = [*range(6), *range(10, 16)]


def test_merged_slices_are_few_files_with_the_same_rows(spark, staged):
    assert len(files(staged)) == 12 and numbers(read_staging(spark, staged)) == ALL
    columns = read_staging(spark, staged).columns
    assert compact_staging(spark, staged, least=6) == 2
    assert len(files(staged)) == 2
    assert numbers(read_staging(spark, staged)) == ALL and read_staging(spark, staged).columns == columns
    assert numbers(read_hits(spark, staged)) == ALL  # by the files alone
    assert numbers(read_staging(spark, staged, dt="2024-01-01", hour="1")) == list(range(10, 16))
    assert compact_staging(spark, staged, least=6) == 0
    assert compact_staging(spark, staged, dt="2023-01-01", least=1) == 0


def test_a_merged_slice_can_be_staged_again(spark, staged):
    compact_staging(spark, staged, least=2)
    stage(spark, staged, 3, [(33, 0), (34, 7300)])  # leaves the second hour for a third
    want = sorted({*ALL, 33, 34} - {3, 13})
    assert numbers(read_staging(spark, staged)) == want == numbers(read_hits(spark, staged))
    stage(spark, staged, 9, [(99, 0)])
    assert compact_staging(spark, staged, least=2) == 1
    assert numbers(read_staging(spark, staged)) == sorted([*want, 99]) == numbers(read_hits(spark, staged))
    assert len(files(staged)) == 3
    stage(spark, staged, 3, [(35, 0)])
    assert numbers(read_staging(spark, staged)) == sorted({*want, 99, 35} - {33, 34})


def test_a_compaction_that_fails_changes_nothing(spark, staged, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(compaction, "settle", fail)  # the merged files are there, the list is not
        with pytest.raises(RuntimeError):
            compact_staging(spark, staged, least=2)
    assert len(files(staged)) == 14 and numbers(read_staging(spark, staged)) == ALL
    with monkeypatch.context() as patched:
        patched.setattr(compaction, "_remove_given_up", fail)  # the switch is made, old files stay
        with pytest.raises(RuntimeError):
            compact_staging(spark, staged, least=2)
    assert numbers(read_staging(spark, staged)) == ALL
    stage(spark, staged, 5, [(55, 0)])
    assert numbers(read_staging(spark, staged)) == sorted({*ALL, 55} - {5, 15})
    assert compact_staging(spark, staged, least=2) >= 1
    assert numbers(read_staging(spark, staged)) == sorted({*ALL, 55} - {5, 15}) == numbers(read_hits(spark, staged))
    assert len(files(staged)) == 2


def test_all_rows_of_an_hour_may_go(spark, tmp_path):
    path = str(tmp_path / "staging")
    for k in range(2):
        stage(spark, path, k, [(k, 0)])
    compact_staging(spark, path, least=2)
    for k in range(2):
        stage(spark, path, k, [(k + 5, 4000)])
    assert numbers(read_staging(spark, path)) == [5, 6] == numbers(read_hits(spark, path))


def test_slices_are_named_without_reading_rows(spark, staged, monkeypatch):
    """Rows are read once, to be merged; what is moved comes from names."""
    reads = []
    monkeypatch.setattr(compaction, "_folders", lambda *a, f=compaction._folders: reads.append("names") or f(*a))
    monkeypatch.setattr(compaction, "settle", lambda df, f=compaction.settle: reads.append([i for i in df.inputFiles() if "/slice=" in i]) or f(df))
    assert compact_staging(spark, staged, least=2) == 2
    assert [] in reads and not any(isinstance(r, list) and r for r in reads)
    assert numbers(read_staging(spark, staged)) == ALL


def test_hours_without_a_label_stay_as_they_are(spark, staged):
    """A second beyond the year 9999 has no day; its rows are not lost."""
    beyond = 253402300800 - DAY
    for k in range(2):
        stage(spark, staged, k, [(k, 0), (10 + k, 3700), (90 + k, beyond)])
    compact_staging(spark, staged, least=2)
    assert numbers(read_hits(spark, staged)) == [*ALL, 90, 91]
