"""The log of written objects: bounded look-ups, the newest entry, and writes that failed."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from touchline.operators.attribution import SOURCE_FILE
from touchline.sinks import files
from touchline.sinks.object_log import SNAPSHOT_EVERY, add_entry, compact, open_log


def state(log):
    newest = log.rows().groupBy("label").agg(F.max_by(F.struct("folder"), "number")["folder"].alias("f"))
    return {r.label: r.f for r in newest.collect() if r.f is not None}


def entries(spark, rows):
    return spark.createDataFrame(list(rows.items()), "label string, folder string").coalesce(1)


def test_files_of_a_look_up_are_bounded(spark, tmp_path):
    path, want, read = str(tmp_path / "log"), {}, []
    for n in range(35):
        rows = {f"o{n % 7}": f"f{n}", f"p{n}": f"g{n}" if n % 3 else None}
        want |= rows
        log = open_log(spark, path)
        read.append(sum(len(list(Path(f).glob("*.parquet"))) for f in log.folders()))
        compact(add_entry(log, entries(spark, rows)))
    log = open_log(spark, path)
    assert log.snapshot == 30 and log.entries == list(range(31, 36))
    assert max(read) <= SNAPSHOT_EVERY + 4
    assert state(log) == {k: v for k, v in want.items() if v is not None}
    assert {p.name for p in (tmp_path / "log").iterdir()} == {"snapshot=30", *(f"entry={n}" for n in range(31, 36))}


def test_an_unfinished_entry_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    add_entry(open_log(spark, path), entries(spark, {"a": "f"}))
    (tmp_path / "log" / "entry=2").mkdir()
    (tmp_path / "log" / "snapshot=3").mkdir()
    log = open_log(spark, path)
    assert log.entries == [1] and state(log) == {"a": "f"}
    assert state(add_entry(log, entries(spark, {"a": None}))) == {}


def written(root):
    return sorted({str(p.parent.relative_to(root)) for p in Path(root).rglob("*.parquet") if "_objects" not in p.relative_to(root).parts})


def batch(spark, second, revenue=5.0):
    hits = spark.createDataFrame([("/in/a.tsv", second)], f"{SOURCE_FILE} string, hit_ts bigint")
    results = spark.createDataFrame([("/in/a.tsv", "e.com", "k", revenue)] if revenue else [], f"{SOURCE_FILE} string, engine_domain string, keyword string, revenue double")
    return results, hits


def test_a_write_that_failed_leaves_no_second_folder(spark, tmp_path, monkeypatch):
    """The first try writes its data and fails; the second, a day later, has another folder."""
    root = str(tmp_path)
    files.write_object_curated(*batch(spark, 0), root, "2024-01-01")
    with monkeypatch.context() as patched:
        patched.setattr(files, "compact", lambda log: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            files.write_object_curated(*batch(spark, 7200), root, "2024-01-02")
    files.write_object_curated(*batch(spark, 10800), root, "2024-01-03")
    assert len(written(root)) == 1 and "hour=03" in written(root)[0] and "2024-01-03" in written(root)[0]
    files.write_object_curated(*batch(spark, 10800, None), root, "2024-01-04")
    assert written(root) == []


def test_objects_move_over_many_writes(spark, tmp_path):
    root = str(tmp_path)
    for n in range(SNAPSHOT_EVERY + 2):
        files.write_object_curated(*batch(spark, 3600 * (n % 3)), root, "2024-01-01", partitioned=n % 2 == 0)
        assert len(written(root)) == 1
    assert open_log(spark, f"{root}/_objects").snapshot == SNAPSHOT_EVERY
