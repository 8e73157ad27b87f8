"""Versions of stored tables: two writers, reading by number and time, removal."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from padron.sources.tables import (
    SnapshotConflict, TableReadError, read_snapshot, snapshot_log, vacuum_snapshots,
    write_snapshot)


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: write_snapshot(spark.range(i, i + 1), path), range(4)))
    assert sorted(numbers) == [1, 2, 3, 4]
    for i, version in enumerate(numbers):
        assert _ids(read_snapshot(spark, path, version=version)) == [i]


def test_a_write_based_on_an_older_version_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_snapshot(spark.range(1), path, based_on=0) == 1
    assert write_snapshot(spark.range(2), path, based_on=1) == 2
    with pytest.raises(SnapshotConflict, match="has version 2, not 1"):
        write_snapshot(spark.range(3), path, based_on=1)
    assert _ids(read_snapshot(spark, path)) == [0, 1]
    # An entry that a writer began and never filled takes its number, and is no version.
    Path(path, "versions", f"{3:020d}.json").write_text("")
    assert _ids(read_snapshot(spark, path)) == [0, 1]
    with pytest.raises(SnapshotConflict):
        write_snapshot(spark.range(3), path, based_on=2)
    assert write_snapshot(spark.range(4), path) == 4


def test_reads_by_number_and_time(spark, tmp_path):
    path = str(tmp_path / "t")
    start = datetime.now(timezone.utc)
    for n in (1, 2, 3):
        write_snapshot(spark.range(n), path)
    times = [r.momento.replace(tzinfo=timezone.utc) if r.momento.tzinfo is None else r.momento
             for r in snapshot_log(spark, path).orderBy("version").collect()]
    assert times == sorted(times)
    assert len(_ids(read_snapshot(spark, path, version=1))) == 1
    assert len(_ids(read_snapshot(spark, path, as_of=datetime.now(timezone.utc)))) == 3
    for kw in ({"version": 9}, {"as_of": start - timedelta(minutes=1)}):
        with pytest.raises(TableReadError, match="no versions as asked"):
            read_snapshot(spark, path, **kw)


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    assert vacuum_snapshots(spark, path) == []
    for n in (1, 2, 3, 4):
        write_snapshot(spark.range(n), path)
    (tmp_path / "t" / "data" / "left-behind").mkdir()
    assert vacuum_snapshots(spark, path, keep=2) == []  # all within the grace time
    assert len(list((tmp_path / "t" / "data").iterdir())) == 5
    with pytest.raises(ValueError):
        vacuum_snapshots(spark, path, keep=0)
    assert vacuum_snapshots(spark, path, keep=2, grace=timedelta(0)) == [1, 2]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert [len(_ids(read_snapshot(spark, path, version=v))) for v in (3, 4)] == [3, 4]
    with pytest.raises(TableReadError):
        read_snapshot(spark, path, version=1)
    assert write_snapshot(spark.range(5), path) == 5
