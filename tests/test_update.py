from datetime import date

import pytest
from pyspark.sql import functions as F

from padron.operators.history import append_rows, upsert
from padron.plans.update import TABLES, build_table, publish_tables, update_cells, update_files
from padron.sources.tables import (
    TableReadError, read_snapshot, read_table, table_exists, write_snapshot)
from padron.streaming.ingest import start_ingest
from tests.test_sources import write_file

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def _row(state="1", ta=1, sex=1):
    return f"{state}|0|S1|{sex}|{ta}|{ta}|0|0|0|{ta * 10}.00|{ta}"


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "inputs"
    folder.mkdir()
    for month, ta in (("2024-01-31", 10), ("2024-02-29", 20)):
        write_file(folder, f"asg-{month}.csv", [_row("1", ta), _row("", ta, 2)])
    return folder


def _totals(spark, path):
    return {r.date: r.ta for r in build_table("national", read_table(spark, path)).collect()}


def test_update_is_incremental_and_idempotent(spark, inputs, tmp_path):
    cells = str(tmp_path / "cells")
    assert update_cells(spark, str(inputs), cells)
    assert _totals(spark, cells) == {JAN: 20, FEB: 40}
    assert not update_cells(spark, str(inputs), cells)
    # A stored month that changes upstream keeps its stored values; a new one is added.
    write_file(inputs, "asg-2024-01-31.csv", [_row("1", 999)])
    write_file(inputs, "asg-2024-03-31.csv", [_row("5", 7)])
    assert update_cells(spark, str(inputs), cells)
    assert _totals(spark, cells) == {JAN: 20, FEB: 40, MAR: 7}


def test_latest_mode_and_late_months(spark, inputs, tmp_path):
    cells = str(tmp_path / "cells")
    assert update_cells(spark, str(inputs), cells, mode="latest")
    assert set(_totals(spark, cells)) == {FEB}
    assert update_cells(spark, str(inputs), cells)
    assert set(_totals(spark, cells)) == {JAN, FEB}


def test_date_range(spark, inputs, tmp_path):
    cells = str(tmp_path / "cells")
    assert update_cells(spark, str(inputs), cells, date_range=("2024-01-01", "2024-01-31"))
    assert set(_totals(spark, cells)) == {JAN}


def test_empty_folder_is_an_error(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        update_cells(spark, str(tmp_path / "none"), str(tmp_path / "cells"))


def test_two_files_for_a_month_first_wins_each_key(spark, inputs, tmp_path):
    write_file(inputs, "asg-2024-01-15.csv", [_row("1", 3), _row("9", 4)])
    cells = str(tmp_path / "cells")
    update_cells(spark, str(inputs), cells)
    rows = build_table("marginals", read_table(spark, cells)).filter("variable = 'cve_entidad'")
    january = {r.categoria: r.ta for r in rows.collect() if r.date == JAN}
    # The earlier name wins the shared state; each file's own states stay.
    assert january == {"Aguascalientes": 3, "Ciudad de México": 4, "Sin dato (entidad)": 10}


def test_publish_every_table(spark, inputs, tmp_path):
    cells, out = str(tmp_path / "cells"), str(tmp_path / "tables")
    update_cells(spark, str(inputs), cells)
    publish_tables(spark, cells, out)
    publish_tables(spark, cells, out, names=("national",))
    for name in TABLES:
        assert read_snapshot(spark, f"{out}/{name}").count() > 0
    by_sex = read_snapshot(spark, f"{out}/national_by_sex").collect()
    assert sum(r.ta for r in by_sex) == 60


def test_upsert_history_wins_and_nulls_match(spark):
    history = spark.createDataFrame([(JAN, "a", 1), (JAN, None, 2)], "date date, k string, ta int")
    new = spark.createDataFrame(
        [(JAN, "a", 9), (JAN, None, 9), (FEB, "a", 3)], "date date, k string, ta int")
    got = {(r.date, r.k): r.ta for r in upsert(history, new, ("date", "k")).collect()}
    assert got == {(JAN, "a"): 1, (JAN, None): 2, (FEB, "a"): 3}
    again = upsert(upsert(history, new, ("date", "k")), new, ("date", "k"))
    assert {(r.date, r.k): r.ta for r in again.collect()} == got


def test_upsert_collapses_repeats_in_order(spark):
    new = spark.createDataFrame(
        [("a", "f2", 2), ("a", "f1", 1), ("b", "f2", 5)], "k string, archivo string, ta int")
    got = upsert(None, new, ("k",), order=("archivo",)).collect()
    assert {(r.k, r.archivo, r.ta) for r in got} == {("a", "f1", 1), ("b", "f2", 5)}


def test_append_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1, 2)], "x int, y int")
    assert sorted(map(tuple, append_rows(a, b).collect()), key=str) == [(1, 2), (1, None)]
    assert append_rows(None, b).collect() == b.collect()


def _stream(spark, inputs, work, files_per_batch=1000, checkpoint="checkpoint"):
    start_ingest(spark, str(inputs), f"{work}/cells", f"{work}/{checkpoint}",
                 files_per_batch).awaitTermination()
    return _totals(spark, f"{work}/cells")


def test_stream_matches_batch_and_picks_up_new_files(spark, inputs, tmp_path):
    cells = str(tmp_path / "batch")
    update_cells(spark, str(inputs), cells)
    assert _stream(spark, inputs, tmp_path, 1) == _totals(spark, cells)
    write_file(inputs, "asg-2024-03-31.csv", [_row("5", 7)])
    assert _stream(spark, inputs, tmp_path, 1) == {JAN: 20, FEB: 40, MAR: 7}
    publish_tables(spark, f"{tmp_path}/cells", f"{tmp_path}/tables", names=("national",))
    assert read_snapshot(spark, f"{tmp_path}/tables/national").count() == 3


def test_stream_of_mixed_headers_and_stray_files(spark, inputs, tmp_path):
    full = ("sector_economico_1|ta|ta_sal|masa_sal_ta|tpc|tpu|tec|teu|sexo|Tamano_Patron|"
            "cve_entidad")
    write_file(inputs, "asg-2024-03-31.csv", ["0|7|7|70.00|1|2|3|1|2|S2|5"], full)
    write_file(inputs, "leeme.csv", ["1|0|S1|1|9|9|9|9|9|9.00|9"])
    write_file(inputs, "asg-2024-13-31.csv", ["1|0|S1|1|9|9|9|9|9|9.00|9"])
    assert _stream(spark, inputs, tmp_path) == {JAN: 20, FEB: 40, MAR: 7}
    row = build_table("national", read_table(spark, f"{tmp_path}/cells")).filter(
        "month = 3").first()
    assert (row.te, row.tp, row.sbc_prom) == (4, 3, 10.0)
    assert None not in {r.date for r in read_table(spark, f"{tmp_path}/cells").collect()}


def test_replay_and_new_checkpoint_change_nothing(spark, inputs, tmp_path):
    first = _stream(spark, inputs, tmp_path)
    assert _stream(spark, inputs, tmp_path, 1, "second") == first
    paths = sorted(str(p) for p in inputs.iterdir())
    assert not update_files(spark, paths, f"{tmp_path}/cells")
    assert not update_files(spark, [], f"{tmp_path}/cells")
    assert _totals(spark, f"{tmp_path}/cells") == first


def test_month_split_over_batches_is_whole(spark, inputs, tmp_path):
    source = inputs / "asg-2024-04-30.csv"
    source.mkdir()
    write_file(source, "part-0.csv", [_row("1", 3)])
    write_file(source, "part-1.csv", [_row("1", 4), _row("2", 5)])
    april = date(2024, 4, 1)
    assert _stream(spark, inputs, tmp_path, 1) == {JAN: 20, FEB: 40, april: 12}
    write_file(source, "part-2.csv", [_row("3", 6)])
    assert _stream(spark, inputs, tmp_path, 1)[april] == 18
    cells = str(tmp_path / "batch")
    update_cells(spark, str(inputs), cells)
    assert _totals(spark, cells) == _totals(spark, f"{tmp_path}/cells")


def test_stream_leaves_stored_months_alone(spark, inputs, tmp_path):
    cells = f"{tmp_path}/cells"
    update_cells(spark, str(inputs), cells, date_range=("2024-01-01", "2024-01-31"))
    write_file(inputs, "asg-2024-01-31.csv", [_row("1", 999)])
    write_file(inputs, "asg-2024-01-15.csv", [_row("1", 999)])
    assert _stream(spark, inputs, tmp_path) == {JAN: 20, FEB: 40}


def test_a_store_that_cannot_be_read_is_no_empty_store(spark, inputs, tmp_path):
    cells = tmp_path / "cells"
    (cells / "date=2024-01-01").mkdir(parents=True)
    (cells / "date=2024-01-01" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        update_cells(spark, str(inputs), str(cells))
    assert not table_exists(spark, str(tmp_path / "missing"))
    (tmp_path / "bare").mkdir()
    assert not table_exists(spark, str(tmp_path / "bare"))


def test_snapshots_survive_failed_and_empty_writes(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(3).withColumn("x", F.lit("a"))
    assert write_snapshot(df, path) == 1
    broken = df.withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    for _ in range(2):
        with pytest.raises(Exception, match="stop"):
            write_snapshot(broken, path)
    assert read_snapshot(spark, path).count() == 3
    assert write_snapshot(df.filter("id < 0"), path) == 2
    empty = read_snapshot(spark, path)
    assert empty.count() == 0 and empty.columns == ["id", "x"]
    assert write_snapshot(df.filter("id = 1"), path) == 3
    assert [r.id for r in read_snapshot(spark, path).collect()] == [1]
    with pytest.raises(TableReadError):
        read_snapshot(spark, str(tmp_path / "none"))
