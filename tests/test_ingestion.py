"""Headers by one job, rejected lines, tables in one pass, and months that are refreshed alone."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from padron.operators import cube
from padron.plans.update import (
    TABLES, RejectedLines, all_tables, build_table, refresh_tables, source_cells, update_cells)
from padron.sources.catalog import list_files
from padron.sources.headers import header_variants, with_headers
from padron.sources.microdata import read_header, read_microdata, split_rejected
from padron.sources.tables import read_table
from padron.streaming.ingest import start_ingest
from tests.test_sources import HEADER, write_file
from tests.test_update import FEB, JAN, MAR, _row, inputs  # noqa: F401


def _jobs(spark, action) -> int:
    group = f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_take_one_job_more_than_their_listing(spark, tmp_path):
    drifted = "ta_sal|" + HEADER.removesuffix("|ta_sal").replace("tamaño", "Tamano")
    for month in range(1, 11):
        source = tmp_path / f"asg-2023-{month:02d}-28.csv"
        source.mkdir()
        for part in range(20):
            other = month > 8 and part % 2
            write_file(source, f"part-{part}.csv",
                       ["1|1|0|S1|1|1|1|0|0|0|9.00" if other else _row("1", 1)],
                       drifted if other else HEADER)
    files = list_files(spark, str(tmp_path))
    found = {}
    assert _jobs(spark, lambda: found.update(header_variants(files, True))) <= 4
    uniform, mixed = found[tuple(HEADER.split("|"))], found[tuple(drifted.split("|"))]
    # Eight sources are one path each; the files of the other two are told apart.
    assert (len(uniform), len(mixed)) == (8 + 20, 20)
    micro = read_microdata(spark, [str(p) for p in tmp_path.iterdir()])
    assert micro.agg(F.sum("ta"), F.count("*")).first()[:] == (200, 200)


def test_headers_as_spark_reads_them(spark, tmp_path):
    for name, line in {"a": HEADER, "b": "x||x|\"a|b\"", "c": "ñ|Ñ2|na"}.items():
        write_file(tmp_path, f"{name} ñ=1.csv", ["1|2|3|4"], line)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\r\n\nx|y\r\n1|2\r\n")
    rows = {r.path: r.header for r in with_headers(list_files(spark, str(tmp_path))).collect()}
    assert len(rows) == 4  # Spark lists no empty file
    for path, header in rows.items():
        assert tuple(header or ()) == read_header(spark, path)


def test_tolerant_read_keeps_rejected_lines_apart(spark, inputs, tmp_path):  # noqa: F811
    write_file(inputs, "asg-2024-03-31.csv", [
        _row("1", 7), "1|0|S1", _row("1", 7) + "|9", "1|0|S1|1|x|1|0|0|0|1.00|1",
        "1|0|S1|1|1.5|1|0|0|0|1.00|1", "1|0|S1|1|99999999999999999999|1|0|0|0|1.00|1",
        "1|0|S1|1|2.0|||||1e1|2", ""])
    rows = read_microdata(spark, [str(p) for p in inputs.iterdir()], tolerant=True)
    good, bad = split_rejected(rows)
    assert good.groupBy("month").agg(F.sum("ta").alias("ta")).collect() and good.count() == 6
    reasons = sorted(r.motivo for r in bad.collect())
    assert reasons == ["line of the wrong width"] * 2 + ["ta is not a number of its kind"] * 3
    assert {r.linea for r in bad.collect()} >= {"1|0|S1", "1|0|S1|1|x|1|0|0|0|1.00|1"}
    with pytest.raises(Exception, match="asg-2024-03-31.csv"):
        read_microdata(spark, [str(inputs / "asg-2024-03-31.csv")]).collect()


def test_rejected_lines_and_the_share_that_fails_a_run(spark, inputs, tmp_path):  # noqa: F811
    write_file(inputs, "asg-2024-03-31.csv", [_row("1", 7), "1|0|S1", "1|0|S1"])
    cells, rejected = str(tmp_path / "cells"), str(tmp_path / "rejected")
    with pytest.raises(RejectedLines, match="2 of 7 lines.*asg-2024-03-31.csv"):
        update_cells(spark, str(inputs), cells, rejected_path=rejected, max_rejected=0.1)
    assert not Path(cells).exists() and not Path(rejected).exists()
    assert update_cells(spark, str(inputs), cells, rejected_path=rejected, max_rejected=0.3)
    strict = str(tmp_path / "strict")
    write_file(inputs, "asg-2024-03-31.csv", [_row("1", 7)])
    update_cells(spark, str(inputs), strict)
    kept, wanted = (build_table("marginals", read_table(spark, c)).collect()
                    for c in (cells, strict))
    assert sorted(map(str, kept)) == sorted(map(str, wanted))
    [row] = read_table(spark, rejected).collect()
    assert (row.date, row.archivo, row.linea, row.filas) == (MAR, "asg-2024-03-31.csv", "1|0|S1", 2)
    assert not update_cells(spark, str(inputs), cells, rejected_path=rejected)


def test_one_pass_gives_the_tables_of_the_cells(spark, inputs, tmp_path):  # noqa: F811
    write_file(inputs, "asg-2024-01-15.csv", [_row("1", 3), _row("9", 4), "40||NA|1|5|||1||0|5"])
    cells_path = str(tmp_path / "cells")
    update_cells(spark, str(inputs), cells_path)
    cells = read_table(spark, cells_path)
    plan = cube.grouped_sums(cells, ("archivo",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    tables = all_tables(cells)
    assert set(tables) == set(TABLES)
    for name, df in tables.items():
        wanted = build_table(name, cells)
        assert sorted(df.columns) == sorted(wanted.columns)
        assert sorted(map(str, df.select(wanted.columns).collect())) == sorted(
            map(str, wanted.collect())), name


def _files(folder, name):
    return {p.parent.name: p.name for p in Path(folder, name).rglob("*.parquet")}


def test_refresh_rewrites_changed_months_alone(spark, inputs, tmp_path):  # noqa: F811
    cells, tables = str(tmp_path / "cells"), str(tmp_path / "tables")
    update_cells(spark, str(inputs), cells)
    assert refresh_tables(spark, cells, tables) == [JAN, FEB]
    before = {name: _files(tables, name) for name in TABLES}
    assert refresh_tables(spark, cells, tables) == []
    write_file(inputs, "asg-2024-03-31.csv", [_row("5", 7)])
    update_cells(spark, str(inputs), cells)
    assert refresh_tables(spark, cells, tables) == [MAR]
    for name in TABLES:
        after = _files(tables, name)
        assert set(after) == {*before[name], "date=2024-03-01"}
        assert {k: v for k, v in after.items() if k in before[name]} == before[name]
        wanted = build_table(name, read_table(spark, cells))
        assert sorted(map(str, read_table(spark, f"{tables}/{name}").select(
            wanted.columns).collect())) == sorted(map(str, wanted.collect()))


def test_stream_leaves_published_tables_current(spark, inputs, tmp_path):  # noqa: F811
    def run():
        start_ingest(spark, str(inputs), f"{tmp_path}/cells", f"{tmp_path}/checkpoint", 1,
                     tables=f"{tmp_path}/tables").awaitTermination()
        rows = read_table(spark, f"{tmp_path}/tables/national").collect()
        return {r.date: r.ta for r in rows}

    april = date(2024, 4, 1)
    source = inputs / "asg-2024-04-30.csv"
    source.mkdir()
    write_file(source, "part-0.csv", [_row("1", 3)])
    assert run() == {JAN: 20, FEB: 40, april: 3}
    write_file(source, "part-1.csv", [_row("2", 4)])
    assert run() == {JAN: 20, FEB: 40, april: 7}


def test_cells_of_a_tolerant_read_without_rejects(spark, inputs):  # noqa: F811
    paths = [str(p) for p in inputs.iterdir()]
    plain = source_cells(read_microdata(spark, paths))
    kept = source_cells(read_microdata(spark, paths, tolerant=True), ("motivo", "linea"))
    assert sorted(map(str, kept.select(plain.columns).collect())) == sorted(
        map(str, plain.collect()))
