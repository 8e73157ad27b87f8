from datetime import date, datetime, timedelta, timezone

import pytest

from padron.plans.reissues import reissue_pairs, reissue_report, reissued_cells
from padron.plans.update import update_cells
from padron.sources.tables import read_table
from tests.test_sources import write_file

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def _row(state="1", ta=1, wage="10.00", size="S1"):
    return f"{state}|0|{size}|1|{ta}|{ta}|0|0|0|{wage}|{ta}"


@pytest.fixture
def store(spark, tmp_path):
    inputs, copies, cells = tmp_path / "inputs", tmp_path / "copies", str(tmp_path / "cells")
    inputs.mkdir()
    copies.mkdir()
    write_file(inputs, "asg-2024-01-31.csv", [_row("1", 5), _row("2", 6), _row("", 7)])
    write_file(inputs, "asg-2024-02-29.csv", [_row("1", 5), _row("1", 6), _row("4", 1)])
    update_cells(spark, str(inputs), cells)
    return copies, cells


def test_differences_by_cell(spark, store):
    copies, cells = store
    write_file(copies, "asg-2024-01-31.csv", [_row("1", 5), _row("3", 2), _row("", 9)])
    # Equal sums in another order and of other lines: no difference.
    write_file(copies, "asg-2024-02-29.csv", [_row("4", 1), _row("1", 11, "20.00")])
    before = sorted(map(str, read_table(spark, cells).collect()))
    found = reissued_cells(spark, str(copies), cells)
    rows = {(r.date, r.cve_entidad): (r.cambio, r.ta_antes, r.ta_ahora) for r in found.collect()}
    assert rows == {(JAN, "2"): ("gone", 6, None), (JAN, "3"): ("added", None, 2),
                    (JAN, None): ("changed", 7, 9)}
    [month] = reissue_report(found).collect()
    assert (month.celdas_nuevas, month.celdas_idas, month.celdas_cambiadas) == (1, 1, 1)
    assert (month.ta_dif, month.masa_ok_dif, month.ta_sal_ok_dif) == (-2, 0, -2)
    assert sorted(map(str, read_table(spark, cells).collect())) == before


def test_wage_that_no_row_counts_for(spark, store):
    copies, cells = store
    write_file(copies, "asg-2024-02-29.csv", [_row("1", 11, "20.00"), _row("4", 1, "0.00")])
    [row] = reissued_cells(spark, str(copies), cells).collect()
    assert (row.cve_entidad, row.cambio, row.ta_ahora) == ("4", "changed", 1)
    assert (row.masa_ok_antes, row.masa_ok_ahora) == (1000, None)


def test_other_names_and_months(spark, store):
    copies, cells = store
    write_file(copies, "asg-2024-01-15.csv", [_row("1", 5), _row("2", 6), _row("", 8)])
    write_file(copies, "asg-2024-03-31.csv", [_row("9", 9), "damaged"])  # not stored: never read
    [row] = reissued_cells(spark, str(copies), cells).collect()
    assert (row.archivo, row.guardado) == ("asg-2024-01-15.csv", "asg-2024-01-31.csv")
    assert (row.ta_antes, row.ta_ahora) == (7, 8)


def test_only_modified_sources(spark, store):
    copies, cells = store
    write_file(copies, "asg-2024-01-31.csv", [_row("1", 1)])
    now = datetime.now(timezone.utc)
    early, late = now - timedelta(days=1), now + timedelta(days=1)
    assert reissued_cells(spark, str(copies), cells, since=early).count() == 3
    none = reissued_cells(spark, str(copies), cells, since=late)
    assert none.count() == 0 and reissue_report(none).count() == 0


def test_same_name_goes_first(spark):
    offered = spark.createDataFrame([("b", JAN), ("c", JAN), ("a", FEB)], "archivo string, date date")
    stored = spark.createDataFrame([("a", JAN), ("b", JAN)], "archivo string, date date")
    assert {tuple(r) for r in reissue_pairs(offered, stored).select(
        "archivo", "guardado").collect()} == {("b", "b"), ("c", "a")}
