import pytest
from pyspark.sql import functions as F

from contract.registro import registro
from padron.operators import cube
from padron.plans import charts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def measured(spark):
    df = cube.measured(registro(spark, SF)).cache()
    yield df
    df.unpersist()


def test_marginals_add_up_to_the_nation(measured):
    nation = {r.date: r.ta for r in cube.national(measured).collect()}
    rows = cube.marginals(measured).groupBy("date", "variable").agg(F.sum("ta").alias("ta")).collect()
    assert len(rows) == 3 * len(nation)
    assert all(nation[r.date] == r.ta for r in rows)


def test_cells_and_microdata_give_the_same_tables(measured):
    cells = cube.base_cells(measured)
    for table in (cube.national, cube.national_by_sex, cube.marginals, cube.wage_marginals,
                  cube.state_sector):
        direct, from_cells = table(measured), table(cells)
        assert direct.exceptAll(from_cells.select(direct.columns)).isEmpty()
        assert from_cells.select(direct.columns).exceptAll(direct).isEmpty()


def test_one_dimension_equals_its_marginals(measured):
    whole = cube.marginals(measured).filter("variable = 'patron'")
    one = cube.marginal(measured, "patron").select(whole.columns)
    assert whole.exceptAll(one).isEmpty() and one.exceptAll(whole).isEmpty()


def test_shares_add_up_to_one(measured):
    table = cube.state_sector(measured)
    for df, keys in ((charts.national_sectors(table), []), (charts.state_sectors(table), ["entidad"])):
        sums = df.groupBy(*keys).agg(F.sum("share").alias("s")).collect()
        assert sums and all(r.s == pytest.approx(1.0) for r in sums)


def test_types_of_employment_add_up(measured):
    row = cube.national(measured).agg(F.sum("te"), F.sum("tp")).first()
    rows = measured.select("te", "tp").collect()
    assert tuple(row) == (sum(r.te for r in rows), sum(r.tp for r in rows))
