from datetime import date

import pytest

from padron.operators.periods import last_rows, latest, latest_per_group, period_record, same_month
from padron.operators.ranking import competition_rank, position, ranking_text, share, top_n
from padron.plans.report import extremes, flat_states, merge_rows, newest_rates, state_block

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


@pytest.fixture
def rates(spark):
    rows = [(D1, n, v) for n, v in (
        ("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None), ("e", -2.0), ("f", 0.01), ("g", -0.02))]
    return spark.createDataFrame(
        rows + [(D2, "a", None)], "date date, entidad_federativa string, tc_anual double")


def test_competition_rank_shares_ties_and_skips_nulls(rates):
    got = {r.entidad_federativa: r.rk for r in rates.filter(rates.date == D1).withColumn(
        "rk", competition_rank("tc_anual", ["date"])).collect()}
    assert got == {"b": 1, "c": 1, "a": 3, "f": 4, "g": 5, "e": 6, "d": None}


def test_position_breaks_ties_by_name(rates):
    got = {r.entidad_federativa: r.rn for r in rates.filter(rates.date == D1).withColumn(
        "rn", position("tc_anual", "entidad_federativa", ["date"])).collect()}
    assert (got["b"], got["c"], got["d"]) == (1, 2, 7)


def test_newest_month_needs_a_rate(rates):
    assert {r.date for r in newest_rates(rates).collect()} == {D1}
    assert {r.date for r in latest(rates).collect()} == {D2}


def test_top_n(rates):
    newest = newest_rates(rates)
    top = {r.rn: r.entidad_federativa for r in
           top_n(newest, 3, "tc_anual", "entidad_federativa").collect()}
    low = {r.rn: r.entidad_federativa for r in
           top_n(newest, 3, "tc_anual", "entidad_federativa", largest=False).collect()}
    assert top == {1: "b", 2: "c", 3: "a"} and low == {1: "e", 2: "g", 3: "f"}


def test_ranking_text(rates):
    newest = newest_rates(rates)
    assert ranking_text(newest, 2).first().texto == "(i) b (3.0%); (ii) c (3.0%)"
    assert ranking_text(newest, 1, largest=False).first().texto == "(i) e (-2.0%)"
    with pytest.raises(ValueError):
        ranking_text(newest, 6)


def test_flat_states_per_month(rates):
    got = {r.date: r.entidades_nulas_txt for r in flat_states(rates).collect()}
    assert got == {D1: "f y g", D2: "ninguna entidad"}


def test_state_block(rates):
    block = state_block(newest_rates(rates)).collect()
    assert len(block) == 1
    row = block[0]
    assert row.ranking_mayor_txt == "(i) b (3.0%); (ii) c (3.0%); (iii) a (1.0%)"
    assert row.ranking_menor_txt == "(i) e (-2.0%); (ii) g (0.0%); (iii) f (0.0%)"
    assert (row.entidad_1, row.tc_entidad_1, row.entidad_m1) == ("b", "3.0%", "e")
    assert row.entidades_nulas_txt == "f y g"
    assert extremes(newest_rates(rates)).count() == 6


def test_share_of_empty_total(spark):
    df = spark.createDataFrame([("x", 1), ("x", 3), ("y", 0)], "g string, ta bigint")
    got = sorted((r.g, r.s) for r in df.select("g", share("ta", ["g"]).alias("s")).collect()
                 if r.s is not None)
    assert got == [("x", 0.25), ("x", 0.75)]


def test_period_selections(spark, months):
    df = spark.createDataFrame([(d, d.month, i) for i, d in enumerate(months(15))],
                               "date date, month int, v int")
    assert sorted(r.v for r in same_month(df).collect()) == [2, 14]
    assert sorted(r.v for r in last_rows(df, 3).collect()) == [12, 13, 14]
    record = period_record(df).first()
    assert (record.year, record.month, record.label) == (2021, 3, "marzo de 2021")


def test_latest_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("a", D1, 1), ("a", D2, 2), ("a", D2, 3), ("b", D1, 4)],
                               "variable string, fecha date, v int")
    assert sorted(r.v for r in latest_per_group(df, ["variable"]).collect()) == [2, 3, 4]


def test_merge_rows(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("t",)], "y string")
    assert merge_rows([a, b]).collect() == [(1, "t")]
