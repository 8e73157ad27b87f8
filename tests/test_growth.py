import pytest
from pyspark.sql import functions as F

from padron.operators.growth import base_columns, indicators, national_indicators, wide_rates
from padron.operators.reshape import annual_long, clean_employers, columns_table, sign_flags


def _series(spark, dates, values, key="a"):
    return spark.createDataFrame(
        [(key, d, v) for d, v in zip(dates, values)], "g string, date date, ta bigint")


def test_indicators_over_26_months(spark, months):
    dates, values = months(26), [100 + i * i for i in range(26)]
    rows = indicators(_series(spark, dates, values), ("g",)).orderBy("date").collect()
    for i, row in enumerate(rows):
        for name, steps in (("mensual", 1), ("anual", 12)):
            diff, rate = row[f"diff_{name}"], row[f"tc_{name}"]
            if i < steps:
                assert diff is None and rate is None
            else:
                before = values[i - steps]
                assert diff == values[i] - before
                assert rate == pytest.approx((values[i] / before - 1) * 100, abs=6e-5)


def test_groups_do_not_mix(spark, months):
    both = _series(spark, months(2), [1, 2]).union(_series(spark, months(2), [10, 30], "b"))
    got = {(r.g, r.date): r.diff_mensual for r in indicators(both, ("g",)).collect()}
    first, second = months(2)
    assert got == {("a", first): None, ("b", first): None, ("a", second): 1, ("b", second): 20}


def test_zero_base_has_no_rate(spark, months):
    rows = indicators(_series(spark, months(2), [0, 5])).orderBy("date").collect()
    assert rows[1].diff_mensual == 5 and rows[1].tc_mensual is None


def test_lag_is_positional_unless_calendar(spark, months):
    dates = months(14, skip=(6,))  # 13 rows with a gap
    df = _series(spark, dates, list(range(100, 113)))
    by_position = {r.date: r for r in indicators(df, ("g",)).collect()}
    by_calendar = {r.date: r for r in indicators(df, ("g",), calendar=True).collect()}
    last, after_gap = dates[-1], dates[6]
    assert by_position[last].diff_anual == 112 - 100  # twelve rows back is 13 months back
    assert by_calendar[last].diff_anual == 112 - 101  # same month of the year before
    assert by_position[after_gap].diff_mensual == 1
    assert by_calendar[after_gap].diff_mensual is None


def test_rates_come_from_unrounded_levels(spark, months):
    df = spark.createDataFrame(
        [(d, 1, 1, 1, v) for d, v in zip(months(2), [1.004, 1.0149])],
        "date date, ta bigint, te bigint, tp bigint, sbc_prom double")
    row = national_indicators(df).orderBy(F.col("date").desc()).first()
    assert row.sbc_prom == 1.01
    assert row.tc_mensual_sbc == pytest.approx((1.0149 / 1.004 - 1) * 100, abs=6e-5)
    assert len([c for c in national_indicators(df).columns if c[:3] in ("dif", "tc_")]) == 16


def test_wide_rates_follow_the_schema(spark):
    sheet = spark.createDataFrame(
        [(2020, "Enero", 10, 4, "x"), (2020, "Febrero", 15, 4, "y"), (2020, "Nada", 1, 1, "z")],
        "`Año` int, Mes string, Total bigint, `808 - más de 1,000` bigint, nota string")
    clean = clean_employers(sheet)
    assert base_columns(clean, ("Año", "mes_num")) == ["Total", "808 - más de 1,000"]
    rates = wide_rates(clean.filter("fecha is not null"))
    row = rates.filter("mes_num = 2").first()
    assert row["Total_t_mensual"] == 50.0 and row["808 - más de 1,000_t_mensual"] == 0.0
    long = annual_long(rates, "Tamaño")
    assert {(r.variable, r.tipo) for r in long.collect()} == {
        ("Total", "Tamaño"), ("808 - más de 1,000", "Tamaño")}
    assert clean.filter("mes_num is null").first().fecha is None


def test_annual_long_needs_rate_columns(spark):
    with pytest.raises(ValueError):
        annual_long(spark.range(1), "x")


def test_columns_table_keeps_missing_columns(spark):
    df = spark.createDataFrame([(7, 70)], "`a - x` bigint, Total bigint")
    rows = columns_table(df, {"a - x": "A", "b": "B"}, "etiqueta", "n", ["Total"]).collect()
    assert [(r.orden, r.etiqueta, r.n, r.Total) for r in rows] == [(1, "A", 7, 70), (2, "B", None, 70)]


def test_sign_flags(spark):
    df = spark.createDataFrame([(1.0, -1.0, 5), (0.0, None, 5)], "tc_a double, diff_b double, c int")
    rows = sign_flags(df).collect()
    assert [(r.sign_tc_a, r.sign_diff_b) for r in rows] == [("pos", "neg"), (None, None)]
    assert "sign_c" not in sign_flags(df).columns
