from datetime import date

import pytest
from pyspark.sql import functions as F

from padron.functions import dates as D
from padron.functions import formats as X


@pytest.mark.parametrize("value, expr, expected", [
    (22748603.0, X.fmt_integer, "22,748,603"),
    (-1234.4, X.fmt_integer, "-1,234"),
    (1.057, X.fmt_percent, "1.1%"),
    (0.1057, X.fmt_percent, "0.1%"),
    (-0.04, X.fmt_percent, "0.0%"),
    (809.18, X.fmt_money, "$809.18"),
    (-5.0, X.fmt_money, "-$5.00"),
    (1234.5, X.fmt_number, "1,234.50"),
    (1.5, X.fmt_signed_percent, "+1.5%"),
    (-2.3, X.fmt_signed_percent, "-2.3%"),
    (0.0, X.fmt_signed_percent, "+0.0%"),
    (2.0, X.fmt_short_percent, "2%"),
    (100.0, X.fmt_short_percent, "100%"),
    (10.0, lambda x: X.fmt_short_percent(x, 0), "10%"),
    (100.0, lambda x: X.fmt_short_percent(x, 0), "100%"),
    (0.0, lambda x: X.fmt_short_percent(x, 0), "0%"),
    (2.5, lambda x: X.fmt_short_percent(x, 3), "2.5%"),
    (10.05, lambda x: X.fmt_short_percent(x, 3), "10.05%"),
    (-12.34, X.fmt_short_percent, "-12.3%"),
    (0.1234, X.fmt_share, "12.3%"),
    (None, X.fmt_percent, None),
    (None, X.fmt_money, None),
    (None, X.fmt_signed_percent, None),
    (1.0, lambda x: X.by_sign(x, "a", "b"), "a"),
    (0.0, lambda x: X.by_sign(x, "a", "b"), "a"),
    (-1.0, lambda x: X.by_sign(x, "a", "b"), "b"),
    (None, lambda x: X.by_sign(x, "a", "b"), None),
    (2.0, lambda x: X.versus(x, F.lit(2.0)), "mayor"),
    (1.9, lambda x: X.versus(x, F.lit(2.0)), "menor"),
    (None, lambda x: X.or_default(X.fmt_integer(x)), "N/D"),
    (2500000.0, X.fmt_millions, 2.5),
])
def test_formats(spark, value, expr, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(expr(F.col("x")).alias("t")).first().t == expected


def test_slug(spark):
    df = spark.createDataFrame([("Ciudad de México",)], "x string")
    assert df.select(X.slug(F.col("x")).alias("t")).first().t == "ciudad_de_méxico"


def test_month_words(spark):
    df = spark.createDataFrame([(4, 2026)], "m int, y int")
    row = df.select(D.month_name(F.col("m")).alias("n"), D.month_name(F.col("m"), True).alias("s"),
                    D.period_label(F.col("m"), F.col("y")).alias("l")).first()
    assert tuple(row) == ("abril", "abr", "abril de 2026")


def test_month_number_is_exact(spark):
    df = spark.createDataFrame([("Enero",), ("Diciembre",), ("enero",), ("x",), (None,)], "m string")
    got = [r.n for r in df.select(D.month_number(F.col("m")).alias("n")).collect()]
    assert got == [1, 12, None, None, None]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 1, 15),)], "d date")
    row = df.select(D.month_start("d").alias("a"), D.month_end("d").alias("b"),
                    D.previous_month_name("d").alias("c"), D.compact_period("d").alias("e")).first()
    assert tuple(row) == (date(2024, 1, 1), date(2024, 1, 31), "diciembre", "202401")
