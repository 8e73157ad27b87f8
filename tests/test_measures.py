from decimal import Decimal

from pyspark.sql import functions as F

from padron.functions.measures import (
    has_wage, hundredths, mean_wage, pct_change, row_sum, total, wage_ratio,
)

SCHEMA = "g string, masa decimal(18,2), w bigint"


def _rows(spark, rows):
    return spark.createDataFrame(
        [(g, None if m is None else Decimal(m), w) for g, m, w in rows], SCHEMA)


def test_row_sum_counts_null_as_zero(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (None, None)], "a bigint, b bigint")
    assert [r.s for r in df.select(row_sum("a", "b").alias("s")).collect()] == [3, 3, 0]


def test_total_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,)], "a bigint")
    assert df.agg(total("a").alias("t")).first().t == 0


def test_wage_ratio_edges(spark):
    df = _rows(spark, [("a", "10.00", 4), ("a", "0.00", 4), ("a", "5.00", 0), ("a", None, 1)])
    got = [r.s for r in df.select(wage_ratio("masa", "w").alias("s")).collect()]
    assert got == [2.5, None, None, None]


def _mean(df):
    ok = has_wage("masa", "w")
    parts = df.select("g", F.when(ok, hundredths("masa")).alias("m"),
                      F.when(ok, F.col("w")).alias("w"))
    return {r.g: r.s for r in parts.groupBy("g").agg(mean_wage("m", "w").alias("s")).collect()}


def test_mean_wage_drops_excluded_weights(spark):
    df = _rows(spark, [
        ("a", "100.00", 2), ("a", "0.00", 50), ("a", "7.00", 0), ("a", None, 9),
        ("a", "50.50", 1), ("b", "0.00", 3), ("b", None, None),
    ])
    got = _mean(df)
    # Brute force: the ratio is missing where it is zero; those rows lose their weight too.
    assert got["a"] == (100.0 + 50.5) / 3
    assert got["b"] is None


def test_hundredths_are_exact(spark):
    df = _rows(spark, [("a", "9999999999999999.99", 1), ("a", "0.01", 1), ("a", "-1.29", 1)])
    got = [r.h for r in df.select(hundredths("masa").alias("h")).collect()]
    assert got == [999999999999999999, 1, -129]


def test_pct_change_without_base(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (6, 4)], "a bigint, b bigint")
    got = [r.p for r in df.select(pct_change(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [None, None, 50.0]
