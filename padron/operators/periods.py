"""Selections of rows by period."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from padron.functions.dates import period_label


def latest_date(df: DataFrame, date: str = "date", having: Column | None = None) -> Column:
    """Newest date of a table, or newest where `having` holds, as a scalar subquery."""
    value = F.col(date) if having is None else F.when(having, F.col(date))
    return df.select(F.max(value)).scalar()


def latest(df: DataFrame, date: str = "date", having: Column | None = None,
           as_of: Column | None = None) -> DataFrame:
    """Rows of the newest period; `as_of` gives the date when it is known more cheaply."""
    wanted = latest_date(df, date, having) if as_of is None else as_of
    return df.filter(F.col(date) == wanted)


def latest_row(df: DataFrame, date: str = "date") -> DataFrame:
    """The newest row of a table with one row per period (a top-1, no second scan)."""
    return df.orderBy(F.col(date).desc_nulls_last()).limit(1)


def latest_per_group(df: DataFrame, keys: Sequence[str], date: str = "fecha") -> DataFrame:
    """Rows at the newest date of their own group, ties kept."""
    newest = F.max(date).over(Window.partitionBy(*keys))
    return df.withColumn("_newest", newest).filter(F.col(date) == F.col("_newest")).drop("_newest")


def last_rows(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    """The n newest rows."""
    return df.orderBy(F.col(date).desc_nulls_last()).limit(n)


def with_latest(df: DataFrame, columns: Sequence[str], date: str = "date",
                name: str = "ult") -> DataFrame:
    """Carry the newest row's `columns` on every row, as one struct.

    For tables with one row per period: the window reuses the single partition
    their lag windows already need.
    """
    newest = F.max_by(F.struct(*columns), F.col(date)).over(Window.partitionBy())
    return df.withColumn(name, newest)


def same_month(df: DataFrame, date: str = "date", month: str = "month") -> DataFrame:
    """Rows of every year for the calendar month of the newest row."""
    marked = with_latest(df, [month], date, "_last")
    return marked.filter(F.col(month) == F.col(f"_last.{month}")).drop("_last")


def between(df: DataFrame, start, end, date: str = "date") -> DataFrame:
    """Rows of a date range, both ends included."""
    return df.filter(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def period_record(df: DataFrame) -> DataFrame:
    """Newest period as one row: year, month, date and label."""
    dates = df.agg(F.max("date").alias("date"))
    period = dates.withColumns({"year": F.year("date"), "month": F.month("date")})
    return period.withColumn("label", period_label(F.col("month"), F.col("year")))
