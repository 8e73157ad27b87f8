"""Row and aggregate measures of employment and wage."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum(*cols: str | Column) -> Column:
    """Sum across columns of a row, a null counting as zero."""
    return reduce(add, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def total(col: str | Column) -> Column:
    """Sum over a group that is 0, not null, when there is nothing to add."""
    return F.coalesce(F.sum(col), F.lit(0))


def wage_ratio(mass: str | Column, workers: str | Column) -> Column:
    """Wage of one registry cell; a zero ratio or zero workers give null."""
    return F.nullif(F.try_divide(_col(mass).cast("double"), _col(workers)), F.lit(0.0))


def has_wage(mass: str | Column, workers: str | Column) -> Column:
    """Whether the cell enters the weighted mean: both its mass and its weight are non-zero."""
    return (_col(mass) != 0) & (_col(workers) != 0)


def hundredths(money: str | Column) -> Column:
    """Amount with two decimals as an integer number of hundredths."""
    return (_col(money) * 100).cast("bigint")


def mean_wage(mass: str | Column, workers: str | Column) -> Column:
    """Weighted mean wage from `hundredths` of mass and weights that passed `has_wage`."""
    return F.try_divide(F.sum(mass).cast("double") / 100, F.sum(workers))


def pct_change(now: Column, before: Column) -> Column:
    """Growth in percent; null when the base is zero or missing."""
    return (F.try_divide(now, before) - 1) * 100


def pct_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
