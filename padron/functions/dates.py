"""Calendar expressions; month words never depend on the locale."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from padron.dictionaries import MONTHS, MONTHS_SHORT
from padron.functions.literals import text_array


def month_start(date: str | Column) -> Column:
    return F.trunc(date, "month")


def month_end(date: str | Column) -> Column:
    return F.last_day(date)


def month_of(year: Column, month: Column) -> Column:
    """First day of a month; null when year or month is null."""
    return F.make_date(year, month, F.lit(1))


def month_index(date: str | Column) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(date) * 12 + F.month(date)


def month_name(month: Column, short: bool = False) -> Column:
    names = text_array(MONTHS_SHORT if short else MONTHS)
    return F.try_element_at(names, month)


def month_number(name: Column) -> Column:
    """Number of a capitalised month name, null when it is not one."""
    names = text_array(m.capitalize() for m in MONTHS)
    return F.nullif(F.array_position(names, name).cast("int"), F.lit(0))


def previous_month_name(date: str | Column) -> Column:
    return month_name(F.month(F.add_months(date, -1)))


def period_label(month: Column, year: Column) -> Column:
    """`4, 2026` -> `abril de 2026`."""
    return F.concat(month_name(month), F.lit(" de "), year.cast("string"))


def compact_period(date: str | Column) -> Column:
    """`2026-04-01` -> `202604`."""
    return F.date_format(date, "yyyyMM")
