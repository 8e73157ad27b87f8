"""Differences and growth rates against the previous row and the twelfth before it."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from padron.functions.dates import month_index
from padron.functions.measures import pct_change

YEAR = 12

#: Measures of the national table and the suffix their indicators carry.
NATIONAL_MEASURES = {"ta": "_ta", "te": "_te", "tp": "_tp", "sbc_prom": "_sbc"}


def series(keys: Sequence[str], date: str = "date") -> WindowSpec:
    """Rows of one series in time order.

    Without keys the whole table is one series: meant for tables that are
    already aggregated to one row per month.
    """
    return Window.partitionBy(*keys).orderBy(date)


def before(measure: str, steps: int, keys: Sequence[str], date: str = "date",
           calendar: bool = False) -> Column:
    """Value `steps` rows earlier or, with `calendar`, exactly that many months earlier."""
    if not calendar:
        return F.lag(measure, steps).over(series(keys, date))
    months = Window.partitionBy(*keys).orderBy(month_index(date)).rangeBetween(-steps, -steps)
    return F.max(measure).over(months)


def indicators(df: DataFrame, keys: Sequence[str] = (),
               measures: Mapping[str, str] = {"ta": ""}, date: str = "date",
               calendar: bool = False) -> DataFrame:
    """Monthly and annual difference and growth of each measure, rounded last.

    Levels and differences keep two decimals and rates four; the rates come
    from unrounded levels. `measures` maps each column to the suffix of its
    four indicators.
    """
    new: dict[str, Column] = {}
    for measure, suffix in measures.items():
        now = F.col(measure)
        for name, steps in (("mensual", 1), ("anual", YEAR)):
            then = before(measure, steps, keys, date, calendar)
            new[f"diff_{name}{suffix}"] = F.round(now - then, 2)
            new[f"tc_{name}{suffix}"] = F.round(pct_change(now, then), 4)
    out = df.withColumns(new)
    return out.withColumns({m: F.round(m, 2) for m in measures})


def national_indicators(national: DataFrame, calendar: bool = False) -> DataFrame:
    """All sixteen indicators of the national table."""
    return indicators(national, (), NATIONAL_MEASURES, calendar=calendar)


def annual_rate(df: DataFrame, keys: Sequence[str], name: str = "tc", measure: str = "ta",
                date: str = "date") -> DataFrame:
    """Unrounded growth against twelve rows earlier."""
    return df.withColumn(
        name, pct_change(F.col(measure), before(measure, YEAR, keys, date)))


def base_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric columns of a wide table other than its period columns."""
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def wide_rates(df: DataFrame, date: str = "fecha",
               exclude: Sequence[str] = ("Año", "mes_num")) -> DataFrame:
    """Monthly and annual growth of every numeric column, as `{col}_t_mensual` / `_t_anual`."""
    new: dict[str, Column] = {}
    for name in base_columns(df, exclude):
        quoted = "`" + name.replace("`", "``") + "`"
        for suffix, steps in (("t_mensual", 1), ("t_anual", YEAR)):
            new[f"{name}_{suffix}"] = pct_change(
                F.col(quoted), F.lag(F.col(quoted), steps).over(series((), date)))
    return df.withColumns(new)
