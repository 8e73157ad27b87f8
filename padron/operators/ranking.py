"""Ranks, top-n selections and ranking texts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from padron.dictionaries import RANK_PREFIXES
from padron.functions.formats import fmt_percent
from padron.functions.literals import text_array


def competition_rank(metric: str, by: Sequence[str]) -> Column:
    """Rank of a metric in its group, highest first, ties sharing the lowest; null for null."""
    spec = Window.partitionBy(*by).orderBy(F.col(metric).desc_nulls_last())
    return F.when(F.col(metric).isNotNull(), F.rank().over(spec))


def position(metric: str, name: str, by: Sequence[str] = (), descending: bool = True) -> Column:
    """Row number by metric, nulls last and ties by name."""
    return F.row_number().over(Window.partitionBy(*by).orderBy(*_order(metric, name, descending)))


def top_n(df: DataFrame, n: int, metric: str, name: str, largest: bool = True) -> DataFrame:
    """The n first rows by metric with their position `rn`; ties are cut by name."""
    first = df.orderBy(*_order(metric, name, largest)).limit(n)
    return first.withColumn("rn", position(metric, name, descending=largest))


def ranking_text(df: DataFrame, n: int = 3, largest: bool = True,
                 metric: str = "tc_anual", name: str = "entidad_federativa",
                 decimals: int = 1) -> DataFrame:
    """`(i) A (1.2%); (ii) B (1.0%)` for the first n rows, as one row `texto`."""
    if not 1 <= n <= len(RANK_PREFIXES):
        raise ValueError(f"n must be between 1 and {len(RANK_PREFIXES)}")
    ranked = top_n(df, n, metric, name, largest)
    items = ranked.select("rn", ranking_item(name, metric, decimals).alias("item"))
    return items.agg(F.expr("listagg(item, '; ') within group (order by rn)").alias("texto"))


def ranking_item(name: str, metric: str, decimals: int = 1) -> Column:
    """`(i) A (1.2%)` for a row that carries its position in `rn`."""
    prefix = F.try_element_at(text_array(RANK_PREFIXES), F.col("rn"))
    return F.concat(prefix, F.lit(" "), F.col(name), F.lit(" ("),
                    fmt_percent(F.col(metric), decimals), F.lit(")"))


def share(measure: str, by: Sequence[str]) -> Column:
    """Part of the group total, as a fraction; null when the total is zero."""
    return F.try_divide(F.col(measure), F.sum(measure).over(Window.partitionBy(*by)))


def _order(metric: str, name: str, descending: bool) -> list[Column]:
    col = F.col(metric)
    return [col.desc_nulls_last() if descending else col.asc_nulls_last(), F.col(name).asc()]
