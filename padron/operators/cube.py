"""Aggregates of the microdata: base cells and every table that sums them.

`measured` turns microdata into five additive measures. All tables below are
sums (or a ratio of sums) of those, so each of them accepts either measured
microdata or the base cells: one scan of the microdata can feed them all.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.dictionaries import DIMENSIONS, LABELS
from padron.functions.labels import closed_label, long_label
from padron.functions.measures import has_wage, hundredths, mean_wage, row_sum, total

COUNTS = ("ta", "te", "tp")
WAGE_PARTS = ("masa_ok", "ta_sal_ok")
CELL_KEYS = ("date", "sexo", *reversed(DIMENSIONS))


def measured(micro: DataFrame) -> DataFrame:
    """Microdata with its additive measures: workers by type, wage mass and weight.

    The mass is carried in hundredths, as an integer: exact like a decimal, but
    summed without one. A group too large for it fails instead of wrapping.
    """
    ok = has_wage("masa_sal_ta", "ta_sal")
    return micro.withColumns({
        "te": row_sum("teu", "tec"),
        "tp": row_sum("tpu", "tpc"),
        "masa_ok": F.when(ok, hundredths("masa_sal_ta")),
        "ta_sal_ok": F.when(ok, F.col("ta_sal")),
    }).drop("teu", "tec", "tpu", "tpc", "masa_sal_ta", "ta_sal")


def base_cells(frame: DataFrame, keys: Sequence[str] = CELL_KEYS,
               measures: Sequence[str] = (*COUNTS, *WAGE_PARTS)) -> DataFrame:
    """Sum the measures per key combination (a few thousand cells a month).

    A null sum is kept for the wage parts, where it means that no row counted.
    """
    sums = [(total(m) if m in COUNTS else F.sum(m)).alias(m) for m in measures]
    return frame.groupBy(*keys).agg(*sums)


def with_period(df: DataFrame, date: str = "date") -> DataFrame:
    """Year and month columns, derived after aggregation instead of grouped by."""
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def national(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monthly workers by type and weighted mean wage, optionally `by` sex or source."""
    sums = [total(m).alias(m) for m in COUNTS]
    wage = mean_wage(*WAGE_PARTS).alias("sbc_prom")
    return with_period(frame.groupBy("date", *by).agg(*sums, wage))


def national_by_sex(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return national(frame, by=("sexo", *by))


def unpivot_dimensions(df: DataFrame, keep: Sequence[str | Column],
                       dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per dimension: its name in `variable`, its code in `categoria`, nulls kept."""
    return df.select(*keep, *dims).unpivot(list(keep), list(dims), "variable", "categoria")


def _one_way(frame: DataFrame, by: Sequence[str], measures: Sequence[str], aggs: list[Column],
             labels: dict[str, dict[str, str]]) -> DataFrame:
    # Three rows per input row, but only inside the scan's stage: what is shuffled is one
    # partial sum per code, and what is labelled is the codes.
    rows = unpivot_dimensions(frame, ("date", *by, *measures))
    codes = base_cells(rows, ("date", *by, "variable", "categoria"), measures)
    return _labelled(codes, by, aggs, labels)


def _labelled(codes: DataFrame, by: Sequence[str], aggs: list[Column],
              labels: dict[str, dict[str, str]]) -> DataFrame:
    named = codes.withColumn(
        "categoria", long_label(F.col("variable"), F.col("categoria"), labels))
    return with_period(named.groupBy("date", "variable", "categoria", *by).agg(*aggs))


def marginals(frame: DataFrame, by: Sequence[str] = (),
              labels: dict[str, dict[str, str]] = LABELS) -> DataFrame:
    """Workers per month and category of each single dimension, in long form."""
    return _one_way(frame, by, ["ta"], [total("ta").alias("ta")], labels)


def wage_marginals(frame: DataFrame, by: Sequence[str] = (),
                   labels: dict[str, dict[str, str]] = LABELS) -> DataFrame:
    """Weighted mean wage per month and category of each single dimension."""
    return _one_way(frame, by, WAGE_PARTS, [mean_wage(*WAGE_PARTS).alias("sbc_prom")], labels)


def marginal(frame: DataFrame, variable: str, by: Sequence[str] = (),
             labels: dict[str, dict[str, str]] = LABELS) -> DataFrame:
    """The rows of `marginals` for one dimension, aggregated without unpivoting the others."""
    codes = base_cells(frame, ("date", *by, variable), ["ta"])
    named = codes.withColumn("categoria", long_label(F.lit(variable), F.col(variable), labels))
    summed = named.groupBy("date", "categoria", *by).agg(total("ta").alias("ta"))
    return with_period(summed.withColumn("variable", F.lit(variable)))


def state_sector(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Workers per month, state and sector; codes without a label are missing data."""
    codes = base_cells(frame, ("date", *by, "cve_entidad", "sector_economico_1"), ["ta"])
    return _crossed(codes, by)


def _crossed(codes: DataFrame, by: Sequence[str]) -> DataFrame:
    named = codes.withColumns({
        "entidad": closed_label("cve_entidad", F.col("cve_entidad")),
        "sector": closed_label("sector_economico_1", F.col("sector_economico_1")),
    })
    summed = named.groupBy("date", "entidad", "sector", *by).agg(total("ta").alias("ta"))
    return with_period(summed)


def rollup_to(df: DataFrame, column: str, date: str = "date") -> DataFrame:
    """Sum workers over every other key, per month and `column`."""
    return with_period(df.groupBy(date, column).agg(total("ta").alias("ta")), date)


#: Tables by what they are summed over: sexes apart or not, no dimension, each one, or the cross.
_NONE, _EACH, _CROSS = "none", "each", "cross"
_CROSSED = ("cve_entidad", "sector_economico_1")


def grouped_sums(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sums of all tables, by one aggregate over grouping sets and one scan of the cells.

    `sexes` tells whether the row is of one sex, and `cut` its dimension: the name of one of
    DIMENSIONS, `cross` for the state by sector, or `none`. Codes of other dimensions are null.
    """
    fixed = ["date", *by]
    cuts = {_NONE: (), **{d: (d,) for d in DIMENSIONS}}
    sets = [[*fixed, *sex, *dims] for sex in ((), ("sexo",)) for dims in cuts.values()]
    keys = [*fixed, "sexo", *DIMENSIONS]
    sums = [(total(m) if m in COUNTS else F.sum(m)).alias(m) for m in (*COUNTS, *WAGE_PARTS)]
    held = {d: F.grouping(d) == 0 for d in ("sexo", *DIMENSIONS)}
    cut = F.when(held[_CROSSED[0]] & held[_CROSSED[1]], F.lit(_CROSS))
    for d in DIMENSIONS:
        cut = cut.when(held[d], F.lit(d))
    return cells.groupingSets([*sets, [*fixed, *_CROSSED]], *keys).agg(
        *sums, cut.otherwise(F.lit(_NONE)).alias("cut"), held["sexo"].alias("sexes"))


def tables_of(sums: DataFrame, by: Sequence[str] = (),
              labels: dict[str, dict[str, str]] = LABELS) -> dict[str, DataFrame]:
    """Every table from stored `grouped_sums`; equal to the tables of the cells themselves."""
    def of(sexes: bool, *cuts: str) -> DataFrame:
        rows = sums.filter(F.col("cut").isin(*cuts) & (F.col("sexes") == sexes))
        return rows if sexes else rows.drop("sexo")

    def one_way(sexes: bool, aggs: list[Column]) -> DataFrame:
        code = F.coalesce(*[F.when(F.col("cut") == d, F.col(d)) for d in DIMENSIONS])
        keys = ("sexo", *by) if sexes else tuple(by)
        codes = of(sexes, *DIMENSIONS).withColumns({"variable": F.col("cut"), "categoria": code})
        return _labelled(codes, keys, aggs, labels)

    workers, wage = [total("ta").alias("ta")], [mean_wage(*WAGE_PARTS).alias("sbc_prom")]
    return {
        "national": national(of(False, _NONE), by),
        "national_by_sex": national_by_sex(of(True, _NONE), by),
        "marginals": one_way(False, workers),
        "marginals_by_sex": one_way(True, workers),
        "state_sector": _crossed(of(False, _CROSS), by),
        "wage_marginals": one_way(False, wage),
        "wage_marginals_by_sex": one_way(True, wage),
    }
