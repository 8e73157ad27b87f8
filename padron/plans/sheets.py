"""Export sheets: growth by group, national summaries, latest months."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.dictionaries import NO_DATA
from padron.functions.formats import fmt_short_percent
from padron.functions.labels import band_ordinal, size_band
from padron.functions.measures import total
from padron.operators.growth import indicators
from padron.operators.periods import last_rows, latest
from padron.operators.ranking import competition_rank
from padron.operators.reshape import sign_flags

GROUP_COLUMNS = ("ta", "diff_mensual", "diff_anual", "tc_mensual", "tc_anual")


def group_growth(marginals: DataFrame, variable: str, name: str) -> DataFrame:
    """Indicators of every category of one dimension, the category named `name`."""
    rows = marginals.filter(F.col("variable") == variable)
    grown = indicators(rows, ("categoria",))
    return grown.select("year", "month", "date", F.col("categoria").alias(name), *GROUP_COLUMNS)


def sector_rows(marginals: DataFrame) -> DataFrame:
    """Marginals without the missing-sector rows that count nobody."""
    empty = (F.col("categoria") == NO_DATA["sector_economico_1"]) & (F.col("ta") == 0)
    return marginals.filter(~empty)


def sector_growth(marginals: DataFrame) -> DataFrame:
    return group_growth(sector_rows(marginals), "sector_economico_1", "sector_economico")


def size_growth(marginals: DataFrame) -> DataFrame:
    return group_growth(marginals, "patron", "tamano_patron")


def state_growth(marginals: DataFrame) -> DataFrame:
    """State indicators with the rank of the annual rate within each month."""
    rows = group_growth(marginals, "cve_entidad", "entidad_federativa")
    return rows.withColumn("ranking_tc_anual", competition_rank("tc_anual", ["date"]))


def size_bands(marginals: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest month by size band, under display headings and in display order."""
    sizes = marginals.filter(F.col("variable") == "patron")
    bands = (sizes.withColumn("tamano_grupo", size_band(F.col("categoria")))
             .groupBy("date", "tamano_grupo").agg(total("ta").alias("ta")))
    newest = latest(indicators(bands, ("tamano_grupo",)), as_of=as_of)
    return newest.select(
        band_ordinal(F.col("tamano_grupo")).alias("orden"),
        F.col("tamano_grupo").alias("Tamaño de patron"),
        F.col("ta").alias("Total"),
        F.col("diff_mensual").alias("Diferencia mensual"),
        F.col("tc_anual").alias("Cambio % anual"))


def employment_summary(ind: DataFrame) -> DataFrame:
    return ind.select("year", "month", "date", "ta", "diff_mensual_ta", "tc_mensual_ta",
                      "diff_anual_ta", "tc_anual_ta")


def wage_summary(ind: DataFrame) -> DataFrame:
    return ind.select("year", "month", "date", "sbc_prom", "diff_mensual_sbc", "tc_mensual_sbc",
                      "diff_anual_sbc", "tc_anual_sbc")


def employment_comparison(ind: DataFrame) -> DataFrame:
    return ind.select("year", "month", "date", "ta", "diff_mensual_ta", "tc_mensual_ta",
                      "te", "diff_mensual_te", "tc_mensual_te",
                      "tp", "diff_mensual_tp", "tc_mensual_tp")


def last_months(ind: DataFrame, n: int = 3) -> DataFrame:
    """Newest months of total employment, rates as percent text."""
    rows = last_rows(ind, n).select("date", "ta", "diff_mensual_ta", "tc_mensual_ta",
                                    "diff_anual_ta", "tc_anual_ta")
    numeric = [f.name for f in rows.schema if isinstance(f.dataType, T.NumericType)]
    rounded = rows.withColumns({c: F.round(c, 2) for c in numeric})
    return rounded.withColumns({
        c: fmt_short_percent(F.col(c), 3) for c in ("tc_mensual_ta", "tc_anual_ta")})


def group_sheets(marginals: DataFrame) -> dict[str, DataFrame]:
    """Growth sheets; `write_report` stores them. Rates carry a sign column."""
    sheets = {
        "Sector_Economico": sector_growth(marginals),
        "Tamaño_Patron": size_growth(marginals),
        "Entidad_Federativa": state_growth(marginals),
        "Otros": size_bands(marginals),
    }
    return {name: sign_flags(df, ("tc_mensual", "tc_anual")) if name != "Otros" else df
            for name, df in sheets.items()}


def national_sheets(ind: DataFrame) -> dict[str, DataFrame]:
    """National sheets; differences and rates carry a sign column."""
    sheets = {
        "Todos_Indicadores": ind,
        "Resumen_Empleo_Total": employment_summary(ind),
        "Resumen_Salarios": wage_summary(ind),
        "Comparativa_Empleos": employment_comparison(ind),
    }
    return {name: sign_flags(df) for name, df in sheets.items()}
