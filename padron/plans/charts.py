"""The table behind each chart."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.formats import (
    by_sign, fmt_integer, fmt_millions, fmt_share, fmt_short_percent, slug,
)
from padron.functions.labels import region_key
from padron.functions.measures import pct_change
from padron.operators.cube import rollup_to
from padron.operators.growth import annual_rate, before
from padron.operators.periods import latest, latest_per_group, same_month, with_latest
from padron.operators.ranking import position, share
from padron.operators.trend import loess, loess_curve
from padron.plans.sheets import sector_rows


def state_rates(marginals: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Annual growth of each region in the latest month, under its map name."""
    states = marginals.filter(F.col("variable") == "cve_entidad")
    keyed = states.withColumn("categoria", region_key(F.col("categoria")))
    rated = annual_rate(rollup_to(keyed, "categoria"), ["categoria"])
    return latest(rated, as_of=as_of)


def region_map(regions: DataFrame, rates: DataFrame) -> DataFrame:
    """Every region of the map with its rate; regions without data stay, empty."""
    matched = regions.join(rates, regions["NOMGEO"] == rates["categoria"], "left")
    return matched.drop("categoria")


def state_bars(rates: DataFrame) -> DataFrame:
    """Bar order, sign word and label of each region."""
    return rates.withColumns({
        "orden": position("tc", "categoria", ["date"], descending=False),
        "signo": by_sign(F.col("tc"), "Positivo", "Negativo"),
        "etiqueta": fmt_short_percent(F.col("tc")),
    })


def national_sectors(state_sector: DataFrame, one_month: bool = False) -> DataFrame:
    """Share of each sector in the latest month's employment.

    With `one_month` the table is known to hold no other month and is not searched for it.
    """
    rows = rollup_to(state_sector if one_month else latest(state_sector), "sector")
    return _with_share(rows, "date")


def state_sectors(state_sector: DataFrame, one_month: bool = False) -> DataFrame:
    """Share of each sector within its state, with the state's output name."""
    newest = state_sector if one_month else latest(state_sector)
    rows = _with_share(newest, "date", "entidad")
    return rows.withColumn("slug", slug(F.col("entidad")))


def _with_share(df: DataFrame, *by: str) -> DataFrame:
    part = df.withColumn("share", share("ta", by))
    return part.withColumn("etiqueta", fmt_share(F.col("share")))


def annual_rate_series(national: DataFrame) -> DataFrame:
    """Annual growth per month, months without one left out, the last point labelled."""
    rated = annual_rate(national, [], "ta_tasa_anual").filter(F.col("ta_tasa_anual").isNotNull())
    rows = rated.select("date", "ta_tasa_anual")
    return _label_last(rows, "date", fmt_short_percent(F.col("ta_tasa_anual"), 2))


def level_series(national: DataFrame) -> DataFrame:
    """Permanent employment per month, in units and millions, the last point labelled."""
    rows = national.select("date", "tp", fmt_millions(F.col("tp")).alias("tp_millones"))
    return _label_last(rows, "date", fmt_integer(F.col("tp")))


def _label_last(df: DataFrame, date: str, text: Column) -> DataFrame:
    marked = with_latest(df, [date], date)
    label = F.when(F.col(date) == F.col(f"ult.{date}"), text)
    return marked.withColumn("etiqueta", label).drop("ult")


def same_month_bars(national: DataFrame) -> DataFrame:
    """Annual growth of the latest calendar month, in every year that has one."""
    rated = same_month(annual_rate(national, [], "ta_tasa_anual"))
    rows = rated.filter(F.col("ta_tasa_anual").isNotNull())
    return rows.select("year", "ta_tasa_anual",
                       (F.col("ta_tasa_anual") > 0).alias("positivo"),
                       fmt_short_percent(F.col("ta_tasa_anual")).alias("etiqueta"))


def last_points(long: DataFrame) -> DataFrame:
    """Newest point of each employer series, with its label."""
    rows = latest_per_group(long, ["tipo", "variable"])
    return rows.withColumn("etiqueta", fmt_short_percent(F.col("tasa_anual"), 2))


def employer_total(long: DataFrame) -> DataFrame:
    """The series of all employers, the last point labelled."""
    rows = long.filter((F.col("variable") == "Total") & (F.col("tipo") == "Tamaño"))
    return _label_last(rows, "fecha", fmt_short_percent(F.col("tasa_anual"), 2))


def _sector_rates(marginals: DataFrame) -> DataFrame:
    rows = sector_rows(marginals.filter(F.col("variable") == "sector_economico_1"))
    return rows.select(
        F.col("categoria").alias("sector_economico"), F.unix_date("date").alias("dia"),
        pct_change(F.col("ta"), before("ta", 1, ["categoria"])).alias("tc_mensual"))


def sector_trend_curve(marginals: DataFrame) -> DataFrame:
    """The smooth curve through each sector's monthly growth, as plotted: 80 points, in days."""
    return loess_curve(_sector_rates(marginals), "sector_economico", "dia", "tc_mensual")


def sector_trend(marginals: DataFrame) -> DataFrame:
    """Monthly growth of each sector with its smoothed trend, where the rate exists."""
    fitted = loess(_sector_rates(marginals), "sector_economico", "dia", "tc_mensual")
    return fitted.select("sector_economico", F.date_from_unix_date(F.col("dia").cast("int"))
                         .alias("date"), "tc_mensual", "tendencia")


def chart_tables(tables: dict[str, DataFrame], employers: DataFrame,
                 regions: DataFrame) -> dict[str, DataFrame]:
    """The table of every chart, from the stored tables, the employer rates in long form
    and the map dimension."""
    rates = state_rates(tables["marginals"])
    return {
        "mapa": region_map(regions, rates),
        "barras_entidades": state_bars(rates),
        "sectores_nacional": national_sectors(tables["state_sector"]),
        "sectores_entidad": state_sectors(tables["state_sector"]),
        "tasa_anual_ta": annual_rate_series(tables["national"]),
        "serie_tp": level_series(tables["national"]),
        "tasa_anual_mes": same_month_bars(tables["national"]),
        "patrones_series": employers,
        "patrones_ultimos": last_points(employers),
        "patrones_total": employer_total(employers),
        "tendencia_sectores": sector_trend(tables["marginals"]),
        "curva_sectores": sector_trend_curve(tables["marginals"]),
    }
