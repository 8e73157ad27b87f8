"""Report blocks as one-row tables, report tables, and the sentences built from them."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from padron.dictionaries import EMPLOYER_SIZES
from padron.functions.dates import month_name, period_label
from padron.functions.formats import (
    by_sign, fmt_integer, fmt_money, fmt_percent, or_default, versus,
)
from padron.functions.labels import closed_label, open_label
from padron.functions.measures import mean_wage, pct_of, total
from padron.operators.growth import YEAR, before, national_indicators, wide_rates
from padron.operators.periods import latest, latest_row, with_latest
from padron.operators.ranking import position, ranking_item, top_n
from padron.operators.reshape import columns_table

FLAT = 0.05


def _at_last(column: str, date: str) -> Column:
    """Value of a column in the newest row, inside an aggregate over `with_latest` rows."""
    return F.max(F.when(F.col(date) == F.col(f"ult.{date}"), F.col(f"`{column}`")))


def _period(date: Column) -> dict[str, Column]:
    return {"mes_label": period_label(F.month(date), F.year(date)),
            "mes_nombre": month_name(F.month(date)), "anio": F.year(date)}


# --- national -------------------------------------------------------------------------------

def national_figures(ind: DataFrame) -> DataFrame:
    """Newest indicators, year-to-date change and averages for the calendar month, as numbers."""
    marked = with_latest(ind, ["date", "year", "month"])
    newest = [_at_last(c, "date").alias(c) for c in ind.columns if c not in ("year", "month")]
    this_month = F.col("month") == F.col("ult.month")
    this_year = F.col("year") == F.col("ult.year")
    return marked.agg(
        *newest,
        total(F.when(this_year, F.col("diff_mensual_ta"))).alias("acumulado_anio"),
        F.avg(F.when(this_month, F.col("tc_mensual_ta"))).alias("prom_tc_mensual"),
        F.avg(F.when(this_month, F.col("tc_anual_ta"))).alias("prom_tc_anual"))


def national_block(ind: DataFrame) -> DataFrame:
    """Texts on total, permanent and temporary employment in the newest month."""
    c = F.col
    out = {
        **_period(c("date")),
        "anio_anterior": F.year("date") - 1,
        "ta_fmt": fmt_integer(c("ta")),
        "tp_fmt": fmt_integer(c("tp")),
        "te_fmt": fmt_integer(c("te")),
        "pct_tp_fmt": fmt_percent(pct_of(c("tp"), c("ta"))),
        "pct_te_fmt": fmt_percent(pct_of(c("te"), c("ta"))),
        "verbo_mensual": by_sign(c("diff_mensual_ta"), "crearon", "perdieron"),
        "verbo_anual": by_sign(c("diff_anual_ta"), "generaron", "perdieron"),
        "sustantivo_mensual": by_sign(c("diff_mensual_ta"), "aumento", "disminución"),
        "acumulado_anio_fmt": fmt_integer(F.abs(c("acumulado_anio"))),
        "dir_acumulado": by_sign(c("acumulado_anio"), "generación", "pérdida"),
    }
    for span in ("mensual", "anual"):
        rate = c(f"tc_{span}_ta")
        mean = c(f"prom_tc_{span}")
        out |= {
            f"tipo_cambio_{span}": by_sign(c(f"diff_{span}_ta"), "crecimiento", "decremento"),
            f"abs_{span}_fmt": fmt_integer(F.abs(c(f"diff_{span}_ta"))),
            f"tc_{span}_fmt": fmt_percent(F.abs(rate)),
            f"prom_tc_{span}_fmt": fmt_percent(mean),
            f"comp_{span}": versus(rate, mean),
        }
        words = {"mensual": ("aumento", "disminución"), "anual": ("crecimiento", "caída")}[span]
        for kind in ("tp", "te"):
            of_kind = c(f"tc_{span}_{kind}")
            out[f"tc_{span}_{kind}_fmt"] = fmt_percent(F.abs(of_kind))
            out[f"dir_{span}_{kind}"] = by_sign(of_kind, *words)
    return _named(national_figures(ind), out)


# --- states ---------------------------------------------------------------------------------

def state_rates(marginals: DataFrame) -> DataFrame:
    """Unrounded annual growth per state; the report ranks these, not the rounded ones."""
    rows = marginals.filter(F.col("variable") == "cve_entidad")
    then = before("ta", YEAR, ["categoria"])
    return rows.select("date", F.col("categoria").alias("entidad_federativa"), "ta",
                       (F.col("ta") - then).alias("diff_anual"),
                       pct_of(F.col("ta") - then, then).alias("tc_anual"))


def newest_rates(rates: DataFrame) -> DataFrame:
    """Rows of the newest month in which some state has a rate."""
    return latest(rates, having=F.col("tc_anual").isNotNull())


def flat_states(rates: DataFrame, threshold: float = FLAT) -> DataFrame:
    """States that neither grew nor shrank, as one text per month."""
    flat = F.when(F.abs("tc_anual") < threshold, F.col("entidad_federativa"))
    joined = F.expr("listagg(_flat, ' y ') within group (order by _flat)")
    months = rates.select("date", flat.alias("_flat")).groupBy("date").agg(joined.alias("texto"))
    return months.select(
        "date", or_default(F.col("texto"), "ninguna entidad").alias("entidades_nulas_txt"))


def extremes(newest: DataFrame, n: int = 3) -> DataFrame:
    """The n fastest and the n slowest states, with their position and rate text."""
    sides = [top_n(newest, n, "tc_anual", "entidad_federativa", largest)
             .withColumn("tipo", F.lit(kind))
             for kind, largest in (("mayor", True), ("menor", False))]
    both = sides[0].unionByName(sides[1])
    return both.select("tipo", "rn", "entidad_federativa", "tc_anual",
                       fmt_percent(F.col("tc_anual")).alias("tc_fmt"))


def state_block(newest: DataFrame) -> DataFrame:
    """Ranking texts, the flat states, and each of the three first and last states."""
    ends = extremes(newest).withColumn("item", ranking_item("entidad_federativa", "tc_anual"))
    texts, slots = [], []
    for kind, tag in (("mayor", ""), ("menor", "m")):
        text = f"listagg(item, '; ') within group (order by rn) filter (where tipo = '{kind}')"
        texts.append(F.expr(text).alias(f"ranking_{kind}_txt"))
        for i in (1, 2, 3):
            here = (F.col("tipo") == kind) & (F.col("rn") == i)
            slots += [F.max(F.when(here, F.col("entidad_federativa"))).alias(f"entidad_{tag}{i}"),
                      F.max(F.when(here, F.col("tc_fmt"))).alias(f"tc_entidad_{tag}{i}")]
    return merge_rows([ends.agg(*texts, *slots), flat_states(newest).drop("date")])


def state_table(newest: DataFrame) -> DataFrame:
    """States ranked by annual growth."""
    rank = position("tc_anual", "entidad_federativa", ["date"])
    return newest.select(
        rank.alias("Ranking"), F.col("entidad_federativa").alias("Entidad"),
        fmt_integer(F.col("ta")).alias("Trabajadores"),
        fmt_percent(F.col("tc_anual")).alias("Var. anual (%)"))


# --- sex ------------------------------------------------------------------------------------

def sex_columns(by_sex: DataFrame) -> DataFrame:
    """One row per month: men's (`h_`) and women's (`m_`) figures side by side."""
    sides = {"h": 1, "m": 2}
    return by_sex.groupBy("date").agg(*[
        F.max(F.when(F.col("sexo") == code, F.col(m))).alias(f"{side}_{m}")
        for side, code in sides.items() for m in ("ta", "tp", "te", "sbc_prom")])


def sex_block(by_sex: DataFrame) -> DataFrame:
    """Counts and shares by sex and the wage gap, in the newest month."""
    c = F.col
    everyone = c("h_ta") + c("m_ta")
    gap = c("h_sbc_prom") - c("m_sbc_prom")
    return _named(latest_row(sex_columns(by_sex)), {
        "mes_label": _period(c("date"))["mes_label"],
        "ta_hombres": fmt_integer(c("h_ta")),
        "ta_mujeres": fmt_integer(c("m_ta")),
        "pct_h_fmt": fmt_percent(pct_of(c("h_ta"), everyone)),
        "pct_m_fmt": fmt_percent(pct_of(c("m_ta"), everyone)),
        "sbc_h_fmt": fmt_money(c("h_sbc_prom")),
        "sbc_m_fmt": fmt_money(c("m_sbc_prom")),
        "brecha_fmt": fmt_money(gap),
        "brecha_pct": fmt_percent(pct_of(gap, c("h_sbc_prom"))),
        "sexo_mayor": F.when(c("h_ta") >= c("m_ta"), "hombres").when(
            c("h_ta") < c("m_ta"), "mujeres"),
    })


def employment_type_table(national: DataFrame, by_sex: DataFrame) -> DataFrame:
    """Permanent, temporary and total workers by sex in the newest month."""
    figures = merge_rows([latest_row(national).select("ta", "tp", "te"),
                          latest_row(sex_columns(by_sex)).drop("date")])
    c = F.col
    rows = []
    for i, (name, m) in enumerate((("Permanente", "tp"), ("Eventual", "te"), ("Total", "ta")), 1):
        part = F.lit("100.0%") if m == "ta" else fmt_percent(pct_of(c(m), c("ta")))
        rows.append(F.struct(
            F.lit(i).alias("orden"), F.lit(name).alias("Tipo de empleo"),
            fmt_integer(c(m)).alias("Total"), part.alias("% del total"),
            fmt_integer(c(f"m_{m}")).alias("Mujeres"), fmt_integer(c(f"h_{m}")).alias("Hombres"),
            F.lit("N/D").alias("No binario")))
    return figures.select(F.inline(F.array(*rows)))


# --- sectors --------------------------------------------------------------------------------

def sector_ranking(state_sector: DataFrame, one_month: bool = False) -> DataFrame:
    """Sectors of the newest month by size, with their percentage of the total.

    With `one_month` the table is known to hold no other month and is not searched for it.
    """
    rows = state_sector if one_month else latest(state_sector)
    return _ranked(rows.groupBy("date", "sector").agg(total("ta").alias("ta")))


def _ranked(rows: DataFrame) -> DataFrame:
    named = ~F.lower("sector").isin("total", "")
    kept = rows.filter(named)
    whole = F.sum("ta").over(Window.partitionBy("date"))
    return kept.withColumns({"rn": position("ta", "sector", ["date"]),
                             "pct": pct_of(F.col("ta"), whole)})


def sector_block(ranking: DataFrame) -> DataFrame:
    """The three largest sectors, with their joint share."""
    slots = [F.max("date").alias("date")]
    for i in (1, 2, 3):
        slots += [F.max(F.when(F.col("rn") == i, F.col(m))).alias(f"{m}_{i}")
                  for m in ("sector", "ta", "pct")]
    slots.append(F.sum(F.when(F.col("rn") <= 3, F.col("pct"))).alias("pct_top3"))
    out = {"mes_label": _period(F.col("date"))["mes_label"]}
    for i in (1, 2, 3):
        out |= {f"sector_{i}": F.col(f"sector_{i}"),
                f"ta_s{i}": fmt_integer(F.col(f"ta_{i}")),
                f"pct_s{i}": fmt_percent(F.col(f"pct_{i}"))}
    out["pct_top3_fmt"] = fmt_percent(F.col("pct_top3"))
    return _named(ranking.agg(*slots), out)


def sector_wage_table(ranking: DataFrame, wages: DataFrame) -> DataFrame:
    """Sectors of the newest month with their mean wage."""
    rows = wages.filter(F.col("variable") == "sector_economico_1")
    newest = latest(rows).select(F.col("categoria").alias("sector"), "sbc_prom")
    return _wage_columns(ranking.join(newest, "sector", "left"))


def sector_wages_of_cells(cells: DataFrame) -> DataFrame:
    """The same table from the cells of one month by sector: one aggregate, no join.

    Unknown codes count as workers without a sector, but not in that row's mean wage.
    """
    code = F.col("sector_economico_1")
    sector = closed_label("sector_economico_1", code)
    same = open_label("sector_economico_1", code) == sector
    rows = cells.withColumn("sector", sector).groupBy("date", "sector").agg(
        total("ta").alias("ta"), mean_wage(F.when(same, F.col("masa_ok")),
                                           F.when(same, F.col("ta_sal_ok"))).alias("sbc_prom"))
    return _wage_columns(_ranked(rows))


def _wage_columns(ranking: DataFrame) -> DataFrame:
    return ranking.select(
        F.col("rn").alias("orden"), F.col("sector").alias("Sector"),
        fmt_integer(F.col("ta")).alias("Trabajadores"),
        fmt_percent(F.col("pct")).alias("% del total"),
        fmt_money(F.col("sbc_prom")).alias("SBC promedio"))


# --- employers ------------------------------------------------------------------------------

def employer_figures(rates: DataFrame, reference) -> DataFrame:
    """Newest counts and rates, averages for the calendar month, and the reference count."""
    marked = with_latest(rates, ["fecha", "mes_num"], "fecha")
    this_month = F.col("mes_num") == F.col("ult.mes_num")
    wanted = ["fecha", "Total", "Total_t_mensual", "Total_t_anual"]
    wanted += [c for c in EMPLOYER_SIZES if c in rates.columns]
    at_reference = F.col("fecha") == F.lit(reference).cast("date")
    return marked.agg(
        *[_at_last(c, "fecha").alias(c) for c in wanted],
        F.avg(F.when(this_month, F.col("Total_t_mensual"))).alias("prom_tc_mensual"),
        F.avg(F.when(this_month, F.col("Total_t_anual"))).alias("prom_tc_anual"),
        F.lit(reference).cast("date").alias("ref_fecha"),
        F.max(F.when(at_reference, F.col("Total"))).alias("pat_ref"))


def employer_block(figures: DataFrame) -> DataFrame:
    """Texts on the number of employers; the change since the reference also as a number."""
    c = F.col
    change = c("pat_ref") - c("Total")
    out = {
        **_period(c("fecha")),
        "ref_label": period_label(F.month("ref_fecha"), F.year("ref_fecha")),
        "pat_actual_fmt": fmt_integer(c("Total")),
        "signo_anual": by_sign(c("Total_t_anual"), "+", "-"),
        "pat_ref_fmt": or_default(fmt_integer(c("pat_ref"))),
        "reduccion": change,
        "reduccion_fmt": or_default(fmt_integer(F.abs(change))),
    }
    for span in ("mensual", "anual"):
        rate, mean = c(f"Total_t_{span}"), c(f"prom_tc_{span}")
        out |= {f"tc_{span}_fmt": fmt_percent(F.abs(rate)),
                f"dir_{span}": by_sign(rate, "aumento", "disminución"),
                f"prom_tc_{span}_fmt": fmt_percent(mean),
                f"comp_{span}": versus(rate, mean)}
    return _named(figures, out)


def employer_size_table(figures: DataFrame) -> DataFrame:
    """Employers by size in the newest month; a size without a column stays empty."""
    rows = columns_table(figures, EMPLOYER_SIZES, "Tamaño de empresa", "n", ["Total"])
    return rows.select("orden", "Tamaño de empresa", fmt_integer(F.col("n")).alias("Patrones"),
                       fmt_percent(pct_of(F.col("n"), F.col("Total"))).alias("% del total"))


# --- whole report ---------------------------------------------------------------------------

def monthly_report(tables: dict[str, DataFrame], employers: DataFrame, reference,
                   institute: str = "") -> dict[str, DataFrame]:
    """Every block, table and sentence of the report, from the stored tables.

    `tables` holds the aggregate tables by name, `employers` the cleaned size
    sheet of the employer panel and `reference` the month its change is counted
    from. `write_report` stores the result.
    """
    newest = newest_rates(state_rates(tables["marginals"]))
    ranking = sector_ranking(tables["state_sector"])
    figures = employer_figures(wide_rates(employers), reference)
    blocks = {
        "nacional": national_block(national_indicators(tables["national"])),
        "entidades": state_block(newest),
        "sectores": sector_block(ranking),
        "patrones": employer_block(figures),
    }
    return {
        **blocks,
        "sexo": sex_block(tables["national_by_sex"]),
        "tabla_tipo_empleo": employment_type_table(tables["national"], tables["national_by_sex"]),
        "tabla_entidades": state_table(newest),
        "tabla_sectores": sector_wage_table(ranking, tables["wage_marginals"]),
        "tabla_tamano": employer_size_table(figures),
        "textos": sentences(blocks, institute),
    }


# --- sentences ------------------------------------------------------------------------------

# The sentences of the report, in order, with the block fields they show.
SENTENCES = [
    (1, "nacional", "A {mes_label} hay {ta_fmt} trabajadores asegurados{ante} (el {pct_te_fmt} son "
     "eventuales y el {pct_tp_fmt} son permanentes)."),
    (2, "nacional", "En {mes_nombre} de {anio} se {verbo_mensual} {abs_mensual_fmt} puestos de "
     "trabajo con respecto al mes anterior. Esto es un {tipo_cambio_mensual} del "
     "{tc_mensual_fmt}, cifra {comp_mensual} al promedio histórico ({prom_tc_mensual_fmt}) "
     "para este mes."),
    (3, "nacional", "En {mes_nombre} de {anio} se {verbo_anual} {abs_anual_fmt} puestos de "
     "trabajo con respecto al mismo mes del año anterior. Esto es un {tipo_cambio_anual} del "
     "{tc_anual_fmt}, cifra {comp_anual} al promedio histórico ({prom_tc_anual_fmt}) para este "
     "mes."),
    (4, "entidades", "Las entidades con mayores tasas de crecimiento anual fueron "
     "{ranking_mayor_txt}."),
    (5, "nacional", "Durante {mes_nombre} de {anio} se registraron {ta_fmt} puestos de trabajo, "
     "lo que representó un {sustantivo_mensual} de {abs_mensual_fmt} empleos respecto al mes "
     "anterior, equivalente a un {tipo_cambio_mensual} mensual de {tc_mensual_fmt} y con un "
     "{tipo_cambio_anual} anual de {tc_anual_fmt} respecto a {mes_nombre} de {anio_anterior}."),
    (6, "nacional", "Por tipo de empleo, el trabajo permanente mostró una {dir_mensual_tp} "
     "mensual de {tc_mensual_tp_fmt} y un {dir_anual_tp} anual de {tc_anual_tp_fmt}, mientras "
     "que el empleo eventual registró un {dir_mensual_te} mensual de {tc_mensual_te_fmt} y una "
     "tasa anual de {tc_anual_te_fmt}."),
    (7, "nacional", "Permanentes: {tp_fmt} ({pct_tp_fmt})"),
    (8, "nacional", "Eventuales: {te_fmt} ({pct_te_fmt})"),
    (9, "nacional", "Durante el mes de {mes_nombre}, se registró una {dir_acumulado} de "
     "{acumulado_anio_fmt} nuevos puestos de trabajo durante {anio}."),
    (10, "nacional", "En {mes_nombre} de {anio}, se registraron {abs_anual_fmt} empleos "
     "adicionales en comparación con {mes_nombre} de {anio_anterior}."),
    (11, "entidades", "Las entidades con mayor crecimiento anual en el empleo asegurado fueron "
     "{entidad_1} ({tc_entidad_1}), {entidad_2} ({tc_entidad_2}) y {entidad_3} "
     "({tc_entidad_3})."),
    (12, "entidades", "En contraste, {entidades_nulas_txt} registraron un crecimiento nulo "
     "(0.0%) en el número de trabajadores registrados{ante}."),
    (13, "entidades", "Por otro lado, las mayores disminuciones anuales se observaron en: "
     "{ranking_menor_txt}."),
    (14, "sectores", "Por tipo de sector, los que presentaron mayor aumento anual en puestos de "
     "trabajo fueron {sector_1} ({pct_s1}), {sector_2} ({pct_s2}) y {sector_3} ({pct_s3})."),
    (15, "sectores", "Al interior de los sectores económicos, el sector de {sector_1} concentró en "
     "{mes_label} el {pct_s1} del empleo total, seguido de {sector_2} ({pct_s2}) y {sector_3} ({pct_s3}). En conjunto, estos tres "
     "sectores agrupan aproximadamente el {pct_top3_fmt} del empleo formal en el país."),
    (16, "patrones", "En {mes_nombre} de {anio} se registraron {pat_actual_fmt} patrones, lo que "
     "representa una {dir_anual} anual de {tc_anual_fmt}, cifra {comp_anual} al promedio "
     "histórico ({prom_tc_anual_fmt}) para este mes."),
    (17, "patrones", "Desde {ref_label}, el número de patrones inscritos ha pasado de "
     "{pat_ref_fmt} a {pat_actual_fmt}, lo que equivale a una reducción de {reduccion_fmt} "
     "registros patronales."),
]

#: The sentence that is left out when no state was flat.
FLAT_SENTENCE = 12


def sentences(blocks: dict[str, DataFrame], institute: str = "") -> DataFrame:
    """The report text as rows `orden, bloque, texto`, from the one-row blocks by name.

    `institute` is the name of the body that workers are registered with, if it is to be shown.
    """
    frames = []
    for name, block in blocks.items():
        block = block.withColumn("ante", F.lit(f" ante el {institute}" if institute else ""))
        mine = [(i, text) for i, owner, text in SENTENCES if owner == name]
        rows = [F.struct(F.lit(i).alias("orden"), F.lit(name).alias("bloque"),
                         fill(text).alias("texto")) for i, text in mine]
        lines = block.select("*", F.explode(F.array(*rows)).alias("_s"))
        if "entidades_nulas_txt" in block.columns:
            none_flat = F.col("entidades_nulas_txt") == "ninguna entidad"
            lines = lines.filter((F.col("_s.orden") != FLAT_SENTENCE) | ~none_flat)
        frames.append(lines.select("_s.*"))
    return reduce(lambda a, b: a.unionByName(b), frames)


def fill(template: str) -> Column:
    """Text with each `{field}` replaced by that column."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.col(p).cast("string") if i % 2 else F.lit(p)
                      for i, p in enumerate(pieces)])


# --- shared ---------------------------------------------------------------------------------

def merge_rows(parts: list[DataFrame]) -> DataFrame:
    """One-row tables side by side, by a union and one aggregate instead of a product."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in stacked.columns])


def _named(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()])
