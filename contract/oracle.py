"""The same results in SQL for DuckDB, written from the definitions, not from the Spark plans."""

import re

from contract.registro import BROKEN_LINES, DUCKDB, INSTITUTE, REFERENCE_MONTH, projection
from padron.dictionaries import (
    EMPLOYER_SIZES, LABELS, MONTHS, MONTHS_SHORT, NO_DATA, RANK_PREFIXES, SECTORS, SIZES,
    SIZES_LEGACY,
)
from padron.plans.report import FLAT, FLAT_SENTENCE, SENTENCES


# --- text helpers ---------------------------------------------------------------------------

_MEASURES = ("ta", "te", "tp", "masa_ok", "ta_sal_ok")
_CELL = "date, sexo, cve_entidad, sector_economico_1, patron"
#: Stored cells and those of the copies side by side, one row per cell, then summed by month.
_REISSUED = (
    "WITH r AS (SELECT *, coalesce(teu, 0) + coalesce(tec, 0) AS te, coalesce(tpu, 0)"
    " + coalesce(tpc, 0) AS tp, masa_sal_ta <> 0 AND ta_sal <> 0 AS ok FROM registro"
    " WHERE year(date) = 1996), lados AS (SELECT *, false AS nuevo FROM r UNION ALL"
    " SELECT * REPLACE (ta + CASE WHEN month(date) BETWEEN 3 AND 6 AND cve_entidad = '3'"
    " THEN 1 ELSE 0 END AS ta), true AS nuevo FROM r"
    " WHERE month(date) > 2 OR l_suppkey % 3 <> 0),"
    f" celdas AS (SELECT {_CELL}, nuevo, sum(ta) AS ta, sum(te) AS te, sum(tp) AS tp,"
    " sum(masa_sal_ta * 100) FILTER (WHERE ok) AS masa_ok,"
    " sum(ta_sal) FILTER (WHERE ok) AS ta_sal_ok FROM lados GROUP BY ALL),"
    f" pares AS (SELECT {_CELL}, bool_or(nuevo) AS hay, bool_or(NOT nuevo) AS habia, "
    + ", ".join(f"max({m}) FILTER (WHERE NOT nuevo) AS {m}_antes,"
                f" max({m}) FILTER (WHERE nuevo) AS {m}_ahora" for m in _MEASURES)
    + " FROM celdas GROUP BY ALL), distintas AS (SELECT *, CASE WHEN NOT habia THEN 'added'"
    " WHEN NOT hay THEN 'gone' ELSE 'changed' END AS cambio FROM pares WHERE NOT (hay AND habia"
    + "".join(f" AND {m}_antes IS NOT DISTINCT FROM {m}_ahora" for m in _MEASURES)
    + ")) SELECT date, concat('asg-', last_day(date), '.csv') AS archivo,"
    " concat('asg-', last_day(date), '.csv') AS guardado,"
    " count(*) FILTER (WHERE cambio = 'added') AS celdas_nuevas,"
    " count(*) FILTER (WHERE cambio = 'gone') AS celdas_idas,"
    " count(*) FILTER (WHERE cambio = 'changed') AS celdas_cambiadas, "
    + ", ".join(f"CAST(sum(coalesce({m}_ahora, 0) - coalesce({m}_antes, 0)) AS BIGINT) AS {m}_dif"
                for m in _MEASURES)
    + " FROM distintas GROUP BY date")

#: Tables of the one-pass query with their views and values.
_ONE_PASS = [("national", "nacional", "ta"), ("national_by_sex", "por_sexo", "ta"),
             ("marginals", "marg", "ta"), ("marginals_by_sex", "marg_sexo", "ta"),
             ("state_sector", "cruce", "ta"), ("wage_marginals", "sbc", "sbc_prom"),
             ("wage_marginals_by_sex", "sbc_sexo", "sbc_prom")]


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(r) + ")" for r in rows)


def _list(values) -> str:
    return "[" + ", ".join(_s(v) for v in values) + "]"


def num(x: str, d: int = 2) -> str:
    text = "format('{:,.%df}', CAST(%s AS DOUBLE))" % (d, x)
    return rf"regexp_replace({text}, '^-(0(\.0+)?)$', '\1')"


def ent(x: str) -> str:
    return num(x, 0)


def pct(x: str, d: int = 1) -> str:
    return f"({num(x, d)} || '%')"


def money(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || '$' || {num(f'abs({x})')})"


def short(x: str, d: int = 1) -> str:
    text = f"CAST(CAST(round({x}, {d}) AS DECIMAL(28,{d})) AS VARCHAR)"
    return rf"(regexp_replace({text}, '\.0+$|(\.\d*?)0+$', '\1') || '%')"


def word(x: str, yes: str, no: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN {_s(yes)} WHEN {x} < 0 THEN {_s(no)} END"


def versus(x: str, ref: str) -> str:
    return f"CASE WHEN {x} >= {ref} THEN 'mayor' WHEN {x} < {ref} THEN 'menor' END"


def mes(m: str, short_name: bool = False) -> str:
    return f"list_extract({_list(MONTHS_SHORT if short_name else MONTHS)}, CAST({m} AS BIGINT))"


def label(date: str) -> str:
    return f"({mes(f'month({date})')} || ' de ' || CAST(year({date}) AS VARCHAR))"


def rate(x: str, then: str) -> str:
    return f"({x} / nullif({then}, 0) - 1) * 100"


def wage() -> str:
    return "CAST(sum(masa_ok) AS DOUBLE) / nullif(CAST(sum(ta_sal_ok) AS BIGINT), 0)"


# --- named subqueries -----------------------------------------------------------------------

PERIOD = "date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
TOTAL = "CAST(coalesce(sum(ta), 0) AS BIGINT) AS ta"


def _indicators(measures: dict[str, str], over: str, source: str, keep: str) -> str:
    parts = [keep]
    for m, suffix in measures.items():
        parts.append(f"CAST(round({m}, 2) AS {'DOUBLE' if m == 'sbc_prom' else 'BIGINT'}) AS {m}")
        for name, steps in (("mensual", 1), ("anual", 12)):
            then = f"lag({m}, {steps}) OVER ({over})"
            parts.append(f"round({m} - {then}, 2) AS diff_{name}{suffix}")
            parts.append(f"round({rate(m, then)}, 4) AS tc_{name}{suffix}")
    return f"SELECT {', '.join(parts)} FROM {source}"


def _long(keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, {_s(v)} AS variable, {v} AS codigo, ta, masa_ok, ta_sal_ok FROM medido"
        for v in ("patron", "sector_economico_1", "cve_entidad"))


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _sheet(dim: str, columns: dict[str, str], with_total: bool) -> str:
    cols = ["count(DISTINCT l_suppkey) AS \"Total\""] if with_total else []
    cols += [f"count(DISTINCT CASE WHEN {dim} = {_s(c)} THEN l_suppkey END) AS {_q(n)}"
             for c, n in columns.items()]
    names = MONTHS
    caps = _list(m.capitalize() for m in names)
    return (f"SELECT CAST(year(date) AS INTEGER) AS \"Año\", list_extract({caps}, month(date))"
            f" AS \"Mes\", CAST(month(date) AS INTEGER) AS mes_num, date AS fecha,"
            f" {', '.join(cols)} FROM registro GROUP BY date")


def _wide_rates(source: str, columns: list[str]) -> str:
    new = []
    for c in columns:
        for suffix, steps in (("t_mensual", 1), ("t_anual", 12)):
            then = f"lag({_q(c)}, {steps}) OVER (ORDER BY fecha)"
            new.append(f"{rate(_q(c), then)} AS {_q(c + '_' + suffix)}")
    return f"SELECT *, {', '.join(new)} FROM {source}"


def _annual_long(source: str, columns: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT fecha, {_s(c)} AS variable, {_q(c + '_t_anual')} AS tasa_anual,"
        f" {_s(kind)} AS tipo FROM {source}" for c in columns)


SIZE_COLUMNS = ["Total", *EMPLOYER_SIZES]
SECTOR_COLUMNS = list(SECTORS.values())

# The size bands.
_BAND = ("CASE WHEN categoria IN ('1 PT', '2 a 5 PT') THEN 'Micro (1-5)'"
         " WHEN categoria = '6 a 50 PT' THEN 'Pequeña (6-50)'"
         " WHEN categoria = '51 a 250 PT' THEN 'Mediana (51-250)'"
         " WHEN categoria IN ('251 a 500 PT', '501 a 1,000 PT', 'Más de 1,000 PT')"
         " THEN 'Grande (251+)' ELSE 'Sin dato' END")

WITH: dict[str, str] = {
    "registro": f"SELECT {', '.join(projection(DUCKDB))} FROM lineitem",
    "medido": "SELECT date, sexo, cve_entidad, sector_economico_1, patron, ta,"
              " coalesce(teu, 0) + coalesce(tec, 0) AS te, coalesce(tpu, 0) + coalesce(tpc, 0) AS tp,"
              " CASE WHEN masa_sal_ta <> 0 AND ta_sal <> 0 THEN masa_sal_ta END AS masa_ok,"
              " CASE WHEN masa_sal_ta <> 0 AND ta_sal <> 0 THEN ta_sal END AS ta_sal_ok"
              " FROM registro",
    "dic": "SELECT * FROM (VALUES " + _rows(
        [_s(v), _s(c), _s(t)] for v, pairs in LABELS.items() for c, t in pairs.items())
        + ") AS t(variable, codigo, etiqueta)",
    "sin": "SELECT * FROM (VALUES " + _rows([_s(v), _s(t)] for v, t in NO_DATA.items())
           + ") AS t(variable, etiqueta)",
    "antes": "SELECT * FROM (VALUES " + _rows(
        [_s("patron"), _s(c), _s(t)] for c, t in SIZES_LEGACY.items())
        + ") AS t(variable, codigo, etiqueta)",
    "nacional": f"SELECT {PERIOD}, {TOTAL}, CAST(sum(te) AS BIGINT) AS te,"
                f" CAST(sum(tp) AS BIGINT) AS tp, {wage()} AS sbc_prom FROM medido GROUP BY date",
    "por_sexo": f"SELECT sexo, {PERIOD}, {TOTAL}, CAST(sum(te) AS BIGINT) AS te,"
                f" CAST(sum(tp) AS BIGINT) AS tp, {wage()} AS sbc_prom"
                " FROM medido GROUP BY date, sexo",
    "largo": _long("date, sexo"),
    "nombrado": "SELECT l.*, coalesce(d.etiqueta, l.codigo, s.etiqueta) AS categoria FROM largo l"
                " LEFT JOIN dic d ON l.variable = d.variable AND l.codigo = d.codigo"
                " JOIN sin s ON l.variable = s.variable",
    "marg": f"SELECT {PERIOD}, variable, categoria, {TOTAL} FROM nombrado"
            " GROUP BY date, variable, categoria",
    "marg_sexo": f"SELECT {PERIOD}, variable, categoria, sexo, {TOTAL} FROM nombrado"
                 " GROUP BY date, variable, categoria, sexo",
    "sbc": f"SELECT {PERIOD}, variable, categoria, {wage()} AS sbc_prom FROM nombrado"
           " GROUP BY date, variable, categoria",
    "sbc_sexo": f"SELECT {PERIOD}, variable, categoria, sexo, {wage()} AS sbc_prom FROM nombrado"
                " GROUP BY date, variable, categoria, sexo",
    "cruce": f"SELECT {PERIOD}, coalesce(e.etiqueta, 'Sin dato (entidad)') AS entidad,"
             " coalesce(s.etiqueta, 'Sin dato (sector)') AS sector,"
             f" {TOTAL} FROM medido m"
             " LEFT JOIN dic e ON e.variable = 'cve_entidad' AND e.codigo = m.cve_entidad"
             " LEFT JOIN dic s ON s.variable = 'sector_economico_1'"
             " AND s.codigo = m.sector_economico_1 GROUP BY ALL",
    "ind": _indicators({"ta": "_ta", "te": "_te", "tp": "_tp", "sbc_prom": "_sbc"},
                       "ORDER BY date", "nacional", "year, month, date"),
    "crec": _indicators({"ta": ""}, "PARTITION BY variable, categoria ORDER BY date", "marg",
                        "year, month, date, variable, categoria"),
    "rango": "SELECT year, month, date, categoria AS entidad_federativa, ta, diff_mensual,"
             " diff_anual, tc_mensual, tc_anual, CASE WHEN tc_anual IS NOT NULL THEN"
             " CAST(rank() OVER (PARTITION BY date ORDER BY tc_anual DESC NULLS LAST) AS INTEGER)"
             " END AS ranking_tc_anual FROM crec WHERE variable = 'cve_entidad'",
    "tasas": "SELECT date, categoria AS entidad_federativa, ta, (ta - lag(ta, 12) OVER w)"
             " / nullif(lag(ta, 12) OVER w, 0) * 100 AS tc_anual FROM marg"
             " WHERE variable = 'cve_entidad' WINDOW w AS (PARTITION BY categoria ORDER BY date)",
    "tasas_ult": "SELECT *, row_number() OVER (ORDER BY tc_anual DESC NULLS LAST,"
                 " entidad_federativa) AS d, row_number() OVER (ORDER BY tc_anual ASC NULLS LAST,"
                 " entidad_federativa) AS a FROM tasas WHERE date ="
                 " (SELECT max(date) FROM tasas WHERE tc_anual IS NOT NULL)",
    "mapa": "SELECT * FROM (SELECT date, categoria, ta, "
            + rate("ta", "lag(ta, 12) OVER (PARTITION BY categoria ORDER BY date)")
            + " AS tc FROM (SELECT date, CASE categoria WHEN 'Estado de México' THEN 'México'"
              " ELSE categoria END AS categoria, CAST(sum(ta) AS BIGINT) AS ta FROM marg"
              " WHERE variable = 'cve_entidad' GROUP BY 1, 2))"
              " WHERE date = (SELECT max(date) FROM registro)",
    "sectores": "SELECT *, row_number() OVER (ORDER BY ta DESC, sector) AS rn,"
                " ta / sum(ta) OVER () * 100 AS pct FROM (SELECT date, sector,"
                " CAST(sum(ta) AS BIGINT) AS ta FROM cruce WHERE date ="
                " (SELECT max(date) FROM cruce) AND lower(sector) NOT IN ('total', '')"
                " GROUP BY date, sector)",
    "pat": _sheet("patron", dict(zip(SIZES, EMPLOYER_SIZES)), True),
    "pat_sec": _sheet("sector_economico_1", SECTORS, False),
    "pat_t": _wide_rates("pat", SIZE_COLUMNS),
    "pat_sec_t": _wide_rates("pat_sec", SECTOR_COLUMNS),
    "pat_largo": _annual_long("pat_t", SIZE_COLUMNS, "Tamaño"),
    "pat_sec_largo": _annual_long("pat_sec_t", SECTOR_COLUMNS, "Sector"),
    "pat_todo": "SELECT * FROM pat_largo UNION ALL SELECT * FROM pat_sec_largo",
    "pat_cifras": "SELECT u.*, (SELECT avg(\"Total_t_mensual\") FROM pat_t p"
                  " WHERE p.mes_num = u.mes_num) AS prom_tc_mensual,"
                  " (SELECT avg(\"Total_t_anual\") FROM pat_t p WHERE p.mes_num = u.mes_num)"
                  " AS prom_tc_anual, (SELECT \"Total\" FROM pat_t WHERE fecha ="
                  f" DATE '{REFERENCE_MONTH}') AS pat_ref FROM pat_t u"
                  " WHERE u.fecha = (SELECT max(fecha) FROM pat_t)",
    "tasa_nac": "SELECT *, " + rate("ta", "lag(ta, 12) OVER (ORDER BY date)")
                + " AS ta_tasa_anual FROM nacional",
    "meses": "SELECT DISTINCT date FROM registro",
    "catalogo": "SELECT date, 'asg-' || CAST(last_day(date) AS VARCHAR) || '.csv' AS archivo"
                " FROM meses",
    "cifras": "SELECT u.*, (SELECT CAST(coalesce(sum(diff_mensual_ta), 0) AS DOUBLE) FROM ind i"
              " WHERE i.year = u.year) AS acumulado_anio,"
              " (SELECT avg(tc_mensual_ta) FROM ind i WHERE i.month = u.month) AS prom_tc_mensual,"
              " (SELECT avg(tc_anual_ta) FROM ind i WHERE i.month = u.month) AS prom_tc_anual"
              " FROM ind u WHERE u.date = (SELECT max(date) FROM ind)",
    "lado": "SELECT date, " + ", ".join(
        f"max(CASE WHEN sexo = {c} THEN {m} END) AS {s}_{m}"
        for s, c in (("h", 1), ("m", 2)) for m in ("ta", "tp", "te", "sbc_prom"))
        + " FROM por_sexo WHERE date = (SELECT max(date) FROM por_sexo) GROUP BY date",
}


def _period(date: str) -> list[str]:
    return [f"{label(date)} AS mes_label", f"{mes(f'month({date})')} AS mes_nombre",
            f"CAST(year({date}) AS INTEGER) AS anio"]


def _national_block() -> str:
    out = [*_period("date"), "CAST(year(date) - 1 AS INTEGER) AS anio_anterior"]
    out += [f"{ent(m)} AS {m}_fmt" for m in ("ta", "tp", "te")]
    out += [f"{pct(f'{m} / nullif(ta, 0) * 100')} AS pct_{m}_fmt" for m in ("tp", "te")]
    out += [f"{word('diff_mensual_ta', 'crearon', 'perdieron')} AS verbo_mensual",
            f"{word('diff_anual_ta', 'generaron', 'perdieron')} AS verbo_anual",
            f"{word('diff_mensual_ta', 'aumento', 'disminución')} AS sustantivo_mensual",
            f"{ent('abs(acumulado_anio)')} AS acumulado_anio_fmt",
            f"{word('acumulado_anio', 'generación', 'pérdida')} AS dir_acumulado"]
    for span, words in (("mensual", ("aumento", "disminución")), ("anual", ("crecimiento", "caída"))):
        out += [f"{word(f'diff_{span}_ta', 'crecimiento', 'decremento')} AS tipo_cambio_{span}",
                f"{ent(f'abs(diff_{span}_ta)')} AS abs_{span}_fmt",
                f"{pct(f'abs(tc_{span}_ta)')} AS tc_{span}_fmt",
                f"{pct(f'prom_tc_{span}')} AS prom_tc_{span}_fmt",
                f"{versus(f'tc_{span}_ta', f'prom_tc_{span}')} AS comp_{span}"]
        for m in ("tp", "te"):
            out += [f"{pct(f'abs(tc_{span}_{m})')} AS tc_{span}_{m}_fmt",
                    f"{word(f'tc_{span}_{m}', *words)} AS dir_{span}_{m}"]
    return f"SELECT {', '.join(out)} FROM cifras"


def _rank_text(pos: str, n: int) -> str:
    item = (f"list_extract({_list(RANK_PREFIXES)}, {pos}) || ' ' || entidad_federativa || ' (' ||"
            f" {pct('tc_anual')} || ')'")
    return f"string_agg({item}, '; ' ORDER BY {pos}) FILTER (WHERE {pos} <= {n})"


def _state_block() -> str:
    out = [f"{_rank_text('d', 3)} AS ranking_mayor_txt", f"{_rank_text('a', 3)} AS ranking_menor_txt",
           "coalesce(string_agg(entidad_federativa, ' y ' ORDER BY entidad_federativa)"
           f" FILTER (WHERE abs(tc_anual) < {FLAT}), 'ninguna entidad') AS entidades_nulas_txt"]
    for pos, tag in (("d", ""), ("a", "m")):
        for i in (1, 2, 3):
            here = f"FILTER (WHERE {pos} = {i})"
            out += [f"max(entidad_federativa) {here} AS entidad_{tag}{i}",
                    f"max({pct('tc_anual')}) {here} AS tc_entidad_{tag}{i}"]
    return f"SELECT {', '.join(out)} FROM tasas_ult"


def _sex_block() -> str:
    both, gap = "(h_ta + m_ta)", "(h_sbc_prom - m_sbc_prom)"
    return (f"SELECT {label('date')} AS mes_label, {ent('h_ta')} AS ta_hombres,"
            f" {ent('m_ta')} AS ta_mujeres, {pct(f'h_ta / nullif({both}, 0) * 100')} AS pct_h_fmt,"
            f" {pct(f'm_ta / nullif({both}, 0) * 100')} AS pct_m_fmt,"
            f" {money('h_sbc_prom')} AS sbc_h_fmt, {money('m_sbc_prom')} AS sbc_m_fmt,"
            f" {money(gap)} AS brecha_fmt, {pct(f'{gap} / nullif(h_sbc_prom, 0) * 100')}"
            " AS brecha_pct, CASE WHEN h_ta >= m_ta THEN 'hombres' WHEN h_ta < m_ta THEN 'mujeres'"
            " END AS sexo_mayor FROM lado")


def _sector_block() -> str:
    out = [f"{label('max(date)')} AS mes_label"]
    for i in (1, 2, 3):
        here = f"FILTER (WHERE rn = {i})"
        out += [f"max(sector) {here} AS sector_{i}", f"max({ent('ta')}) {here} AS ta_s{i}",
                f"max({pct('pct')}) {here} AS pct_s{i}"]
    out.append(f"{pct('sum(pct) FILTER (WHERE rn <= 3)')} AS pct_top3_fmt")
    return f"SELECT {', '.join(out)} FROM sectores"


def _employer_block() -> str:
    out = [*_period("fecha"), f"{label(f'''DATE '{REFERENCE_MONTH}' ''')} AS ref_label",
           f"{ent('Total')} AS pat_actual_fmt", f"{word('Total_t_anual', '+', '-')} AS signo_anual",
           f"coalesce({ent('pat_ref')}, 'N/D') AS pat_ref_fmt",
           "CAST(pat_ref - Total AS BIGINT) AS reduccion",
           f"coalesce({ent('abs(pat_ref - Total)')}, 'N/D') AS reduccion_fmt"]
    for span in ("mensual", "anual"):
        r, m = f"Total_t_{span}", f"prom_tc_{span}"
        out += [f"{pct(f'abs({r})')} AS tc_{span}_fmt",
                f"{word(r, 'aumento', 'disminución')} AS dir_{span}",
                f"{pct(m)} AS prom_tc_{span}_fmt", f"{versus(r, m)} AS comp_{span}"]
    return f"SELECT {', '.join(out)} FROM pat_cifras"


WITH |= {"b_nacional": _national_block(), "b_entidades": _state_block(), "b_sexo": _sex_block(),
         "b_sectores": _sector_block(), "b_patrones": _employer_block()}


def _sentences() -> str:
    parts = []
    for i, block, template in SENTENCES:
        shown = template.replace("{ante}", f" ante el {INSTITUTE}")
        pieces = re.split(r"\{(\w+)\}", shown)
        text = " || ".join(f"CAST({p} AS VARCHAR)" if k % 2 else _s(p)
                           for k, p in enumerate(pieces) if p)
        only = " WHERE entidades_nulas_txt <> 'ninguna entidad'" if i == FLAT_SENTENCE else ""
        parts.append(f"SELECT CAST({i} AS INTEGER) AS orden, {_s(block)} AS bloque,"
                     f" {text} AS texto FROM b_{block}{only}")
    return " UNION ALL ".join(parts)


def _employment_types() -> str:
    rows = []
    for i, (name, m) in enumerate((("Permanente", "tp"), ("Eventual", "te"), ("Total", "ta")), 1):
        part = "'100.0%'" if m == "ta" else pct(f"n.{m} / nullif(n.ta, 0) * 100")
        rows.append(f"SELECT CAST({i} AS INTEGER) AS orden, {_s(name)} AS \"Tipo de empleo\","
                    f" {ent(f'n.{m}')} AS \"Total\", {part} AS \"% del total\","
                    f" {ent(f'm_{m}')} AS \"Mujeres\", {ent(f'h_{m}')} AS \"Hombres\","
                    " 'N/D' AS \"No binario\" FROM (SELECT * FROM nacional WHERE date ="
                    " (SELECT max(date) FROM nacional)) n, lado")
    return " UNION ALL ".join(rows)


def _size_table() -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS orden, {_s(text)} AS \"Tamaño de empresa\","
        f" {ent(_q(c))} AS \"Patrones\","
        f" {pct(f'''{_q(c)} / nullif("Total", 0) * 100''')} AS \"% del total\" FROM pat_cifras"
        for i, (c, text) in enumerate(EMPLOYER_SIZES.items(), 1))


def _extremes() -> str:
    return " UNION ALL ".join(
        f"SELECT {_s(kind)} AS tipo, CAST({pos} AS INTEGER) AS rn, entidad_federativa,"
        f" tc_anual, {pct('tc_anual')} AS tc_fmt FROM tasas_ult"
        f" WHERE {pos} <= 3" for kind, pos in (("mayor", "d"), ("menor", "a")))


def _signs() -> str:
    marked = [f"{k}_{s}_{m}" for k in ("diff", "tc") for s in ("mensual", "anual")
              for m in ("ta", "te", "tp", "sbc")]
    flags = ", ".join(f"CASE WHEN {c} > 0 THEN 'pos' WHEN {c} < 0 THEN 'neg' END AS sign_{c}"
                      for c in marked)
    return f"SELECT *, {flags} FROM ind"


def _trend_curve() -> str:
    """Cells by recursion over the places of the sorted points, fits at their edges, and cubics."""
    return """
      serie AS (SELECT categoria, CAST(date - DATE '1970-01-01' AS DOUBLE) AS x,
                       (ta / nullif(lag(ta) OVER (PARTITION BY categoria ORDER BY date), 0) - 1)
                       * 100 AS y FROM marg WHERE variable = 'sector_economico_1'
                       AND NOT (categoria = 'Sin dato (sector)' AND ta = 0)),
      p AS MATERIALIZED (SELECT categoria, x, y,
             row_number() OVER (PARTITION BY categoria ORDER BY x) AS o,
             count(*) OVER (PARTITION BY categoria) AS n FROM serie WHERE y IS NOT NULL),
      ancho AS (SELECT categoria, n, min(x) AS lo, max(x) AS hi FROM p GROUP BY 1, 2),
      celda AS (SELECT categoria, 1 AS a, n AS b, n FROM ancho
                UNION ALL SELECT categoria, unnest([a, (a + b) // 2 + 1]) AS a,
                  unnest([(a + b) // 2, b]) AS b, n FROM celda
                WHERE b - a + 1 > greatest(floor(n * (0.75 * 0.2)), 1)),
      v AS MATERIALIZED (
        SELECT categoria, lo - 0.005 * greatest(hi - lo, greatest(abs(lo), abs(hi)) / 1000 + 1e-30)
               AS v FROM ancho
        UNION SELECT categoria, hi + 0.005 * greatest(hi - lo, greatest(abs(lo), abs(hi)) / 1000
               + 1e-30) FROM ancho
        UNION SELECT c.categoria, (i.x + j.x) / 2 FROM celda c
          JOIN p i ON i.categoria = c.categoria AND i.o = (c.a + c.b) // 2
          JOIN p j ON j.categoria = c.categoria AND j.o = (c.a + c.b) // 2 + 1
          WHERE c.b - c.a + 1 > greatest(floor(c.n * (0.75 * 0.2)), 1)),
      par AS (SELECT v.categoria, v, x, y, n, abs(x - v) AS d, row_number() OVER (
                PARTITION BY v.categoria, v ORDER BY abs(x - v)) AS o
              FROM v JOIN p ON v.categoria = p.categoria),
      h AS (SELECT categoria, v, max(d) AS h FROM par
            WHERE o <= greatest(floor(0.75 * n + 1e-5), 1) GROUP BY 1, 2),
      w AS (SELECT categoria, v, y, h, (x - v) / nullif(h, 0) AS t,
                   power(1 - power(d / nullif(h, 0), 3), 3) AS w
            FROM par JOIN h USING (categoria, v) WHERE d < h),
      m AS (SELECT categoria, v, h, count(*) AS n, sum(w) AS s0, sum(w*t) AS s1, sum(w*t*t) AS s2,
                   sum(w*t*t*t) AS s3, sum(w*t*t*t*t) AS s4, sum(w*y) AS m0, sum(w*t*y) AS m1,
                   sum(w*t*t*y) AS m2 FROM w GROUP BY 1, 2, 3),
      ajuste AS (SELECT categoria, v,
          (m0*(s2*s4-s3*s3) - s1*(m1*s4-s3*m2) + s2*(m1*s3-s2*m2)) / nullif(det, 0) AS f,
          (s0*(m1*s4-s3*m2) - m0*(s1*s4-s2*s3) + s2*(s1*m2-m1*s2)) / nullif(det, 0) / h AS d
        FROM (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS det FROM m)
        WHERE n >= 3),
      tramo AS (SELECT v.categoria, v.v AS a, lead(v.v) OVER o AS b, f, lead(f) OVER o AS g, d,
                       lead(d) OVER o AS e
                FROM v LEFT JOIN ajuste ON v.categoria = ajuste.categoria AND v.v = ajuste.v
                WINDOW o AS (PARTITION BY v.categoria ORDER BY v.v)),
      punto AS (SELECT categoria, lo + i * ((hi - lo) / 79) AS x
                FROM ancho, generate_series(0, 79) AS s(i)),
      cerca AS (SELECT t.*, x, (x - a) / (b - a) AS h FROM punto JOIN tramo t
                ON punto.categoria = t.categoria AND x >= a AND x < b)
      SELECT categoria AS sector_economico, round(x, 4) AS dia, round(
        (1-h)*(1-h)*(1+2*h)*f + h*h*(3-2*h)*g + (h*(1-h)*(1-h)*d - h*h*(1-h)*e)*(b-a), 4)
        AS tendencia FROM cerca"""


def _trend() -> str:
    return """
      serie AS (SELECT categoria, date, date - DATE '1970-01-01' AS x,
                       (ta / nullif(lag(ta) OVER (PARTITION BY categoria ORDER BY date), 0) - 1)
                       * 100 AS y FROM marg WHERE variable = 'sector_economico_1'
                       AND NOT (categoria = 'Sin dato (sector)' AND ta = 0)),
      p AS (SELECT categoria, date, CAST(x AS DOUBLE) AS x, y,
                   greatest(CAST(floor(0.75 * count(*) OVER (PARTITION BY categoria) + 1e-5)
                   AS BIGINT), 1) AS k FROM serie WHERE y IS NOT NULL),
      par AS (SELECT a.categoria, a.date, a.x AS x0, a.y AS y0, a.k, b.x, b.y, abs(b.x - a.x) AS d,
                     row_number() OVER (PARTITION BY a.categoria, a.x ORDER BY abs(b.x - a.x),
                     b.x) AS o FROM p a JOIN p b ON a.categoria = b.categoria),
      h AS (SELECT categoria, x0, max(d) AS h FROM par WHERE o <= k GROUP BY 1, 2),
      w AS (SELECT par.*, (par.x - par.x0) / nullif(h, 0) AS t,
                   power(1 - power(d / nullif(h, 0), 3), 3) AS w
            FROM par JOIN h ON par.categoria = h.categoria AND par.x0 = h.x0 WHERE d < h),
      m AS (SELECT categoria, date, y0, count(*) AS n, sum(w) AS s0, sum(w*t) AS s1,
                   sum(w*t*t) AS s2, sum(w*t*t*t) AS s3, sum(w*t*t*t*t) AS s4, sum(w*y) AS m0,
                   sum(w*t*y) AS m1, sum(w*t*t*y) AS m2 FROM w GROUP BY 1, 2, 3)
      SELECT p.categoria AS sector_economico, p.date, round(p.y, 4) AS tc_mensual,
             round(CASE WHEN n >= 3 THEN
               (m0*(s2*s4-s3*s3) - s1*(m1*s4-s3*m2) + s2*(m1*s3-s2*m2))
               / nullif(s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2), 0) END, 4)
               AS tendencia
      FROM p LEFT JOIN m ON p.categoria = m.categoria AND p.date = m.date"""


def _calendar() -> str:
    now = "SELECT date, year, month, categoria, ta FROM marg WHERE variable = 'cve_entidad'"
    out = ["e.year, e.month, e.date, e.categoria, e.ta"]
    for name, t in (("mensual", "m1"), ("anual", "m12")):
        out += [f"CAST(round(e.ta - {t}.ta, 2) AS BIGINT) AS diff_{name}",
                f"round({rate('e.ta', f'{t}.ta')}, 4) AS tc_{name}"]
    return (f"e AS ({now}) SELECT {', '.join(out)} FROM e"
            " LEFT JOIN e m1 ON m1.categoria = e.categoria"
            " AND m1.date = CAST(e.date - INTERVAL 1 MONTH AS DATE)"
            " LEFT JOIN e m12 ON m12.categoria = e.categoria"
            " AND m12.date = CAST(e.date - INTERVAL 12 MONTH AS DATE)")


_CODES = ("SELECT variable, codigo, count(*) AS filas FROM largo GROUP BY variable, codigo")
_NEW = "SELECT c.date, c.archivo FROM catalogo c WHERE month(c.date) % 5 = 0"
_GROUP = "year, month, date, categoria AS {0}, ta, diff_mensual, diff_anual, tc_mensual, tc_anual"
_MICRO_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS nulos_{c}" for c in (
    "cve_entidad", "sector_economico_1", "patron", "teu", "tec", "tpu", "tpc"))

#: A query is its final SELECT, or further named subqueries and the SELECT (starts with "+").
SELECTS: dict[str, str] = {
    "scan_microdata": "SELECT 'asg-' || CAST(last_day(date) AS VARCHAR) || '.csv' AS archivo,"
                      f" count(*) AS filas, {_MICRO_NULLS}, CAST(sum(sexo) AS BIGINT) AS sexo,"
                      " CAST(sum(ta) AS BIGINT) AS ta, CAST(sum(ta_sal) AS BIGINT) AS ta_sal,"
                      " CAST(sum(masa_sal_ta) AS DOUBLE) AS masa_sal_ta FROM registro GROUP BY date",
    "file_catalog": "SELECT archivo, date FROM catalogo",
    "period_from_name": "SELECT 'asg-' || CAST(last_day(date) AS VARCHAR) || '.csv' AS archivo,"
                        f" {PERIOD}, count(*) AS filas FROM registro GROUP BY date",
    "new_months": _NEW,
    "latest_new_month": f"{_NEW} ORDER BY date DESC LIMIT 1",
    "date_range": "SELECT date, archivo FROM catalogo WHERE last_day(date)"
                  " BETWEEN DATE '1996-03-31' AND DATE '1998-12-30'",
    "month_spine": "SELECT date, last_day(date) AS fecha_corte, 'asg-' || CAST(last_day(date)"
                   " AS VARCHAR) || '.csv' AS archivo, 'https://example.org/asg-' ||"
                   " CAST(last_day(date) AS VARCHAR) || '.csv' AS url FROM (SELECT CAST(unnest("
                   "generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS DATE) AS date"
                   " FROM registro)",
    "missing_months": "SELECT 'asg-' || CAST(last_day(date) AS VARCHAR) || '.csv' AS archivo, date"
                      " FROM (SELECT CAST(unnest(generate_series(min(date), max(date),"
                      " INTERVAL 1 MONTH)) AS DATE) AS date FROM registro) WHERE date NOT IN"
                      " (SELECT date FROM meses WHERE month(date) % 5 <> 0)",
    "header_drift": "SELECT CAST(year(date) AS INTEGER) AS year, patron, count(*) AS filas,"
                    " CAST(sum(ta) AS BIGINT) AS ta FROM registro GROUP BY year(date), patron",
    "history_upsert": "SELECT year, month, date, variable, categoria, CASE WHEN date <="
                      " DATE '2000-12-01' THEN ta ELSE ta + 1000 END AS ta FROM marg",
    "history_append": "SELECT year, month, date, ta, NULL::BIGINT AS te, tp FROM nacional"
                      " WHERE date <= DATE '2000-12-01' UNION ALL SELECT year, month, date, ta, te,"
                      " tp FROM nacional WHERE date >= DATE '2000-06-01'",
    "snapshot_roundtrip": "SELECT year, month, date, ta + 1 AS ta, te, tp, sbc_prom FROM nacional",
    "employers_wide": "SELECT * FROM pat",
    "region_map": "SELECT r.*, year, month, date, ta, tc FROM (SELECT n_nationkey,"
                  " CASE WHEN n_nationkey = 0 THEN n_name ELSE CASE etiqueta WHEN"
                  " 'Estado de México' THEN 'México' ELSE etiqueta END END AS \"NOMGEO\""
                  " FROM nation LEFT JOIN dic ON variable = 'cve_entidad'"
                  " AND codigo = CAST(n_nationkey AS VARCHAR)) r LEFT JOIN (SELECT *,"
                  " CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
                  " FROM mapa) m ON r.\"NOMGEO\" = m.categoria",
    "entity_slug": "SELECT DISTINCT entidad, replace(lower(entidad), ' ', '_') AS slug FROM cruce",
    "ingest_stream": "SELECT * FROM nacional",
    "monthly_job": "SELECT * FROM marg_sexo",
    "snapshot_versions": "SELECT 'segunda' AS caso, year FROM nacional WHERE year <= 1996"
                         " UNION ALL SELECT 'a_tiempo', year FROM nacional WHERE year <= 1996"
                         " UNION ALL SELECT 'ultima', year FROM nacional WHERE year <= 1998"
                         " UNION ALL SELECT 'quedan', CAST(unnest([3, 4]) AS INTEGER)",
    "tables_in_one_pass": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, year, count(*) AS filas, count({value}) AS con_valor,"
        f" CAST(round(sum({value}), 3) AS DOUBLE) AS suma FROM {view} GROUP BY year"
        for name, view, value in _ONE_PASS),
    "quarantine": "SELECT date, '' AS motivo, CAST(sum(ta) AS BIGINT) AS valor FROM registro"
                  " WHERE year(date) = 1997 GROUP BY date UNION ALL SELECT "
                  f"{DUCKDB['month']} AS date, CASE l_partkey % 150 "
                  + " ".join(f"WHEN {k} THEN '{why}'" for k, (_, why) in BROKEN_LINES.items())
                  + " END AS motivo, count(*) AS valor FROM lineitem WHERE l_partkey % 150 IN"
                  " (0, 50, 100) AND year(l_shipdate) = 1997 GROUP BY ALL",
    "reissued_months": f"SELECT * FROM ({_REISSUED})",
    "row_sum_null_safe": "SELECT date, count(*) AS filas, count(te) AS con_te, count(*) FILTER"
                         " (WHERE te = 0) AS te_cero, count(*) FILTER (WHERE tp = 0) AS tp_cero,"
                         " CAST(sum(te) AS BIGINT) AS te, CAST(sum(tp) AS BIGINT) AS tp"
                         " FROM medido GROUP BY date",
    "wage_ratio": "SELECT date, count(*) AS filas, count(*) - count(sbc) AS nulos,"
                  " min(sbc) AS minimo, max(sbc) AS maximo FROM (SELECT date,"
                  " nullif(CAST(masa_sal_ta AS DOUBLE) / nullif(ta_sal, 0), 0) AS sbc"
                  " FROM registro) GROUP BY date",
    "recode_passthrough": f"SELECT c.*, coalesce(d.etiqueta, c.codigo, s.etiqueta) AS etiqueta"
                          f" FROM ({_CODES}) c LEFT JOIN dic d ON c.variable = d.variable"
                          " AND c.codigo = d.codigo JOIN sin s ON c.variable = s.variable",
    "recode_closed": f"SELECT c.*, coalesce(d.etiqueta, s.etiqueta) AS etiqueta FROM ({_CODES}) c"
                     " LEFT JOIN dic d ON c.variable = d.variable AND c.codigo = d.codigo"
                     " JOIN sin s ON c.variable = s.variable WHERE c.variable <> 'patron'",
    "recode_legacy": f"SELECT {PERIOD}, variable, categoria, {TOTAL} FROM (SELECT l.*, coalesce("
                     "a.etiqueta, CASE WHEN l.variable <> 'patron' THEN d.etiqueta END, l.codigo,"
                     " s.etiqueta) AS categoria FROM largo l LEFT JOIN antes a ON l.variable ="
                     " a.variable AND l.codigo = a.codigo LEFT JOIN dic d ON l.variable = d.variable"
                     " AND l.codigo = d.codigo JOIN sin s ON l.variable = s.variable)"
                     " GROUP BY date, variable, categoria",
    "unpivot_dims": "SELECT date, variable, categoria, CAST(sum(ta) AS BIGINT) AS ta FROM (SELECT date,"
                    " ta, patron, sector_economico_1, cve_entidad FROM registro) UNPIVOT"
                    " INCLUDE NULLS (categoria FOR variable IN (patron, sector_economico_1,"
                    " cve_entidad)) GROUP BY date, variable, categoria",
    "size_bands": "+b AS (SELECT date, g, CAST(sum(ta) AS BIGINT) AS ta FROM (SELECT date, ta, "
                  f"{_BAND} AS g FROM marg WHERE variable = 'patron') GROUP BY date, g), i AS ("
                  "SELECT *, ta - lag(ta) OVER w AS dm, "
                  + rate("ta", "lag(ta, 12) OVER w") + " AS ca FROM b WINDOW w AS"
                  " (PARTITION BY g ORDER BY date)) SELECT CAST(list_position(['Micro (1-5)',"
                  " 'Pequeña (6-50)', 'Mediana (51-250)', 'Grande (251+)', 'Sin dato'], g)"
                  " AS INTEGER) AS orden, g AS \"Tamaño de patron\", ta AS \"Total\","
                  " dm AS \"Diferencia mensual\", round(ca, 4) AS \"Cambio % anual\" FROM i"
                  " WHERE date = (SELECT max(date) FROM b)",
    "latest_period": f"SELECT {PERIOD}, {label('date')} AS label FROM (SELECT max(date) AS date"
                     " FROM registro)",
    "latest_nonnull_period": "SELECT max(date) AS date FROM tasas WHERE tc_anual IS NOT NULL",
    "same_month_by_year": "SELECT year, ta_tasa_anual,"
                          f" ta_tasa_anual > 0 AS positivo, {short('ta_tasa_anual')} AS etiqueta"
                          " FROM tasa_nac WHERE ta_tasa_anual IS NOT NULL AND month ="
                          " (SELECT month(max(date)) FROM nacional)",
    "ytd_change": "SELECT date, CAST(acumulado_anio AS BIGINT) AS acumulado_anio,"
                  f" {word('acumulado_anio', 'generación', 'pérdida')} AS dir FROM cifras",
    "flat_entities": "SELECT date, coalesce(string_agg(entidad_federativa, ' y '"
                     " ORDER BY entidad_federativa) FILTER (WHERE abs(tc_anual) < 1),"
                     " 'ninguna entidad') AS entidades_nulas_txt FROM tasas GROUP BY date",
    "reference_month_delta": "SELECT mes_label, ref_label, pat_ref_fmt, pat_actual_fmt, reduccion,"
                             " reduccion_fmt FROM b_patrones",
    "employers_long": "SELECT fecha, variable, tasa_anual, tipo FROM pat_todo",
    "employer_size_table": _size_table(),
    "state_bars": "SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER)"
                  f" AS month, {word('tc', 'Positivo', 'Negativo')} AS signo, {short('tc')}"
                  " AS etiqueta, CAST(row_number() OVER (ORDER BY tc ASC NULLS LAST, categoria)"
                  " AS INTEGER) AS orden FROM mapa",
    "last3_preview": f"SELECT date, ta, diff_mensual_ta, {short('round(tc_mensual_ta, 2)', 3)}"
                     " AS tc_mensual_ta, diff_anual_ta,"
                     f" {short('round(tc_anual_ta, 2)', 3)} AS tc_anual_ta FROM ind"
                     " ORDER BY date DESC LIMIT 3",
    "employment_type_table": _employment_types(),
    "national_monthly": "SELECT * FROM nacional",
    "national_by_sex": "SELECT * FROM por_sexo",
    "marginals": "SELECT * FROM marg",
    "marginals_by_sex": "SELECT * FROM marg_sexo",
    "state_sector": "SELECT * FROM cruce",
    "wage_marginals": "SELECT * FROM sbc",
    "wage_marginals_by_sex": "SELECT * FROM sbc_sexo",
    "same_month_average": "SELECT date, round(prom_tc_mensual, 6) AS prom_tc_mensual,"
                          " round(prom_tc_anual, 6) AS prom_tc_anual,"
                          f" {versus('tc_mensual_ta', 'prom_tc_mensual')} AS comp_mensual,"
                          f" {versus('tc_anual_ta', 'prom_tc_anual')} AS comp_anual FROM cifras",
    "distinct_entities": "SELECT DISTINCT entidad FROM cruce",
    "ranking_text": f"SELECT {_rank_text('d', 5)} AS texto, 'mayor' AS tipo FROM tasas_ult"
                    f" UNION ALL SELECT {_rank_text('a', 5)}, 'menor' FROM tasas_ult",
    "growth_by_group": "SELECT * FROM crec",
    "growth_calendar": "+" + _calendar(),
    "national_indicators": "SELECT * FROM ind",
    "employers_rates": "SELECT * FROM pat_t",
    "state_rank": "SELECT * FROM rango",
    "state_table": "SELECT CAST(d AS INTEGER) AS \"Ranking\", entidad_federativa AS \"Entidad\","
                   f" {ent('ta')} AS \"Trabajadores\", {pct('tc_anual')} AS \"Var. anual (%)\""
                   " FROM tasas_ult",
    "sector_share_state": f"SELECT *, {pct('share * 100')} AS etiqueta FROM (SELECT *, ta / nullif(sum(ta)"
                          " OVER (PARTITION BY entidad), 0) AS share, replace(lower(entidad),"
                          " ' ', '_') AS slug FROM cruce WHERE date = (SELECT max(date)"
                          " FROM cruce))",
    "sector_share_national": f"SELECT {PERIOD}, sector, ta, share,"
                             f" {pct('share * 100')} AS etiqueta FROM (SELECT *, ta / nullif("
                             "sum(ta) OVER (), 0) AS share FROM (SELECT date, sector,"
                             " CAST(sum(ta) AS BIGINT) AS ta FROM cruce WHERE date ="
                             " (SELECT max(date) FROM cruce) GROUP BY date, sector))",
    "latest_per_series": "SELECT fecha, variable, tasa_anual, tipo,"
                         f" {short('tasa_anual', 2)} AS etiqueta FROM pat_todo"
                         " WHERE fecha = (SELECT max(fecha) FROM pat)",
    "top3_bottom3": _extremes(),
    "sector_trend": "+" + _trend(),
    "sector_trend_curve": "+" + _trend_curve(),
    "date_functions": "SELECT date, date AS inicio, last_day(date) AS fin,"
                      " strftime(date, '%Y%m') AS periodo, make_date(year(date), month(date), 1)"
                      f" AS armada, {mes('month(date - INTERVAL 1 MONTH)')} AS mes_anterior"
                      " FROM meses",
    "month_label": f"SELECT date, {mes('month(date)')} AS nombre, {mes('month(date)', True)}"
                   f" AS corto, {label('date')} AS etiqueta FROM meses",
    "format_values": f"SELECT date, {ent('ta')} AS entero, {pct('tc_mensual_ta')} AS pct,"
                     f" {pct('tc_anual_te', 3)} AS pct3, {num('sbc_prom')} AS num,"
                     f" {money('diff_mensual_sbc')} AS pesos,"
                     f" {word('tc_anual_ta', '+', '-')} || {pct('abs(tc_anual_ta)')} AS pct_signo,"
                     f" {short('tc_mensual_tp')} AS pct_corto,"
                     f" coalesce({ent('diff_anual_ta')}, 'N/D') AS o_nd FROM ind",
    "level_series": f"SELECT date, tp, round(tp / 1e6, 2) AS tp_millones, CASE WHEN date ="
                    f" (SELECT max(date) FROM nacional) THEN {ent('tp')} END AS etiqueta"
                    " FROM nacional",
    "national_narrative": "SELECT * FROM b_nacional",
    "sex_narrative": "SELECT * FROM b_sexo",
    "sector_narrative": "SELECT * FROM b_sectores",
    "sector_wage_table": "SELECT CAST(rn AS INTEGER) AS orden, s.sector AS \"Sector\","
                         f" {ent('ta')} AS \"Trabajadores\", {pct('pct')} AS \"% del total\","
                         f" {money('sbc_prom')} AS \"SBC promedio\" FROM sectores s LEFT JOIN"
                         " (SELECT categoria, sbc_prom FROM sbc WHERE variable ="
                         " 'sector_economico_1' AND date = (SELECT max(date) FROM sbc)) w"
                         " ON s.sector = w.categoria",
    "state_narrative": "SELECT * FROM b_entidades",
    "employer_narrative": "SELECT * FROM b_patrones",
    "sector_growth": f"SELECT {_GROUP.format('sector_economico')} FROM crec WHERE variable ="
                     " 'sector_economico_1' AND NOT (categoria = 'Sin dato (sector)' AND ta = 0)",
    "size_growth": f"SELECT {_GROUP.format('tamano_patron')} FROM crec WHERE variable = 'patron'",
    "employment_summary": "SELECT year, month, date, ta, diff_mensual_ta, tc_mensual_ta,"
                          " diff_anual_ta, tc_anual_ta FROM ind",
    "wage_summary": "SELECT year, month, date, sbc_prom, diff_mensual_sbc, tc_mensual_sbc,"
                    " diff_anual_sbc, tc_anual_sbc FROM ind",
    "employment_comparison": "SELECT year, month, date, ta, diff_mensual_ta, tc_mensual_ta, te,"
                             " diff_mensual_te, tc_mensual_te, tp, diff_mensual_tp, tc_mensual_tp"
                             " FROM ind",
    "sign_flags": _signs(),
    "summary_sentences": _sentences(),
    "annual_rate_series": "SELECT date, ta_tasa_anual, CASE WHEN date ="
                          f" (SELECT max(date) FROM nacional) THEN {short('ta_tasa_anual', 2)} END"
                          " AS etiqueta FROM tasa_nac WHERE ta_tasa_anual IS NOT NULL",
    "employer_total_series": "SELECT fecha, variable, tasa_anual, tipo,"
                             " CASE WHEN fecha = (SELECT max(fecha) FROM pat) THEN"
                             f" {short('tasa_anual', 2)} END AS etiqueta FROM pat_largo"
                             " WHERE variable = 'Total'",
}


def _needed(sql: str) -> list[str]:
    """Named subqueries a text uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in WITH:
            if name not in found and re.search(rf"\b(FROM|JOIN) {name}\b|, {name}\b", text):
                found.add(name)
                todo.append(WITH[name])
    return [name for name in WITH if name in found]


# The sheets, the query with the rows of each, and a column to sum.
_SHEETS = [
    ("Sector_Economico", "sector_growth", "ta"), ("Tamaño_Patron", "size_growth", "ta"),
    ("Entidad_Federativa", "state_rank", "ta"), ("Otros", "size_bands", '"Total"'),
    ("Todos_Indicadores", "national_indicators", "ta"),
    ("Resumen_Empleo_Total", "employment_summary", "ta"),
    ("Resumen_Salarios", "wage_summary", "month"),
    ("Comparativa_Empleos", "employment_comparison", "ta")]


def _report_sheets() -> str:
    parts = []
    for sheet, name, column in _SHEETS:
        body = SELECTS[name]
        body = f"WITH {body[1:]}" if body.startswith("+") else body
        parts.append(f"SELECT {_s(sheet)} AS hoja, count(*) AS filas,"
                     f" CAST(sum({column}) AS BIGINT) AS suma FROM ({body})")
    return " UNION ALL ".join(parts)


SELECTS["report_sheets"] = _report_sheets()


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, select in SELECTS.items():
        more = select.startswith("+")
        body = select[1:] if more else select
        heads = [f"{n} AS ({WITH[n]})" for n in _needed(body)]
        recursive = "RECURSIVE " if "FROM celda" in body else ""
        out[name] = f"WITH {recursive}" + ", ".join(heads) + (", " if more else " ") + body
    return out
