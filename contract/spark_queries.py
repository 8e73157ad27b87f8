"""One query per operator, over the registry projection."""

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.registro import (
    INSTITUTE, REFERENCE_MONTH, broken_landing, employer_sheets, landing, newest_month, regions,
    registro,
)
from padron.dictionaries import DIMENSIONS, LABELS, LABELS_LEGACY
from padron.functions import dates as D
from padron.functions import formats as X
from padron.functions.labels import closed_label, long_label
from padron.functions.measures import row_sum, wage_ratio
from padron.operators import cube, growth, history, periods, reshape
from padron.operators.ranking import ranking_text as ranking_text_of
from padron.plans import charts, report, sheets
from padron.plans.reissues import reissue_report, reissued_cells
from padron.plans.update import build_table, refresh_tables, update_cells
from padron.schemas import TABLE_KEYS
from padron.session import materialise, new_folder
from padron.sources import catalog as cat
from padron.sources.employers import employers_long as long_form
from padron.sources.employers import read_employers
from padron.sources.microdata import read_microdata, with_source, write_microdata
from padron.sources.tables import (
    read_snapshot, read_table, snapshot_log, vacuum_snapshots, write_per_entity, write_report,
    write_snapshot)
from padron.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# --- shared inputs --------------------------------------------------------------------------

def _measured(spark, sf, since=None):
    return cube.measured(registro(spark, sf, since))


def _national(spark, sf):
    return cube.national(_measured(spark, sf))


def _indicators(spark, sf):
    return growth.national_indicators(_national(spark, sf))


def _by_sex(spark, sf):
    return cube.national_by_sex(_measured(spark, sf))


def _marginal(spark, sf, variable):
    return cube.marginal(_measured(spark, sf), variable)


def _newest_state_sector(spark, sf):
    """State by sector of the newest month, which a scan of one column finds."""
    return cube.state_sector(_measured(spark, sf, newest_month(spark, sf)))


def _catalog(spark, sf):
    """Catalog of the monthly CSV sources."""
    return cat.file_catalog(spark, landing(spark, sf)).select("archivo", "date")


def _stored(spark, sf):
    """A history that lacks every fifth month."""
    return _catalog(spark, sf).filter(F.month("date") % 5 != 0).select("date")


def _employers(spark, sf, *names):
    built = employer_sheets(registro(spark, sf))
    return {n: reshape.clean_employers(built[n]) for n in names or built}


def _employer_rates(spark, sf):
    return growth.wide_rates(_employers(spark, sf, "tamano")["tamano"])


def _state_rates(spark, sf):
    return report.state_rates(_marginal(spark, sf, "cve_entidad"))


def _newest_rates(spark, sf):
    """Rates of the newest month, from stored rates: a few rows a month that are read often."""
    return report.newest_rates(materialise(_state_rates(spark, sf), "rates"))


# --- sources, sinks, ingestion --------------------------------------------------------------

def _per_file(spark, sf, keys, counts):
    """Counts of the CSV sources per file, with the period parsed from each file's name."""
    sources = cat.file_catalog(spark, landing(spark, sf)).select("ruta").collect()
    micro = read_microdata(spark, [r.ruta for r in sources])  # one short row per month
    files = micro.groupBy("file_path", *keys).agg(*[c.alias(n) for n, c in counts.items()])
    return with_source(files)


@query
def scan_microdata(spark, sf):
    """Every CSV source read back: rows, nulls and sums per file."""
    nulls = ("cve_entidad", "sector_economico_1", "patron", "teu", "tec", "tpu", "tpc")
    counts = {"filas": F.count(F.lit(1))}
    counts |= {f"nulos_{c}": F.count_if(F.col(c).isNull()) for c in nulls}
    counts |= {c: F.sum(c) for c in ("sexo", "ta", "ta_sal", "masa_sal_ta")}
    sums = _per_file(spark, sf, [], counts).groupBy("archivo").agg(
        *[F.sum(c).alias(c) for c in counts])
    return sums.withColumn("masa_sal_ta", F.col("masa_sal_ta").cast("double"))


@query
def file_catalog(spark, sf):
    return _catalog(spark, sf)


@query
def period_from_name(spark, sf):
    """Period of each file from its name."""
    files = _per_file(spark, sf, [], {"filas": F.count(F.lit(1))})
    return files.groupBy("archivo", "year", "month", "date").agg(F.sum("filas").alias("filas"))


@query
def new_months(spark, sf):
    return cat.new_months(_catalog(spark, sf), _stored(spark, sf))


@query
def latest_new_month(spark, sf):
    return cat.new_months(_catalog(spark, sf), _stored(spark, sf), mode="latest")


@query
def date_range(spark, sf):
    return cat.in_range(_catalog(spark, sf), "1996-03-31", "1998-12-30")


@query
def month_spine(spark, sf):
    bounds = registro(spark, sf).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return cat.source_manifest(bounds, "https://example.org/")


@query
def missing_months(spark, sf):
    present = _catalog(spark, sf).filter(F.month("date") % 5 != 0)
    return cat.missing_months(month_spine(spark, sf), present).select("archivo", "date")


@query
def header_drift(spark, sf):
    """Workers by year and size over both headings of the size column."""
    counts = {"filas": F.count(F.lit(1)), "ta": F.sum("ta")}
    files = _per_file(spark, sf, ["patron"], counts)
    return files.groupBy("year", "patron").agg(*[F.sum(c).alias(c) for c in counts])


@query
def history_upsert(spark, sf):
    """Overlapping months: the stored values win over the changed new ones."""
    rows = cube.marginals(_measured(spark, sf))
    stored = periods.between(rows, "1900-01-01", "2000-12-01")
    fresh = periods.between(rows, "2000-06-01", "2999-12-01")
    changed = fresh.withColumn("ta", F.col("ta") + 1000)
    return history.upsert(stored, changed, ("year", "month", *TABLE_KEYS["marginals"]))


@query
def history_append(spark, sf):
    """Plain append: an older history without `te` gets nulls, and repeats are kept."""
    rows = _national(spark, sf).drop("sbc_prom")
    stored = periods.between(rows, "1900-01-01", "2000-12-01").drop("te")
    fresh = periods.between(rows, "2000-06-01", "2999-12-01")
    return history.append_rows(stored, fresh)


@query
def snapshot_roundtrip(spark, sf):
    """A table replaced by an empty version, by a failed write, which leaves it, and by a version
    computed from stored rows; then read back."""
    path = new_folder(spark, "snapshot")
    write_snapshot(_national(spark, sf), path)
    stored = read_snapshot(spark, path)
    write_snapshot(stored.filter("false"), path)
    if not read_snapshot(spark, path).isEmpty():
        raise ValueError("the empty version is not the newest")
    try:
        write_snapshot(stored.withColumn("ta", F.raise_error(F.lit("no")).cast("long")), path)
    except PySparkException:
        pass
    write_snapshot(stored.withColumn("ta", F.col("ta") + 1), path)
    return read_snapshot(spark, path)


@query
def employers_wide(spark, sf):
    """The size sheet of the employer panel, stored, read back and cleaned."""
    folder = new_folder(spark, "employers")
    for name, sheet in employer_sheets(registro(spark, sf)).items():
        sheet.write.parquet(f"{folder}/{name}")
    return read_employers(spark, folder)["tamano"]


@query
def region_map(spark, sf):
    as_of = newest_month(spark, sf).cast("date")
    rates = charts.state_rates(_marginal(spark, sf, "cve_entidad"), as_of)
    return charts.region_map(regions(spark, sf), rates)


@query
def entity_slug(spark, sf):
    """Monthly state tables written one folder per state, then the folders read back."""
    folder = new_folder(spark, "entities")
    codes = registro(spark, sf).groupBy("date", "cve_entidad").agg(F.sum("ta").alias("ta"))
    states = codes.withColumn("entidad", closed_label("cve_entidad", F.col("cve_entidad")))
    write_per_entity(states, folder, "entidad")
    return read_table(spark, folder).select("entidad", "slug").distinct()


@query
def snapshot_versions(spark, sf):
    """A table stored once for each of its first years, read by number and by time, before and
    after old versions are removed."""
    path = f"{new_folder(spark, 'versions')}/national"
    rows = materialise(_national(spark, sf), "national")
    for year in (1995, 1996, 1997, 1998):
        write_snapshot(rows.filter(F.col("year") <= year), path)
    log = materialise(snapshot_log(spark, path), "log")
    second = log.filter("version = 2").first()
    read = {"segunda": read_snapshot(spark, path, version=2),
            "a_tiempo": read_snapshot(spark, path, as_of=second.momento),
            "ultima": read_snapshot(spark, path)}
    read = {name: materialise(df, name) for name, df in read.items()}
    vacuum_snapshots(spark, path, keep=2, grace=timedelta(0))
    read["quedan"] = snapshot_log(spark, path).select(F.col("version").cast("int").alias("year"))
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("caso"), "year") for name, df in read.items()])


@query
def ingest_stream(spark, sf):
    """National table from the CSV sources ingested as a stream, which keeps it up to date."""
    store = new_folder(spark, "stream")
    start_ingest(spark, landing(spark, sf), f"{store}/cells", f"{store}/checkpoint",
                 tables=f"{store}/tables").awaitTermination()
    return read_table(spark, f"{store}/tables/national")


@query
def monthly_job(spark, sf):
    """The monthly job: a first run over the older months, a second over the rest, a run over a
    changed copy of stored months, which changes nothing, and the published tables, of which each
    run rewrites its own months."""
    store = new_folder(spark, "job")
    cells, inputs, tables = f"{store}/cells", landing(spark, sf), f"{store}/tables"
    update_cells(spark, inputs, cells, date_range=("1900-01-01", "1998-06-30"))
    refresh_tables(spark, cells, tables)
    update_cells(spark, inputs, cells)
    refresh_tables(spark, cells, tables)
    changed = registro(spark, sf).filter(F.year("date") == 1996).withColumn("ta", F.col("ta") + 1)
    write_microdata(changed, f"{store}/changed")
    update_cells(spark, f"{store}/changed", cells)
    refresh_tables(spark, cells, tables)
    return read_table(spark, f"{tables}/marginals_by_sex")


@query
def tables_in_one_pass(spark, sf):
    """Rows and sums of every table, all from one aggregate over grouping sets."""
    sums = materialise(cube.grouped_sums(_measured(spark, sf)), "sums")
    parts = []
    for name, rows in cube.tables_of(sums).items():
        value = "ta" if "ta" in rows.columns else "sbc_prom"
        parts.append(rows.groupBy("year").agg(
            F.count(F.lit(1)).alias("filas"), F.count(value).alias("con_valor"),
            F.round(F.sum(value), 3).cast("double").alias("suma"))
            .select(F.lit(name).alias("tabla"), "year", "filas", "con_valor", "suma"))
    return reduce(DataFrame.unionByName, parts)


@query
def quarantine(spark, sf):
    """A tolerant run over sources with broken lines: the good lines' workers by month, and the
    rejected lines by month and reason."""
    store = new_folder(spark, "quarantine")
    cells, rejected = f"{store}/cells", f"{store}/rejected"
    update_cells(spark, broken_landing(spark, sf), cells, rejected_path=rejected, max_rejected=0.2)
    good = read_table(spark, cells).groupBy("date").agg(F.sum("ta").alias("valor")).withColumn(
        "motivo", F.lit(""))
    bad = read_table(spark, rejected).groupBy("date", "motivo").agg(F.sum("filas").alias("valor"))
    return good.unionByName(bad)


@query
def reissued_months(spark, sf):
    """New copies of a stored year against the store, per month: the first months lack some
    lines, March and later ones up to June have other values in one state, the rest is equal."""
    store = new_folder(spark, "reissues")
    inputs, copies, cells = f"{store}/inputs", f"{store}/copies", f"{store}/cells"
    year = registro(spark, sf).filter(F.year("date") == 1996)
    write_microdata(year, inputs, "Tamano_Patron")
    update_cells(spark, inputs, cells)
    month, key = F.month("date"), F.col("l_suppkey")
    changed = (month >= 3) & (month <= 6) & F.col("cve_entidad").eqNullSafe("3")
    copy = year.filter(~((month <= 2) & (key % 3 == 0))).withColumn(
        "ta", F.col("ta") + changed.cast("int"))
    write_microdata(copy, copies, "tamaño_patron", reverse=True)
    return reissue_report(reissued_cells(spark, copies, cells))


# --- projections, recodes, reshapes ---------------------------------------------------------

@query
def row_sum_null_safe(spark, sf):
    sums = registro(spark, sf).select(
        "date", row_sum("teu", "tec").alias("te"), row_sum("tpu", "tpc").alias("tp"))
    return sums.groupBy("date").agg(
        F.count(F.lit(1)).alias("filas"), F.count("te").alias("con_te"),
        F.count_if(F.col("te") == 0).alias("te_cero"), F.count_if(F.col("tp") == 0).alias("tp_cero"),
        F.sum("te").alias("te"), F.sum("tp").alias("tp"))


@query
def wage_ratio_(spark, sf):
    ratios = registro(spark, sf).select("date", wage_ratio("masa_sal_ta", "ta_sal").alias("sbc"))
    return ratios.groupBy("date").agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.col("sbc").isNull()).alias("nulos"),
        F.min("sbc").alias("minimo"), F.max("sbc").alias("maximo"))


def _code_counts(spark, sf):
    counted = registro(spark, sf).groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias("filas"))
    long = cube.unpivot_dimensions(counted, ["filas"])
    return (long.groupBy("variable", F.col("categoria").alias("codigo"))
            .agg(F.sum("filas").alias("filas")))


@query
def recode_passthrough(spark, sf):
    return _code_counts(spark, sf).withColumn(
        "etiqueta", long_label(F.col("variable"), F.col("codigo"), LABELS))


@query
def recode_closed(spark, sf):
    codes = _code_counts(spark, sf).filter(F.col("variable") != "patron")
    return codes.withColumn("etiqueta", F.when(
        F.col("variable") == "cve_entidad", closed_label("cve_entidad", F.col("codigo"))).otherwise(
        closed_label("sector_economico_1", F.col("codigo"))))


@query
def recode_legacy(spark, sf):
    return cube.marginals(_measured(spark, sf), labels=LABELS_LEGACY)


@query
def unpivot_dims(spark, sf):
    long = cube.unpivot_dimensions(registro(spark, sf), ("date", "ta"))
    return long.groupBy("date", "variable", "categoria").agg(F.sum("ta").alias("ta"))


@query
def size_bands(spark, sf):
    return sheets.size_bands(
        _marginal(spark, sf, "patron"), newest_month(spark, sf).cast("date"))


@query
def latest_period(spark, sf):
    return periods.period_record(registro(spark, sf))


@query
def latest_nonnull_period(spark, sf):
    rated = F.when(F.col("tc_anual").isNotNull(), F.col("date"))
    return _state_rates(spark, sf).agg(F.max(rated).alias("date"))


@query
def same_month_by_year(spark, sf):
    return charts.same_month_bars(_national(spark, sf))


@query
def ytd_change(spark, sf):
    figures = report.national_figures(_indicators(spark, sf))
    return figures.select("date", "acumulado_anio",
                          X.by_sign(F.col("acumulado_anio"), "generación", "pérdida").alias("dir"))


@query
def flat_entities(spark, sf):
    return report.flat_states(_state_rates(spark, sf), threshold=1.0)


@query
def reference_month_delta(spark, sf):
    block = report.employer_block(
        report.employer_figures(_employer_rates(spark, sf), REFERENCE_MONTH))
    return block.select("mes_label", "ref_label", "pat_ref_fmt", "pat_actual_fmt", "reduccion",
                        "reduccion_fmt")


@query
def employers_long(spark, sf):
    return long_form(_employers(spark, sf))


@query
def employer_size_table(spark, sf):
    return report.employer_size_table(
        report.employer_figures(_employer_rates(spark, sf), REFERENCE_MONTH))


@query
def state_bars(spark, sf):
    as_of = newest_month(spark, sf).cast("date")
    rates = charts.state_rates(_marginal(spark, sf, "cve_entidad"), as_of)
    return charts.state_bars(rates)


@query
def last3_preview(spark, sf):
    return sheets.last_months(_indicators(spark, sf))


@query
def employment_type_table(spark, sf):
    cells = cube.base_cells(_measured(spark, sf), ("date", "sexo"))
    return report.employment_type_table(cube.national(cells), cube.national_by_sex(cells))


# --- aggregates -----------------------------------------------------------------------------

@query
def national_monthly(spark, sf):
    return _national(spark, sf)


@query
def national_by_sex(spark, sf):
    return _by_sex(spark, sf)


@query
def marginals(spark, sf):
    return cube.marginals(_measured(spark, sf))


@query
def marginals_by_sex(spark, sf):
    return cube.marginals(_measured(spark, sf), by=("sexo",))


@query
def state_sector(spark, sf):
    return cube.state_sector(_measured(spark, sf))


@query
def wage_marginals(spark, sf):
    return cube.wage_marginals(_measured(spark, sf))


@query
def wage_marginals_by_sex(spark, sf):
    return cube.wage_marginals(_measured(spark, sf), by=("sexo",))


@query
def same_month_average(spark, sf):
    figures = report.national_figures(_indicators(spark, sf))
    c = F.col
    return figures.select(
        "date", F.round("prom_tc_mensual", 6).alias("prom_tc_mensual"),
        F.round("prom_tc_anual", 6).alias("prom_tc_anual"),
        X.versus(c("tc_mensual_ta"), c("prom_tc_mensual")).alias("comp_mensual"),
        X.versus(c("tc_anual_ta"), c("prom_tc_anual")).alias("comp_anual"))


@query
def distinct_entities(spark, sf):
    codes = registro(spark, sf).select("cve_entidad").distinct()
    label = closed_label("cve_entidad", F.col("cve_entidad"))
    return codes.select(label.alias("entidad")).distinct()


@query
def ranking_text(spark, sf):
    """Five fastest and five slowest states of the latest month, as text."""
    newest = _newest_rates(spark, sf)
    sides = [ranking_text_of(newest, 5, largest).withColumn("tipo", F.lit(kind))
             for kind, largest in (("mayor", True), ("menor", False))]
    return sides[0].unionByName(sides[1])


# --- windows --------------------------------------------------------------------------------

@query
def growth_by_group(spark, sf):
    return growth.indicators(cube.marginals(_measured(spark, sf)), ("variable", "categoria"))


@query
def growth_calendar(spark, sf):
    """State indicators against the same month a year before, gaps included."""
    rows = _marginal(spark, sf, "cve_entidad")
    return growth.indicators(rows, ("categoria",), calendar=True).drop("variable")


@query
def national_indicators(spark, sf):
    return _indicators(spark, sf)


@query
def employers_rates(spark, sf):
    return _employer_rates(spark, sf)


@query
def state_rank(spark, sf):
    return sheets.state_growth(_marginal(spark, sf, "cve_entidad"))


@query
def state_table(spark, sf):
    return report.state_table(_newest_rates(spark, sf))


@query
def sector_share_state(spark, sf):
    return charts.state_sectors(_newest_state_sector(spark, sf), one_month=True)


@query
def sector_share_national(spark, sf):
    return charts.national_sectors(_newest_state_sector(spark, sf), one_month=True)


@query
def latest_per_series(spark, sf):
    return charts.last_points(long_form(_employers(spark, sf)))


@query
def top3_bottom3(spark, sf):
    newest = _newest_rates(spark, sf)
    return report.extremes(newest)


@query
def sector_trend(spark, sf):
    rows = charts.sector_trend(_marginal(spark, sf, "sector_economico_1"))
    return rows.withColumns({c: F.round(c, 4) for c in ("tc_mensual", "tendencia")})


@query
def sector_trend_curve(spark, sf):
    rows = charts.sector_trend_curve(_marginal(spark, sf, "sector_economico_1"))
    return rows.withColumns({c: F.round(c, 4) for c in ("dia", "tendencia")})


# --- scalar functions -----------------------------------------------------------------------

@query
def date_functions(spark, sf):
    months = registro(spark, sf).select("date").distinct()
    return months.select(
        "date", D.month_start(D.month_end("date")).alias("inicio"),
        D.month_end("date").alias("fin"), D.compact_period("date").alias("periodo"),
        D.month_of(F.year("date"), F.month("date")).alias("armada"),
        D.previous_month_name("date").alias("mes_anterior"))


@query
def month_label(spark, sf):
    months = registro(spark, sf).select("date").distinct()
    m, y = F.month("date"), F.year("date")
    return months.select("date", D.month_name(m).alias("nombre"),
                         D.month_name(m, short=True).alias("corto"),
                         D.period_label(m, y).alias("etiqueta"))


@query
def format_values(spark, sf):
    c = F.col
    return _indicators(spark, sf).select(
        "date", X.fmt_integer(c("ta")).alias("entero"),
        X.fmt_percent(c("tc_mensual_ta")).alias("pct"),
        X.fmt_percent(c("tc_anual_te"), 3).alias("pct3"),
        X.fmt_number(c("sbc_prom")).alias("num"), X.fmt_money(c("diff_mensual_sbc")).alias("pesos"),
        X.fmt_signed_percent(c("tc_anual_ta")).alias("pct_signo"),
        X.fmt_short_percent(c("tc_mensual_tp")).alias("pct_corto"),
        X.or_default(X.fmt_integer(c("diff_anual_ta"))).alias("o_nd"))


@query
def level_series(spark, sf):
    return charts.level_series(_national(spark, sf))


# --- report ---------------------------------------------------------------------------------

@query
def national_narrative(spark, sf):
    return report.national_block(_indicators(spark, sf))


@query
def sex_narrative(spark, sf):
    return report.sex_block(_by_sex(spark, sf))


@query
def sector_narrative(spark, sf):
    return report.sector_block(
        report.sector_ranking(_newest_state_sector(spark, sf), one_month=True))


@query
def sector_wage_table(spark, sf):
    micro = _measured(spark, sf, newest_month(spark, sf))
    return report.sector_wages_of_cells(cube.base_cells(micro, ("date", "sector_economico_1")))


@query
def state_narrative(spark, sf):
    return report.state_block(_newest_rates(spark, sf))


@query
def employer_narrative(spark, sf):
    return report.employer_block(
        report.employer_figures(_employer_rates(spark, sf), REFERENCE_MONTH))


@query
def sector_growth(spark, sf):
    return sheets.sector_growth(_marginal(spark, sf, "sector_economico_1"))


@query
def size_growth(spark, sf):
    return sheets.size_growth(_marginal(spark, sf, "patron"))


@query
def employment_summary(spark, sf):
    return sheets.employment_summary(_indicators(spark, sf))


@query
def wage_summary(spark, sf):
    return sheets.wage_summary(_indicators(spark, sf))


@query
def employment_comparison(spark, sf):
    return sheets.employment_comparison(_indicators(spark, sf))


@query
def report_sheets(spark, sf):
    """Every group and national sheet stored and read back: its rows and the sum of a column."""
    folder = new_folder(spark, "sheets")
    marginal_rows = materialise(cube.marginals(_measured(spark, sf)), "marginals")
    national = materialise(_indicators(spark, sf), "indicators")
    written = {**sheets.group_sheets(marginal_rows), **sheets.national_sheets(national)}
    write_report(written, folder)
    parts = []
    for name in written:
        df = read_table(spark, f"{folder}/{name}")
        column = next(c for c in ("Total", "ta", "month") if c in df.columns)
        parts.append(df.agg(F.count(F.lit(1)).alias("filas"), F.sum(column).alias("suma"))
                     .select(F.lit(name).alias("hoja"), "filas", "suma"))
    return reduce(DataFrame.unionByName, parts)


@query
def sign_flags(spark, sf):
    return reshape.sign_flags(_indicators(spark, sf))


@query
def summary_sentences(spark, sf):
    """The report text; its blocks share one stored table of cells per month."""
    keys = ("date", "cve_entidad", "sector_economico_1")
    cells = materialise(cube.base_cells(_measured(spark, sf), keys), "cells")
    rates = materialise(report.state_rates(cube.marginal(cells, "cve_entidad")), "rates")
    newest = report.newest_rates(rates)
    month = cells.agg(F.max("date")).first()[0]  # one value, looked up once
    ranking = report.sector_ranking(
        cube.state_sector(cells.filter(F.col("date") == F.lit(month))), one_month=True)
    employers = report.employer_figures(_employer_rates(spark, sf), REFERENCE_MONTH)
    return report.sentences({
        "nacional": report.national_block(growth.national_indicators(cube.national(cells))),
        "entidades": report.state_block(newest),
        "sectores": report.sector_block(ranking),
        "patrones": report.employer_block(employers),
    }, institute=INSTITUTE)


# --- charts ---------------------------------------------------------------------------------

@query
def annual_rate_series(spark, sf):
    return charts.annual_rate_series(_national(spark, sf))


@query
def employer_total_series(spark, sf):
    return charts.employer_total(long_form(_employers(spark, sf, "tamano")))
