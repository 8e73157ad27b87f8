"""Monthly update: new files become cells once, and every table is derived from the cells."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators import cube
from padron.operators.history import upsert
from padron.schemas import TABLE_KEYS
from padron.sources.catalog import (
    file_catalog, in_range, list_files, monthly_files, new_months)
from padron.session import materialise
from padron.sources.microdata import LINE, REASON, read_files, read_microdata
from padron.sources.tables import read_table, table_exists, write_snapshot

SOURCE, ORIGIN = "archivo", "origen"


class RejectedLines(ValueError):
    """Too many lines of a run were rejected; nothing of it was stored."""

TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "national": lambda c: cube.national(c, by=(SOURCE,)),
    "national_by_sex": lambda c: cube.national_by_sex(c, by=(SOURCE,)),
    "marginals": lambda c: cube.marginals(c, by=(SOURCE,)),
    "marginals_by_sex": lambda c: cube.marginals(c, by=("sexo", SOURCE)),
    "state_sector": lambda c: cube.state_sector(c, by=(SOURCE,)),
    "wage_marginals": lambda c: cube.wage_marginals(c, by=(SOURCE,)),
    "wage_marginals_by_sex": lambda c: cube.wage_marginals(c, by=("sexo", SOURCE)),
}


def source_cells(micro: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Base cells kept apart by the monthly source and the file they come from.

    Rows are summed per file under a short key, so that the large shuffle carries no paths and
    names are parsed per cell and not per row. `origen` is the key of the file. Of a tolerant read
    keep the reason and the line: rejected lines are then cells of their own, counted in `filas`.
    """
    codes = [k for k in cube.CELL_KEYS if k != "date"]
    keyed = cube.measured(micro).withColumn(ORIGIN, F.xxhash64("file_path"))
    if not keep:
        return cube.base_cells(keyed, (ORIGIN, *codes))
    rejected = F.col(REASON).isNotNull()
    bare = {c: F.when(~rejected, F.col(c)) for c in (*codes, *cube.COUNTS, *cube.WAGE_PARTS)}
    counted = keyed.withColumns({**bare, "filas": F.lit(1).cast("long")})
    return cube.base_cells(counted, (ORIGIN, *codes, *keep),
                           (*cube.COUNTS, *cube.WAGE_PARTS, "filas"))


def named_cells(cells: DataFrame, files: DataFrame) -> DataFrame:
    """Adds the source and month of each file, of `monthly_files`, a row per file."""
    names = files.select(F.xxhash64("file_path").alias(ORIGIN), SOURCE, "date", "file_path")
    if REASON not in cells.columns:
        names = names.drop("file_path")
    return cells.join(names, ORIGIN)


def store_cells(cells: DataFrame, cells_path: str) -> None:
    """Add cells to the store, which is partitioned by month."""
    (cells.hint("rebalance", F.col("date")).write.mode("append").partitionBy("date")
     .parquet(cells_path))


def build_table(name: str, cells: DataFrame) -> DataFrame:
    """One aggregate table; where two files claim a month, the first by name wins each key."""
    rows = TABLES[name](cells)
    return upsert(None, rows, TABLE_KEYS[name], order=(SOURCE,)).drop(SOURCE)


def replace_months(rows: DataFrame, path: str) -> None:
    """Write the rows' months, and leave all other months of the table as they are."""
    (rows.hint("rebalance", F.col("date")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def update_cells(spark: SparkSession, inputs: str, cells_path: str, mode: str = "all",
                 date_range: tuple | None = None, rejected_path: str | None = None,
                 max_rejected: float = 0.001) -> bool:
    """Add the months the cells lack; False when there is nothing new.

    Months already stored are neither read nor rewritten. A run that died half
    way is repeated safely, since it replaces only its own months.

    A line that cannot be read stops the run. With `rejected_path` such lines go to a table there
    instead (date, archivo, file_path, motivo, linea, filas), found in the same scan; a run in
    which more than the share `max_rejected` of the lines is rejected stores nothing and fails.
    """
    catalog = file_catalog(spark, inputs)
    if catalog.isEmpty():
        raise FileNotFoundError(f"no monthly files in {inputs}")
    if date_range is not None:
        catalog = in_range(catalog, *date_range)
    history = read_table(spark, cells_path) if table_exists(spark, cells_path) else None
    fresh = new_months(catalog, history, mode).select("ruta").orderBy("ruta")
    paths = [row.ruta for row in fresh.collect()]  # one short row per new monthly source
    if not paths:
        return False
    files = monthly_files(list_files(spark, paths))
    if rejected_path is None:
        replace_months(named_cells(source_cells(read_microdata(spark, paths)), files), cells_path)
        return True
    rows = source_cells(read_microdata(spark, paths, tolerant=True), (REASON, LINE))
    checked = materialise(named_cells(rows, files), "checked")
    bad = F.col(REASON).isNotNull()
    lines = checked.agg(F.sum("filas").alias("all"),
                        F.coalesce(F.sum(F.when(bad, F.col("filas"))), F.lit(0)).alias("bad")).first()
    if lines["bad"] > max_rejected * (lines["all"] or 0):
        worst = checked.filter(bad).groupBy("file_path").agg(F.sum("filas").alias("n")).orderBy(
            F.desc("n"), "file_path").first()
        raise RejectedLines(f"{lines['bad']} of {lines['all']} lines rejected, "
                            f"{worst.n} of them in {worst.file_path}")
    replace_months(checked.filter(bad).select(
        SOURCE, "file_path", REASON, LINE, "filas", "date"), rejected_path)
    replace_months(checked.filter(~bad).drop(REASON, LINE, "filas", "file_path"), cells_path)
    return True


def fresh_files(files: DataFrame, history: DataFrame | None) -> DataFrame:
    """Monthly files that a store lacks: of a month it lacks, or of a source it holds in part.

    A file that is stored is never read again, and a stored month wins over other sources.
    """
    if history is None:
        return files
    keyed = files.withColumn(ORIGIN, F.xxhash64("file_path"))
    stored = history.select(ORIGIN, SOURCE, "date").distinct()
    unread = keyed.join(stored.select(ORIGIN), ORIGIN, "left_anti")
    owners = stored.select("date", F.col(SOURCE).alias("_owner")).distinct()
    claims = unread.join(owners, "date", "left").groupBy("path", "file_path", SOURCE, "date").agg(
        F.count("_owner").alias("_owners"),
        F.count_if(F.col("_owner") == F.col(SOURCE)).alias("_own"))
    return claims.filter((F.col("_owners") == 0) | (F.col("_own") > 0)).drop("_owners", "_own")


def update_files(spark: SparkSession, paths: list[str], cells_path: str) -> bool:
    """Add single files, as they arrive, to the store; False when none is new.

    Repeating a call changes nothing, since files that are stored are left out, and a write is
    seen whole or not at all.
    """
    if not paths:
        return False
    history = read_table(spark, cells_path) if table_exists(spark, cells_path) else None
    files = fresh_files(monthly_files(list_files(spark, paths)), history)
    listed = [r.path for r in files.select("path").orderBy("path").collect()]
    if not listed:
        return False
    rows = source_cells(read_files(spark, listed))
    store_cells(named_cells(rows, monthly_files(list_files(spark, listed))), cells_path)
    return True


def _first_source(rows: DataFrame, name: str) -> DataFrame:
    return upsert(None, rows, TABLE_KEYS[name], order=(SOURCE,)).drop(SOURCE)


def all_tables(cells: DataFrame) -> dict[str, DataFrame]:
    """Every table, from sums over grouping sets that one scan of the cells stores."""
    sums = materialise(cube.grouped_sums(cells, (SOURCE,)), "sums")
    return {name: _first_source(rows, name)
            for name, rows in cube.tables_of(sums, (SOURCE,)).items()}


def publish_tables(spark: SparkSession, cells_path: str, folder: str,
                   names: tuple[str, ...] = tuple(TABLES)) -> None:
    """Store a new snapshot of each table, all from one scan of the cells."""
    tables = all_tables(read_table(spark, cells_path))
    for name in names:
        write_snapshot(tables[name], f"{folder}/{name}")


#: Table of the published months: date and a digest of the files that their cells come from.
STATE = "meses"


def month_state(cells: DataFrame) -> DataFrame:
    """Per month, which files its cells come from; reads two columns."""
    return cells.groupBy("date", ORIGIN).count().groupBy("date").agg(
        F.count("*").alias("archivos"), F.bit_xor(F.xxhash64(ORIGIN, "count")).alias("huella"))


def refresh_tables(spark: SparkSession, cells_path: str, folder: str) -> list:
    """Bring the published tables, partitioned by month, up to date; the months rewritten.

    Only months whose cells changed since they were published are read and rewritten; the others
    keep their files. The state is written last, so a run that died is repeated safely.
    """
    cells = read_table(spark, cells_path)
    state = month_state(cells)
    if table_exists(spark, f"{folder}/{STATE}"):
        known = read_table(spark, f"{folder}/{STATE}")
        changed = state.join(known, ["date", "archivos", "huella"], "left_anti")
    else:
        changed = state
    changed = materialise(changed, "changed")
    months = sorted(r.date for r in changed.select("date").collect())  # calendar months
    if not months:
        return []
    for name, rows in all_tables(cells.filter(F.col("date").isin(months))).items():
        replace_months(rows, f"{folder}/{name}")
    replace_months(changed, f"{folder}/{STATE}")
    return months
