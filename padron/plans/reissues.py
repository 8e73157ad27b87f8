"""Reissued months: what a new copy of a stored month would change.

A stored month wins over any other file for it, so a copy that was corrected later changes nothing
by itself. Here such copies are compared with the store, cell by cell, and the differences come
out as a table; the store stays as it is.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators import cube
from padron.plans.update import ORIGIN, SOURCE, named_cells, source_cells
from padron.sources.catalog import file_catalog, list_files, monthly_files
from padron.sources.microdata import read_microdata
from padron.sources.tables import read_table

STORED, CHANGE = "guardado", "cambio"
#: A cell that only the copy has, that only the store has, or that both have with other sums.
ADDED, GONE, CHANGED = "added", "gone", "changed"
MEASURES = (*cube.COUNTS, *cube.WAGE_PARTS)


def reissue_pairs(offered: DataFrame, stored: DataFrame) -> DataFrame:
    """Each offered source of a stored month with the stored source to compare it with.

    That is the stored source of the same name, or else the first one of the month by name.
    """
    owners = stored.select("date", F.col(SOURCE).alias(STORED)).distinct()
    other = F.struct(F.col(STORED) != F.col(SOURCE), STORED)
    return offered.select(SOURCE, "date").distinct().join(owners, "date").groupBy(
        SOURCE, "date").agg(F.min_by(STORED, other).alias(STORED))


def compare_cells(offered: DataFrame, stored: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cells whose sums differ between the sources of each pair.

    Both sides are summed in one aggregate, combined before its only large shuffle; null codes are
    codes of their own. A sum that no row counts for is null and differs from zero.
    """
    new = offered.join(pairs, [SOURCE, "date"]).withColumn("_new", F.lit(True))
    old = stored.withColumnRenamed(SOURCE, STORED).join(pairs, [STORED, "date"]).withColumn(
        "_new", F.lit(False))
    keys = [SOURCE, STORED, *cube.CELL_KEYS]
    both = new.select(*keys, *MEASURES, "_new").unionByName(old.select(*keys, *MEASURES, "_new"))
    fresh = F.col("_new")
    sums = [F.sum(F.when(fresh == side, F.col(m))).alias(f"{m}_{name}")
            for m in MEASURES for side, name in ((False, "antes"), (True, "ahora"))]
    cells = both.groupBy(*keys).agg(F.bool_or(fresh).alias("_in_new"),
                                    F.bool_or(~fresh).alias("_in_old"), *sums)
    same = F.lit(True)
    for m in MEASURES:
        same = same & F.col(f"{m}_antes").eqNullSafe(F.col(f"{m}_ahora"))
    change = (F.when(~F.col("_in_old"), ADDED).when(~F.col("_in_new"), GONE)
              .when(~same, CHANGED))
    return cells.withColumn(CHANGE, change).filter(F.col(CHANGE).isNotNull()).drop(
        "_in_new", "_in_old")


def reissued_cells(spark: SparkSession, inputs: str, cells_path: str, since=None) -> DataFrame:
    """Differences between the sources below `inputs` and the stored months they claim.

    Sources of months the store lacks are not read, nor, with `since` (a timestamp), sources none
    of whose files was modified after it. Result: archivo, guardado (the stored source), the cell
    keys, the change, and each measure before and now (`masa_ok` in hundredths). A source with
    equal sums in every cell gives no row, in whatever order or number of files its lines come.
    """
    stored = read_table(spark, cells_path)
    catalog = file_catalog(spark, inputs, modified_after=since).join(
        stored.select("date").distinct(), "date", "left_semi")
    paths = [r.ruta for r in catalog.select("ruta").orderBy("ruta").collect()]  # one per source
    if not paths:
        offered = stored.limit(0)
    else:
        files = monthly_files(list_files(spark, paths))
        offered = named_cells(source_cells(read_microdata(spark, paths)), files)
    pairs = reissue_pairs(offered if not paths else catalog, stored)
    return compare_cells(offered.drop(ORIGIN), stored.drop(ORIGIN), pairs)


def reissue_report(cells: DataFrame) -> DataFrame:
    """Per reissued source: cells added, gone and changed, and what the totals would change by."""
    counts = [F.count_if(F.col(CHANGE) == c).alias(name) for c, name in
              ((ADDED, "celdas_nuevas"), (GONE, "celdas_idas"), (CHANGED, "celdas_cambiadas"))]
    moved = [F.sum(F.coalesce(F.col(f"{m}_ahora"), F.lit(0)) - F.coalesce(
        F.col(f"{m}_antes"), F.lit(0))).alias(f"{m}_dif") for m in MEASURES]
    return cells.groupBy("date", SOURCE, STORED).agg(*counts, *moved)
