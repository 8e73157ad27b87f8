"""Which monthly files exist, which months are new, which are still missing."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions.dates import month_end, month_start
from padron.operators.periods import between

#: A month is a file of this name, or a folder of part files of this name.
FILE_PATTERN = r"asg-\d{4}-\d{2}-\d{2}\.csv"


def source_name(path: str | Column) -> Column:
    """Name of the monthly source a path belongs to; null when it belongs to none."""
    return F.nullif(F.regexp_extract(path, FILE_PATTERN + r"(?=/|$)", 0), F.lit(""))


def period_from_name(name: str | Column) -> dict[str, Column]:
    """Year, month and first day of the month, taken from the source name."""
    year = F.regexp_extract(name, r"(?<=asg-)\d{4}", 0).try_cast("int")
    month = F.regexp_extract(name, r"(?<=asg-\d{4}-)\d{2}", 0).try_cast("int")
    return {"year": year, "month": month, "date": file_month(name)}


def file_month(name: str | Column) -> Column:
    """Month of a source name; null when the name holds no valid date."""
    text = F.regexp_extract(name, r"\d{4}-\d{2}-\d{2}", 0)
    return month_start(text.try_cast("date"))


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files below one or more paths, read in no part: path, length, time of the last change, and
    file_path, the name that a scan gives to its rows."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
            .select("path", "length", "modificationTime", "_metadata.file_path"))


def monthly_files(files: DataFrame) -> DataFrame:
    """Those files (column `path`) that belong to a source with a valid date, with both."""
    named = files.withColumn("archivo", source_name("path")).filter(F.col("archivo").isNotNull())
    return named.withColumn("date", file_month("archivo")).filter(F.col("date").isNotNull())


def file_catalog(spark: SparkSession, folder: str, modified_after=None) -> DataFrame:
    """One row per monthly source below a folder: name, month, folder or file path, size.

    The listing reads no file content. Sources whose name is not a date are left out, and those
    of which no file was modified after a time, if one is given.
    """
    inside = F.regexp_replace("path", "(" + FILE_PATTERN + ")/.*$", "$1")
    sources = (monthly_files(list_files(spark, folder)).withColumn("ruta", inside)
               .groupBy("archivo", "ruta", "date").agg(
                   F.sum("length").alias("bytes"), F.max("modificationTime").alias("_changed")))
    if modified_after is not None:
        sources = sources.filter(F.col("_changed") > F.lit(modified_after))
    return sources.drop("_changed")


def new_months(catalog: DataFrame, history: DataFrame | None, mode: str = "all") -> DataFrame:
    """Sources whose month the history lacks: all of them, or only the newest one."""
    if mode not in ("all", "latest"):
        raise ValueError("mode must be 'all' or 'latest'")
    fresh = catalog
    if history is not None:
        fresh = catalog.join(history.select("date").distinct(), "date", "left_anti")
    if mode == "latest":
        fresh = fresh.orderBy(F.col("date").desc(), F.col("archivo").desc()).limit(1)
    return fresh


def in_range(catalog: DataFrame, start, end) -> DataFrame:
    """Sources whose own date (not its month) lies in a range, both ends included."""
    stamp = F.regexp_extract("archivo", r"\d{4}-\d{2}-\d{2}", 0).try_cast("date")
    return between(catalog.withColumn("_stamp", stamp), start, end, "_stamp").drop("_stamp")


def source_manifest(bounds: DataFrame, base_url: str) -> DataFrame:
    """Month-end spine with the expected source name and address.

    `bounds` holds one row with the first and the last month, `start` and `end`.
    """
    months = bounds.select(F.explode(F.sequence(
        month_start("start"), month_start("end"), F.expr("interval 1 month"))).alias("date"))
    ends = months.withColumn("fecha_corte", month_end("date"))
    name = F.concat(F.lit("asg-"), F.col("fecha_corte").cast("string"), F.lit(".csv"))
    named = ends.withColumn("archivo", name)
    return named.withColumn("url", F.concat(F.lit(base_url), F.col("archivo")))


def missing_months(manifest: DataFrame, catalog: DataFrame) -> DataFrame:
    """Expected sources that are not there yet."""
    return manifest.join(catalog.select("archivo").distinct(), "archivo", "left_anti")
