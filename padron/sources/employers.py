"""The employer panel: one wide table per sheet."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from padron.operators.growth import wide_rates
from padron.operators.reshape import annual_long, clean_employers
from padron.sources.tables import read_table

# The sheets of the employer panel and the tag of their long form.
SHEETS = {"tamano": "Tamaño", "sector": "Sector"}


def read_employers(spark: SparkSession, folder: str, fmt: str = "parquet",
                   **options) -> dict[str, DataFrame]:
    """Both sheets of the panel, cleaned: month number and date added."""
    if fmt == "csv":
        options = {"header": True, "inferSchema": True, **options}
    return {name: clean_employers(read_table(spark, f"{folder}/{name}", fmt, **options))
            for name in SHEETS}


def employers_long(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Annual growth of every column of both sheets, in long form."""
    first, *rest = [annual_long(wide_rates(df), SHEETS[name]) for name, df in sheets.items()]
    for other in rest:
        first = first.unionAll(other)
    return first


def region_dimension(df: DataFrame, name: str) -> DataFrame:
    """Map dimension keyed by region name; geometry is not carried."""
    return df.withColumnRenamed(name, "NOMGEO")
