"""Wide and long forms of the employer panel, and sign marks on indicator columns."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.dates import month_number, month_of


def clean_employers(df: DataFrame) -> DataFrame:
    """Month number and date of a sheet that carries `Año` and a month word `Mes`."""
    numbered = df.withColumn("mes_num", month_number(F.col("Mes")))
    return numbered.withColumn(
        "fecha", month_of(F.col("Año").cast("int"), F.col("mes_num")))


def annual_long(df: DataFrame, kind: str, suffix: str = "_t_anual") -> DataFrame:
    """Every annual-rate column as rows `fecha, variable, tasa_anual`, tagged with `kind`."""
    rates = [c for c in df.columns if c.endswith(suffix)]
    if not rates:
        raise ValueError(f"no column ends with {suffix}")
    quoted = ["`" + c.replace("`", "``") + "`" for c in rates]
    long = df.unpivot("fecha", quoted, "variable", "tasa_anual")
    name = F.regexp_replace("variable", suffix + "$", "")
    return long.withColumns({"variable": name, "tipo": F.lit(kind)})


def columns_table(df: DataFrame, columns: Mapping[str, str], label: str, value: str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Chosen columns of a one-row table as labelled rows; a missing column gives null."""
    rows = []
    for i, (column, text) in enumerate(columns.items(), start=1):
        found = F.col(f"`{column}`") if column in df.columns else F.lit(None)
        rows.append(F.struct(F.lit(i).alias("orden"), F.lit(text).alias(label),
                             found.cast("long").alias(value)))
    picked = df.select(*keep, F.explode(F.array(*rows)).alias("_row"))
    return picked.select(*keep, "_row.*")


def sign_flags(df: DataFrame, prefixes: Sequence[str] = ("diff_", "tc_")) -> DataFrame:
    """`sign_{col}` = `pos` / `neg` / null for each indicator column."""
    marked = [c for c in df.columns if any(p in c for p in prefixes)]
    return df.withColumns({
        f"sign_{c}": F.when(F.col(c) > 0, "pos").when(F.col(c) < 0, "neg") for c in marked})
