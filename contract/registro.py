"""The registry as a projection of `lineitem`, since no microdata ships with the repository.

The same expressions serve both engines, but for the month. Code 33 has no
label, sector 2 has no label, some codes are null, and some wage masses and
weights are zero.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.dictionaries import EMPLOYER_SIZES, SECTORS, SIZES
from padron.functions.dates import month_name
from padron.functions.labels import open_label, region_key
from padron.session import new_folder
from padron.sources.employers import region_dimension
from padron.sources.microdata import write_microdata

COLUMNS = {
    "date": "{month}",
    "cve_entidad": "CAST(NULLIF((l_suppkey*7+l_partkey)%34, 0) AS {text})",
    "sector_economico_1": "CAST(NULLIF(l_partkey%11, 10) AS {text})",
    "patron": "CASE WHEN l_partkey%13=0 THEN NULL"
              " ELSE concat('S', CAST(l_linenumber AS {text})) END",
    "sexo": "CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END",
    "ta": "CAST(l_quantity AS BIGINT)",
    "teu": "CASE WHEN l_returnflag='A' THEN CAST(l_quantity AS BIGINT) END",
    "tec": "CASE WHEN l_returnflag='R' THEN CAST(l_quantity AS BIGINT) END",
    "tpu": "CASE WHEN l_returnflag='N' AND l_partkey%2=0 THEN CAST(l_quantity AS BIGINT) END",
    "tpc": "CASE WHEN l_returnflag='N' AND l_partkey%2=1 THEN CAST(l_quantity AS BIGINT) END",
    "masa_sal_ta": "CASE WHEN l_partkey%17=0 THEN CAST(0 AS DECIMAL(18,2))"
                   " ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END",
    "ta_sal": "CASE WHEN l_partkey%19=0 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END",
    "l_suppkey": "l_suppkey",
}

#: Month of the stored timestamp and text type, per engine. Spark's own spelling
#: stays on dates and needs no time zone.
SPARK = {"month": "trunc(CAST(l_shipdate AS DATE), 'MM')", "text": "STRING"}
DUCKDB = {"month": "CAST(date_trunc('month', l_shipdate) AS DATE)", "text": "VARCHAR"}

#: Stand-in for the report's fixed reference month.
REFERENCE_MONTH = "2000-11-01"

#: Stand-in for the name of the body that workers are registered with.
INSTITUTE = "Instituto"

#: From this month on the size column carries its accented heading.
DRIFT_MONTH = "1998-01-01"

_landings: dict[tuple[str, str], str] = {}


def projection(engine: dict[str, str]) -> list[str]:
    """Select list of the registry in one engine's spelling."""
    return [f"{sql.format(**engine)} AS {name}" for name, sql in COLUMNS.items()]


def registro(spark: SparkSession, sf_dir: str, since: Column | None = None) -> DataFrame:
    """The registry; `since` drops earlier months in the scan, on the stored column."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if since is not None:
        rows = rows.filter(F.col("l_shipdate") >= since)
    return rows.selectExpr(*projection(SPARK))


def newest_month(spark: SparkSession, sf_dir: str) -> Column:
    """Newest month as a scalar subquery that reads one column.

    It has the type of the stored column, so that a filter on it reaches the scan.
    """
    return registro(spark, sf_dir).select(F.max("date").cast("timestamp_ntz")).scalar()


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the whole registry as monthly CSV sources, and a stray file.

    Written once per session. From DRIFT_MONTH on half of the rows of each month lie in part
    files with another heading of the size column and another order of columns. Missing states
    are the text NA, other missing values are empty fields.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        folder = new_folder(spark, "landing")
        rows = registro(spark, sf_dir).withColumn(
            "cve_entidad", F.coalesce("cve_entidad", F.lit("NA")))
        drifted = (F.col("date") >= F.lit(DRIFT_MONTH).cast("date")) & (F.col("l_suppkey") % 2 == 0)
        write_microdata(rows.filter(~drifted), folder, "Tamano_Patron")
        write_microdata(rows.filter(drifted), folder, "tamaño_patron", reverse=True)
        spark.createDataFrame([("no es un mes",)], "value string").coalesce(1).write.text(
            f"{folder}/leeme.csv")
        _landings[key] = folder
    return _landings[key]


#: Broken lines of the quarantine query by the remainder of l_partkey, each with its reason.
BROKEN_LINES = {0: ("1|0|S1", "line of the wrong width"),
                50: ("1|0|S1|1|x12|1|1|1|1|1.00|1", "ta is not a number of its kind"),
                100: ("1|0|S1|1|1|1|1|2.5|1|1.00|1", "tpu is not a number of its kind")}


def broken_landing(spark: SparkSession, sf_dir: str) -> str:
    """Sources of one year as CSV, with a part file of broken lines beside the good ones."""
    folder = new_folder(spark, "broken")
    rows = registro(spark, sf_dir).filter(F.year("date") == 1997)
    write_microdata(rows, folder, "Tamano_Patron")
    with_key = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        f"{COLUMNS['date'].format(**SPARK)} AS date", "l_partkey % 150 AS clase")
    line = F.create_map(*[F.lit(x) for k, (v, _) in BROKEN_LINES.items() for x in (k, v)])
    header = ("cve_entidad|sector_economico_1|Tamano_Patron|sexo|ta|teu|tec|tpu|tpc|masa_sal_ta"
              "|ta_sal")
    lines = with_key.filter((F.year("date") == 1997) & F.col("clase").isin(*BROKEN_LINES)).groupBy(
        "date").agg(F.collect_list(line[F.col("clase").cast("int")]).alias("lines"))
    name = F.concat(F.lit("asg-"), F.last_day("date").cast("string"), F.lit(".csv"))
    text = F.array_join(F.concat(F.array(F.lit(header)), F.col("lines")), "\n")
    lines.select(name.alias("archivo"), text.alias("value")).write.mode("append").partitionBy(
        "archivo").text(folder)
    return folder


def employer_sheet(reg: DataFrame, dimension: str, columns: dict[str, str],
                   with_total: bool) -> DataFrame:
    """Distinct suppliers per month, overall and per code, one column each.

    A supplier's months are folded to flags first, so no code's suppliers meet
    in one task and nothing is pivoted.
    """
    flags = [F.max(F.when(F.col(dimension) == code, 1).otherwise(0)).alias(f"_{i}")
             for i, code in enumerate(columns)]
    suppliers = reg.groupBy("date", "l_suppkey").agg(*flags)
    totals = [F.count(F.lit(1)).alias("Total")] if with_total else []
    counts = [F.sum(f"_{i}").alias(name) for i, name in enumerate(columns.values())]
    wide = suppliers.groupBy("date").agg(*totals, *counts)
    return wide.select(F.year("date").alias("Año"),
                       F.initcap(month_name(F.month("date"))).alias("Mes"),
                       *[f"`{c}`" for c in wide.columns if c != "date"])


def employer_sheets(reg: DataFrame) -> dict[str, DataFrame]:
    """Stand-ins for both sheets of the employer panel."""
    return {"tamano": employer_sheet(reg, "patron", dict(zip(SIZES, EMPLOYER_SIZES)), True),
            "sector": employer_sheet(reg, "sector_economico_1", SECTORS, False)}


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map dimension: the nations, named as the states of the same code; one has no data."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    code = F.nullif(F.col("n_nationkey").cast("string"), F.lit("0"))
    name = F.when(code.isNull(), F.col("n_name")).otherwise(
        region_key(open_label("cve_entidad", code)))
    return region_dimension(nation.select(name.alias("nombre"), "n_nationkey"), "nombre")
