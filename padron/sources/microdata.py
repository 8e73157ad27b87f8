"""Strict reading of the monthly pipe-delimited Latin-1 files.

Columns are bound by name, file by file, so files and part files may order them differently. A
number may be written as `12` or `12.0`, and anything else in a numeric column, a fraction in a
count, or a line with a field too few or too many stops the read with an error that names the file.
A tolerant read keeps such lines apart instead. Lines with other spellings than `12` are read again
as text.
"""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.schemas import MICRODATA_TYPES
from padron.sources.catalog import list_files, period_from_name, source_name
from padron.sources.headers import header_variants

#: An unquoted empty field and the text NA are null; a quoted empty field is empty text.
CSV_OPTIONS = {"sep": "|", "header": True, "encoding": "ISO-8859-1", "nullValue": "NA"}

#: Path of the file a row was read from, as column `file_path`.
PATH = "_metadata.file_path"

_BROKEN = "_broken_line"

#: A line read again, and amounts of lines that need no such reading.
_AGAIN, _AMOUNT = "_read_again", "_amount_"

#: Columns of a tolerant read: why a line is rejected (null: it is not), and the line.
REASON, LINE = "motivo", "linea"


def size_column(header: Iterable[str]) -> str:
    """The one column that holds the employer size, whose name changes over the years."""
    found = [c for c in header if "_patron" in c.lower()]
    if len(found) != 1:
        raise ValueError(f"expected one column with '_patron', found {found}")
    return found[0]


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a file; Spark takes only its first line."""
    return tuple(spark.read.options(**CSV_OPTIONS).csv(path).columns)


def read_microdata(spark: SparkSession, paths: list[str], tolerant: bool = False) -> DataFrame:
    """All sources as one frame, with the size column named `patron` and the period added.

    Paths are files or folders of part files. Headers are found by one job; files are grouped by
    header and each group is one scan, so the plan grows with the number of header variants, not
    of files. The period columns are parsed from `file_path` on every row that uses them:
    aggregates should group by `file_path` and call `with_source` on the result.
    """
    if not paths:
        raise FileNotFoundError("no monthly files to read")
    return _read_listed(spark, list_files(spark, paths), True, tolerant)


def read_files(spark: SparkSession, files: Sequence[str], tolerant: bool = False) -> DataFrame:
    """As `read_microdata`, for files already listed; one with only a header has no rows."""
    if not files:
        raise FileNotFoundError("no monthly files to read")
    return _read_listed(spark, list_files(spark, list(files)), False, tolerant)


def _read_listed(spark: SparkSession, files: DataFrame, whole_sources: bool,
                 tolerant: bool) -> DataFrame:
    groups = header_variants(files, whole_sources)
    if not groups:
        raise FileNotFoundError("the monthly files are empty")
    frames = [_read_group(spark, list(h), f, tolerant) for h, f in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _read_group(spark: SparkSession, header: list[str], paths: list[str],
                tolerant: bool) -> DataFrame:
    try:
        size = size_column(header)
    except ValueError as error:
        raise ValueError(f"{paths[0]}: {error}") from None
    kinds = {c: t for c, t in MICRODATA_TYPES.items()
             if c in header and not isinstance(t, T.StringType)}
    # Counts are read as such. Amounts stay text, since Spark's reader skips commas in them.
    amounts = {c: t for c, t in kinds.items() if isinstance(t, T.DecimalType)}
    counts = {c: t for c, t in kinds.items() if c not in amounts}
    schema = T.StructType([T.StructField(c, counts.get(c, T.StringType()))
                           for c in (*header, _BROKEN)])
    # Whole lines are parsed, since a line of the wrong width shows only then.
    options = {**CSV_OPTIONS, "columnNameOfCorruptRecord": _BROKEN, "columnPruning": False}
    rows = (spark.read.schema(schema).options(**options).option("recursiveFileLookup", True)
            .csv(paths).select("*", PATH))
    rows = rows.withColumns({_AMOUNT + c: F.col(c).try_cast(t) for c, t in amounts.items()})
    plain = F.col(_BROKEN).isNull()
    for c in amounts:
        two_decimals = F.substring(c, -3, 1) == "."  # no more, so that nothing is rounded
        plain = plain & (F.col(c).isNull() | (two_decimals & F.col(_AMOUNT + c).isNotNull()))
    rows = rows.withColumn(_AGAIN, F.when(~plain, _read_again(header, kinds, options)))
    reason, line = F.col(f"{_AGAIN}.{REASON}"), F.col(f"{_AGAIN}.{LINE}")
    if not tolerant:
        stop = F.raise_error(F.concat(reason, F.lit(" in "), "file_path", F.lit(": "), line))
        # Spark pushes the filter below the line read again: first what is cheap there.
        rows = rows.filter(F.when(plain | reason.isNull(), F.lit(True)).otherwise(
            stop.cast("boolean")))
    again = F.col(_AGAIN).isNotNull()
    typed = {c: F.when(again, F.col(f"{_AGAIN}.{c}")).otherwise(
        F.col(_AMOUNT + c if c in amounts else c)) for c in kinds}
    rejected = {REASON: reason, LINE: F.when(reason.isNotNull(), line)} if tolerant else {}
    rows = rows.withColumns({**typed, **rejected})
    return with_source(rows.drop(_BROKEN, _AGAIN, *[_AMOUNT + c for c in amounts])
                       .withColumnRenamed(size, "patron"))


def _read_again(header: list[str], kinds: dict[str, T.DataType], options: dict) -> Column:
    """Reason, line and numbers of a line that is not all numbers as Spark writes them.

    Nearly no line needs this. It goes through wide decimals several times, so that it is kept in
    a lambda, apart from the code for the other lines. A line with another spelling of an amount
    alone is put together from the fields as they were read, with `+7` and `007` as 7.
    """
    text = ", ".join(f"`{c}` STRING" for c in (*header, _BROKEN))
    fields = [F.col(f"`{c}`").cast("string").alias(c) for c in header]
    whole = F.struct(*fields, F.lit(None).cast("string").alias(_BROKEN))
    parsed = F.when(F.col(_BROKEN).isNull(), whole).otherwise(
        F.from_csv(_BROKEN, text, options))

    def result(line: Column) -> Column:
        wrong = [F.when(line[_BROKEN].isNotNull(), F.lit("line of the wrong width"))]
        wrong += [F.when(~_good(line[c], t), F.lit(f"{c} is not a number of its kind"))
                  for c, t in kinds.items()]
        # Spark asks for a column of the line beside the broken one.
        joined = F.concat_ws("|", *[F.coalesce(line[c], F.lit("")) for c in header])
        return F.struct(
            F.coalesce(*wrong).alias(REASON), F.coalesce(line[_BROKEN], joined).alias(LINE),
            *[_number(line[c]).try_cast(t).alias(c) for c, t in kinds.items()])

    return F.transform(F.array(parsed), result)[0]


def _field(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def _number(text: Column) -> Column:
    return _field(text).try_cast(T.DecimalType(38, 6))


def _good(text: Column, kind: T.DataType) -> Column:
    """Whether a numeric field is empty or a value of its kind."""
    value = _number(text)
    good = value.isNotNull() & value.try_cast(kind).isNotNull()
    if not isinstance(kind, T.DecimalType):
        good = good & (value == F.floor(value))
    return _field(text).isNull() | F.coalesce(good, F.lit(False))


def split_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows of a tolerant read, and the rejected lines (file_path, motivo, linea)."""
    good = rows.filter(F.col(REASON).isNull()).drop(REASON, LINE)
    return good, rows.filter(F.col(REASON).isNotNull()).select("file_path", REASON, LINE)


def with_source(rows: DataFrame) -> DataFrame:
    """Source name and period of each row, from its file path."""
    named = rows.withColumn("archivo", source_name("file_path"))
    return named.withColumns(period_from_name("archivo"))


def dealt_by_month(micro: DataFrame) -> DataFrame:
    """Columns of the sources, with the name of the source, rebalanced by month.

    The rebalance keeps files large and splits a month that outweighs the others. Rows are
    shuffled with a date and named behind the shuffle.
    """
    columns = [c for c in MICRODATA_TYPES if c in micro.columns]
    dealt = micro.select(F.last_day("date").alias("_end"), *columns).hint(
        "rebalance", F.col("_end"))
    name = F.concat(F.lit("asg-"), F.col("_end").cast("string"), F.lit(".csv"))
    return dealt.select(name.alias("archivo"), *columns)


def write_microdata(micro: DataFrame, folder: str, size_name: str = "tamaño_patron",
                    reverse: bool = False) -> None:
    """Add microdata to a folder of monthly sources, one folder of part files per month.

    `reverse` writes the columns in the opposite order.
    """
    rows = dealt_by_month(micro)
    name, *columns = rows.columns
    (rows.select(name, *(reversed(columns) if reverse else columns))
     .withColumnRenamed("patron", size_name).write.mode("append").partitionBy(name)
     .options(**{**CSV_OPTIONS, "nullValue": ""}).csv(folder))
