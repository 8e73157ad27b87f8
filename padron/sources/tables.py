"""Stored tables: versioned snapshots, report folders, one output per entity."""

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions.formats import slug


class TableReadError(RuntimeError):
    """A table could not be read; the message names its path."""


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a table, naming it when that fails."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        raise TableReadError(f"could not read {path}: {error}") from error


#: Spark's names for a path that is missing and for one without files.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a path holds a table. Anything but a missing or empty path is an error."""
    try:
        read_table(spark, path, fmt)
    except TableReadError as error:
        condition = error.__cause__.getCondition() or ""
        if condition.partition(".")[0] in ABSENT:
            return False
        raise
    return True


class SnapshotConflict(RuntimeError):
    """Another writer published a version after the one that this write was based on."""


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object, as Spark itself reaches the store."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists; False if it does. The store decides between two
    writers that create it at once."""
    store, where = _file_system(spark, path)
    try:
        out = store.create(where, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


_ENTRY = "version long, folder string, momento timestamp"


def snapshot_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The published versions of a table: version, folder and momento; None without a table."""
    if not table_exists(spark, f"{path}/versions", "text"):
        return None
    return spark.read.schema(_ENTRY).json(f"{path}/versions").filter(
        F.col("version").isNotNull())


def _newest(spark: SparkSession, path: str):
    log = snapshot_log(spark, path)
    return log.orderBy(F.desc("version")).first() if log is not None else None


def write_snapshot(df: DataFrame, path: str, based_on: int | None = None) -> int:
    """Store a table as its next version and return its number.

    Rows go to a folder of their own; an entry in `versions` publishes it once it is complete. A
    job may thus read the table it replaces, a write that fails leaves nothing that readers see,
    and a version without rows is a version like any other. The entry of a number is created only
    if there is none: of two writers at once each gets a number of its own, the later one the
    higher. With `based_on`, the version that the write was made from (0: no table), a write that
    is not the next one after it publishes nothing and raises SnapshotConflict.
    """
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    newest = _newest(spark, path)
    version = (newest.version if newest else 0) + 1
    while True:
        if based_on is not None and version != based_on + 1:
            raise SnapshotConflict(f"{path} has version {version - 1}, not {based_on}")
        entry = {"version": version, "folder": folder,
                 "momento": datetime.now(timezone.utc).isoformat()}
        if _create(spark, f"{path}/versions/{version:020d}.json", json.dumps(entry) + "\n"):
            return version
        version += 1


def read_snapshot(spark: SparkSession, path: str, version: int | None = None,
                  as_of: datetime | None = None) -> DataFrame:
    """A version of a table: the newest, that of a number, or the newest at a time."""
    log = snapshot_log(spark, path)
    if log is not None and version is not None:
        log = log.filter(F.col("version") == version)
    if log is not None and as_of is not None:
        log = log.filter(F.col("momento") <= F.lit(as_of))
    entry = log.orderBy(F.desc("version")).first() if log is not None else None
    if entry is None:
        wanted = f" {version if version is not None else as_of or ''}".rstrip()
        raise TableReadError(f"could not read {path}: it holds no versions{wanted and ' as asked:' + wanted}")
    return read_table(spark, f"{path}/{entry.folder}")


def vacuum_snapshots(spark: SparkSession, path: str, keep: int = 10,
                     grace: timedelta = timedelta(days=1)) -> list[int]:
    """Remove old versions, and folders of writes that never ended; the numbers removed.

    The `keep` newest versions stay, and whatever was written within the grace time, in which a
    reader or a writer may still need it. An entry goes before its folder, so that no reader finds
    a version without its rows. One short row per version and folder reaches the driver.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    log = snapshot_log(spark, path)
    if log is None:
        return []
    before = datetime.now(timezone.utc) - grace
    entries = log.withColumn("viejo", F.col("momento") < F.lit(before)).orderBy(
        F.desc("version")).collect()
    gone = [e for e in entries[keep:] if e.viejo]
    for e in gone:
        store, where = _file_system(spark, f"{path}/versions/{e.version:020d}.json")
        store.delete(where, False)
    used = {e.folder for e in entries} - {e.folder for e in gone}
    store, where = _file_system(spark, f"{path}/data")
    for status in store.listStatus(where):
        name = status.getPath().getName()
        old = status.getModificationTime() < before.timestamp() * 1000
        if old and f"data/{name}" not in used:
            store.delete(status.getPath(), True)
    return sorted(e.version for e in gone)


def write_report(sheets: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One output table per sheet below a report folder, replacing earlier ones."""
    for sheet, df in sheets.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{folder}/{sheet}")


def write_per_entity(df: DataFrame, folder: str, entity: str, fmt: str = "parquet") -> None:
    """One output folder per entity, named by its slug, written by a single job."""
    (df.withColumn("slug", slug(F.col(entity))).hint("rebalance", F.col("slug"))
     .write.mode("overwrite").partitionBy("slug").format(fmt).save(folder))
