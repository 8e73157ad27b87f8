"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "padron", **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; cluster settings win elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Stack traces per column expression cost more than planning these small plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Scratch folders of local sessions; they vanish when the program ends.
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor sees: `spark.checkpoint.dir`, or a scratch one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.TemporaryDirectory(
            prefix="run-", ignore_cleanup_errors=True)
    return _local_folders[application].name


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh subfolder of the shared folder (created by the first write)."""
    return f"{shared_folder(spark)}/padron-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table several branches read, and return it read back.

    Unlike a checkpoint, the Parquet copy keeps column pruning and size
    statistics, so joins on it can still be broadcast by measured size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
