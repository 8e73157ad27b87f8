"""Files to cells as a stream, through the same catalog, reader and store as the monthly job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from padron.plans.update import refresh_tables, update_files

#: The stream only lists files; their content is read by the batch that stores them.
LISTING = "path string, modificationTime timestamp, length long, content binary"


def store_batch(batch: DataFrame, cells_path: str, tables: str | None = None) -> None:
    """Cells of the files of one micro-batch; files already stored are left out.

    One short row per new file reaches the driver, `files_per_batch` at most. With a folder of
    tables their months are brought up to date in the same batch.
    """
    paths = sorted(r.path for r in batch.select("path").distinct().collect())
    update_files(batch.sparkSession, paths, cells_path)
    if tables and paths:
        refresh_tables(batch.sparkSession, cells_path, tables)


def start_ingest(spark: SparkSession, inputs: str, cells_path: str, checkpoint: str,
                 files_per_batch: int = 1000, tables: str | None = None) -> StreamingQuery:
    """Store every file not seen yet, then stop.

    Other files than monthly ones are ignored, headers may differ from file to file, and a month
    whose part files fall into several batches is whole once they have all come. A batch that is
    replayed, or a new checkpoint over the same folder, changes nothing.
    """
    files = (spark.readStream.format("binaryFile").schema(LISTING)
             .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
             .load(inputs).select("path"))
    return (files.writeStream.foreachBatch(lambda df, _: store_batch(df, cells_path, tables))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
