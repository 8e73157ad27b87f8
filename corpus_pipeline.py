"""Documents to a mixed, encoded training set: five stages, each on all that the last one kept.

Every stage but the last returns the columns of documents. Quality rules drop the documents that
they reject, near-dedup keeps the smallest doc_id of each group, decontamination drops documents
that hold a benchmark window, mixing puts the documents into the order of the target weights, and
the last stage encodes their tokens in that order and reads the files back.

The order passes from mixing to encoding as the order of rows in the written files: mixing deals
rows to files by ranges of their slots, and Spark tells each row's file and place in it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm import decontamination, mixing, quality_rules, simhash, token_files
from padron.llm.queries import PIECE_BPE, WORD_BPE, table
from padron.llm.shipping import ship_package
from padron.llm.texts import without
from padron.session import materialise, new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; of an id with several rows all go or none."""
    ship_package(spark)
    verdicts = quality_rules.judge(docs, PIECE_BPE)
    return without(docs, materialise(verdicts.filter("NOT kept").select("doc_id"), "rejected"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of linked fingerprints (operator 7).

    Rows without doc_id go together if one of them is linked with a row that has an id. Rows that
    repeat a kept doc_id are reduced to one.
    """
    ship_package(spark)
    groups = materialise(simhash.near_duplicates(docs).select("doc_id", "component_id"), "groups")
    gone = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = without(docs, materialise(gone.select("doc_id"), "copies"))
    repeated = materialise(groups.groupBy("doc_id").count().filter("count > 1")
                           .select("doc_id"), "repeated")
    if not repeated.count():
        return kept
    ids = repeated.withColumnRenamed("doc_id", "_id")
    same = kept["doc_id"].eqNullSafe(ids["_id"])
    return kept.join(ids, same, "left_anti").unionByName(
        kept.join(ids, same, "left_semi").dropDuplicates(["doc_id"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, materialise(found.filter("contaminated").select("doc_id"), "leaks"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that follow the slots of the schedule.

    The small table of places is cut into ranges, one for each file; the texts then go to the
    number of their range, so that they are neither sampled nor sorted across tasks.
    """
    places = materialise(mixing.mix(docs).groupBy(F.col("doc_id").alias("id")).agg(
        F.min(F.struct("slot", "place")).alias("at")), "places")
    ranges = materialise(places.repartitionByRange("at").select(
        "id", "at", F.spark_partition_id().alias("file")), "ranges")
    files = 1 + (ranges.agg(F.max("file")).first()[0] or 0)
    # One row per document: a table that grows with the corpus and is never broadcast. Both sides
    # are structs until the end, so that no column of the documents can clash.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    placed = whole.join(ranges.select(F.struct("id", "at", "file").alias("to")).hint("merge"),
                        F.col("doc.doc_id").eqNullSafe(F.col("to.id")))
    return placed.repartitionById(files, F.col("to.file")).sortWithinPartitions(
        "to.at").select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from files in the mixed order.

    The order is that of the numbers of the part files, and of the rows in them. Documents that do
    not come from files have no such order and follow by doc_id.
    """
    ship_package(spark)
    placed, order = docs.select("doc_id", "text"), ("doc_id",)
    if docs.inputFiles():
        file = docs.metadataColumn("_metadata")
        part = F.regexp_extract(file["file_name"], r"part-(\d+)", 1).try_cast("long")
        placed = docs.select("doc_id", "text", part.alias("_part"), file["file_name"].alias("_file"),
                             file["row_index"].alias("_row"))
        order = ("_part", "_file", "_row")
    path = new_folder(spark, "tokens")
    token_files.write_token_file(placed, WORD_BPE, path, order=order)
    return token_files.token_digests(spark, path)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("encode", encode)]

#: SQL has no tokenizers; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each to the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
