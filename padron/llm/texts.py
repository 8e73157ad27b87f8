"""Column expressions, batch helpers and checked broadcasts that several operators share."""

import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a table that may be broadcast: the callers' rows are at most about 100 bytes.
BROADCAST_ROWS = 200_000
#: UTF-8 bytes of text that a Python task holds in pieces at once (a longer text is held alone).
SLICE_BYTES = 2_000_000


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; a null is empty text."""
    text = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def broadcast_if_small(stored: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a stored table whose counted rows are within the limit.

    Larger tables carry no hint: the join is then a shuffle that adaptive execution can split.
    """
    return F.broadcast(stored) if stored.count() <= limit else stored


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents whose doc_id is not in the one-column stored table `rejected`.

    A null id is an id like any other. Only a table of checked size is broadcast; with a larger
    one both sides are shuffled by doc_id.
    """
    gone = broadcast_if_small(rejected.toDF("_gone").distinct())
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of at most about `limit` bytes, one text at least."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut by size of text, each with its texts as strings (null: empty).

    Only the texts of one slice are strings at a time, not those of the whole batch.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for start, end in slices(sizes, limit):
            part = batch.slice(start, end - start)
            yield part, [t or "" for t in part.column(text).to_pylist()]
