"""Terms of whole texts, counted in Arrow batches.

Texts are taken as UTF-8 bytes, where lower() changes A-Z alone and a term ends at ASCII bytes
only. A null text is empty.
"""

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct terms that a task counts before it hands its sums on.
HELD = 400_000
#: Rows of an Arrow batch that a task returns.
BATCH = 50_000


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The texts of a batch one by one, in lower case."""
    for value in batch.column(name).cast(pa.binary()):
        yield (value.as_py() or b"").lower()


def term_counts(docs: DataFrame, by: tuple[str, ...], pattern: bytes) -> DataFrame:
    """Rows (*by, term, tf, df): occurrences, and texts with the term, for each group of rows.

    The columns of `by` are text without nulls. A task sums in memory of bounded size, so that
    what is shuffled is a term of a group once for each task, or a few times.
    """
    find = re.compile(pattern).findall

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for group, (tf, df) in held.items():
            terms = list(tf)
            for i in range(0, len(terms), BATCH):
                part = terms[i:i + BATCH]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([g] * len(part), pa.string()) for g in group),
                     pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array([tf[t] for t in part], pa.int64()),
                     pa.array([df[t] for t in part], pa.int64())], [*by, "term", "tf", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            groups = zip(*(batch.column(c).to_pylist() for c in by))
            for group, text in zip(groups, byte_texts(batch)):
                words = find(text)
                tf, df = held.setdefault(group, (Counter(), Counter()))
                tf.update(words)
                df.update(set(words))
            if sum(len(tf) for tf, _ in held.values()) > HELD:
                yield from rows(held)
                held = {}
        yield from rows(held)

    kinds = ", ".join(f"{c} string" for c in by)
    partial = docs.select(*by, "text").mapInArrow(
        run, f"{kinds}, term string, tf long, df long")
    return partial.groupBy(*by, "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def distinct_terms(texts: DataFrame, key: str, pattern: bytes) -> DataFrame:
    """Rows (key, term), each term of a text once; key is a long."""
    find = re.compile(pattern).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, text in zip(batch.column(key), byte_texts(batch)):
                terms = sorted(set(find(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value.as_py()] * len(terms), pa.int64()),
                     pa.array(terms, pa.binary()).cast(pa.string())], [key, "term"])

    return texts.select(key, "text").mapInArrow(run, f"{key} long, term string")
