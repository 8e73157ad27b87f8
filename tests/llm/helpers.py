"""Small tables with the awkward rows that every operator must take, and brute-force pieces."""

import re

from pyspark.sql import SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with those that operators make.
CLASHES = ["word", "pos", "_item", "known", "key", "rank", "slot", "part", "ids", "fp", "root",
           "score", "band", "spans", "start", "n_tokens", "_id", "_doc", "lines", "host",
           "at", "id", "file", "doc", "to", "_part", "_file", "_metadata"]


def documents(spark: SparkSession, rows: list[tuple], clash: bool = True):
    """rows: (doc_id, text) or with lang and source; extra columns have clashing names."""
    full = [(*r, *("en", "s")[len(r) - 2:])[:4] + (len(r[1] or ""),) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in CLASHES if clash else ():
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def words(text: str | None) -> list[str]:
    """Words between ASCII separators, A-Z in lower case."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def white_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


LONG = "lorem ipsum dolor sit amet " * 8_000
EDGE = [(1, None), (2, ""), (3, "   \n\n "), (4, "one"), (5, "a b c d e f g h i j k l m"),
        (5, "a b c d e f g h i j k l m"), (None, "a b c d e f g h i j k l m"), (None, None),
        (6, LONG), (7, "É À ñ ß   中文 \U0001F600 x"), (8, "x" * 50_000)]
