"""Constant collections as one expression, instead of one call per element."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(text: str) -> str:
    """Text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values: Iterable[str]) -> Column:
    return F.expr(f"array({', '.join(map(sql_text, values))})")
