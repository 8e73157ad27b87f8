"""Joining new rows to a stored history."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_rows(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """Union by column name without a key check; columns of one side only become null."""
    if history is None:
        return new
    return history.unionByName(new, allowMissingColumns=True)


def upsert(history: DataFrame | None, new: DataFrame, keys: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Union keeping the first row of each key: history before new, then by `order`.

    Null keys count as equal. `order` must single out one row per key and side
    where a side may hold a key twice; those columns must exist on both sides.
    The first row is an aggregate, so repeats of a key are reduced before they
    are shuffled.
    """
    new = new.withColumn("_side", F.lit(1))
    both = new if history is None else append_rows(history.withColumn("_side", F.lit(0)), new)
    rest = [c for c in both.columns if c not in (*keys, "_side")]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(1).alias("_"))
    first = F.min_by(row, F.struct("_side", *order)).alias("_row")
    kept = both.groupBy(*keys).agg(first)
    return kept.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
