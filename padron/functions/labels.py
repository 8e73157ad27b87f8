"""Code -> label expressions, with an open or a closed default."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from padron.dictionaries import (
    BAND_OTHER, DIMENSIONS, LABELS, NO_DATA, REGION_ALIASES, SIZE_BANDS,
)
from padron.functions.literals import sql_text, text_array


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    entries = ", ".join(f"{sql_text(k)}, {sql_text(v)}" for k, v in pairs.items())
    return F.try_element_at(F.expr(f"map({entries})"), key)


def plain_code(code: Column) -> Column:
    """Numeric code without leading zeros, as a reader that takes it for a number gives it."""
    return F.regexp_replace(code, r"^0+(?=\d+$)", "")


def open_label(variable: str, code: Column, labels: dict[str, dict[str, str]] = LABELS) -> Column:
    """Label of a code; unknown codes pass through, null gets its own label."""
    plain = plain_code(code)
    return F.coalesce(_lookup(labels[variable], plain), plain, F.lit(NO_DATA[variable]))


def closed_label(variable: str, code: Column, labels: dict[str, dict[str, str]] = LABELS) -> Column:
    """Label of a code; null and unknown codes share the missing-data label."""
    return F.coalesce(_lookup(labels[variable], plain_code(code)), F.lit(NO_DATA[variable]))


def long_label(variable: Column, code: Column,
               labels: dict[str, dict[str, str]] = LABELS) -> Column:
    """`open_label` for rows in long form, where the dimension is itself a column."""
    first, *rest = DIMENSIONS
    out = F.when(variable == first, open_label(first, code, labels))
    for dim in rest:
        out = out.when(variable == dim, open_label(dim, code, labels))
    return out.otherwise(code)


def size_band(size_label: Column) -> Column:
    """Four bands of employer size; anything else has no band."""
    first, *rest = SIZE_BANDS.items()
    out = F.when(size_label.isin(first[1]), first[0])
    for band, sizes in rest:
        out = out.when(size_label.isin(sizes), band)
    return out.otherwise(BAND_OTHER)


def band_ordinal(band: Column) -> Column:
    """Display position of a band, starting at 1."""
    order = text_array([*SIZE_BANDS, BAND_OTHER])
    return F.array_position(order, band).cast("int")


def region_key(state: Column) -> Column:
    """State name as the map dimension spells it."""
    return F.coalesce(_lookup(REGION_ALIASES, state), state)
