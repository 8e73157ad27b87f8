"""Numbers as text. A null value stays null unless a default text is asked for."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_number(x: Column, decimals: int = 2) -> Column:
    """Thousands separators and fixed decimals, without a negative zero."""
    return F.regexp_replace(F.format_number(x, decimals), r"^-(0(\.0+)?)$", "$1")


def fmt_integer(x: Column) -> Column:
    """`22748603` -> `22,748,603`."""
    return fmt_number(x, 0)


def fmt_percent(x: Column, decimals: int = 1) -> Column:
    """`1.057` -> `1.1%`; the value is already in percent."""
    return F.concat(fmt_number(x, decimals), F.lit("%"))


def fmt_signed_percent(x: Column, decimals: int = 1) -> Column:
    """`1.5` -> `+1.5%`."""
    sign = F.when(x >= 0, "+").when(x < 0, "-")
    return F.concat(sign, fmt_percent(F.abs(x), decimals))


def fmt_money(x: Column, decimals: int = 2) -> Column:
    """`809.18` -> `$809.18`, with the sign before the currency."""
    sign = F.when(x < 0, "-").otherwise("")
    return F.concat(sign, F.lit("$"), fmt_number(F.abs(x), decimals))


def fmt_share(x: Column, decimals: int = 1) -> Column:
    """Fraction of one as a percentage."""
    return fmt_percent(x * 100, decimals)


def fmt_short_percent(x: Column, decimals: int = 1) -> Column:
    """Rounded percentage without trailing zeros: `2.0` -> `2%`."""
    fixed = F.round(x, decimals).cast(f"decimal(28,{decimals})").cast("string")
    return F.concat(F.regexp_replace(fixed, r"\.0+$|(\.\d*?)0+$", "$1"), F.lit("%"))


def fmt_millions(x: Column, decimals: int = 2) -> Column:
    """Value on a millions axis."""
    return F.round(x / F.lit(1e6), decimals)


def or_default(text: Column, default: str = "N/D") -> Column:
    return F.coalesce(text, F.lit(default))


def by_sign(x: Column, non_negative: str, negative: str) -> Column:
    """One of two words by the sign of a value."""
    return F.when(x >= 0, non_negative).when(x < 0, negative)


def versus(x: Column, reference: Column) -> Column:
    """`mayor` when the value reaches the reference, else `menor`."""
    return F.when(x >= reference, "mayor").when(x < reference, "menor")


def slug(x: Column) -> Column:
    """Name usable in a path: lower case, blanks as underscores."""
    return F.replace(F.lower(x), F.lit(" "), F.lit("_"))
