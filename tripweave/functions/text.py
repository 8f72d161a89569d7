"""Column expressions that turn source text into typed values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def has_all(*columns: str) -> Column:
    """No column is NULL. Plain conditions, which the optimizer drops where they are
    known to hold; ``dropna`` hides them in one large expression."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def to_double(text: Column) -> Column:
    """Text to double; NULL if it is no number.

    Java reads a trailing d or f as a type mark ("1.5d"); such texts are no numbers here.
    Only texts that end so are looked at any closer.
    """
    marked = F.right(text, F.lit(1)).isin("d", "D", "f", "F") & text.rlike("[0-9.].$")
    return F.when(marked, F.lit(None)).otherwise(text).try_cast("double")


def to_int(text: Column) -> Column:
    """Text to integer, halves rounded away from zero; NULL if it is no number."""
    return F.round(to_double(text)).try_cast("int")


def decimal_comma(text: Column) -> Column:
    """European number text ("12.345,6") to double; blank or unreadable gives NULL."""
    return to_double(F.translate(F.trim(text), ",.", "."))


def digits_long(text: Column) -> Column:
    """The digits of a text as a long ("1.234" -> 1234); none gives NULL."""
    return F.regexp_replace(F.trim(text), "[^0-9]", "").try_cast("bigint")


def compact_date(text: Column) -> Column:
    """yyyyMMdd to date; NULL if it is no such date."""
    return F.try_to_date(text, "yyyyMMdd")


def leading_code(label: Column) -> Column:
    """"46001 Town" -> "46001"."""
    return F.split_part(label, F.lit(" "), F.lit(1))


def period_year(period: Column) -> Column:
    """The year a period label ends with ("1 de enero de 2022" -> 2022)."""
    return F.right(period, F.lit(4)).try_cast("int")


def plain_zone(zone: Column) -> Column:
    """Zone code without its aggregation marks."""
    return F.replace(F.replace(zone, F.lit("_AM"), F.lit("")), F.lit("_AD"), F.lit(""))


def digits_zone(zone: Column) -> Column:
    """Zone code cut down to its digits; may be the empty string."""
    return F.regexp_replace(plain_zone(zone.cast("string")), "[^0-9]", "")


def is_domestic(zone: Column) -> Column:
    """True for zones inside the country; NULL for a NULL zone."""
    return ~(zone.startswith("PT") | zone.startswith("FR") | (zone == "externo"))


def municipality_of(zone: Column) -> Column:
    return F.left(zone, F.lit(5))


def date_from_path(path: Column) -> Column:
    """The day a trip file is for, read from its name; NULL for other files."""
    return compact_date(F.regexp_extract(path, r"/(\d{8})_Viajes_distritos", 1))
