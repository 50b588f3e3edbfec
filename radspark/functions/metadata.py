"""Normalisation of medical image header values, as Column expressions.

All functions take strings as they stand in a header and give null where a
value cannot be read; none raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vendor names by the fragment that tells them, in order of precedence.
VENDORS = (
    ("hologic", "Hologic"),
    ("ge", "GE Healthcare"),
    ("siemens", "Siemens Healthineers"),
    ("fuji", "Fujifilm"),
    ("philips", "Philips"),
)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def vendor(raw: Column, strict: bool = False) -> Column:
    """Vendor name by fragment; ``strict`` asks for whole words, so that Agfa-Gevaert is not GE."""
    low = F.lower(F.trim(raw))
    out = F.trim(raw)
    for fragment, name in reversed(VENDORS):
        hit = low.rlike(rf"(^|[^a-z]){fragment}") & low.rlike(rf"{fragment}([^a-z]|$)|{fragment}(film|healthcare|medical)") if strict else low.contains(fragment)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return F.when(raw.isNull() | (raw == ""), F.lit("Unknown")).otherwise(out)


def iso_date(raw: Column) -> Column:
    """ISO date of a value with exactly 8 digits that name a real day from year 1 on."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    day = F.try_to_date(F.when((F.length(digits) == 8) & (F.left(digits, F.lit(4)) != "0000"), digits), "yyyyMMdd")
    return F.date_format(day, "yyyy-MM-dd")


def age_years(raw: Column) -> Column:
    """Whole years of an age such as 065Y, 018M, 104W, 730D; no unit means years."""
    digits = F.regexp_extract(F.trim(raw), r"^(\d+)", 1)
    unit = F.regexp_extract(F.trim(raw), r"^\d+([YMWD])?", 1)
    n = digits.try_cast("int")
    per = F.when(unit == "M", 12).when(unit == "W", 52).when(unit == "D", 365).otherwise(1)
    return F.floor(n / per).cast("int")


def first_number(values: Column, kind: str = "double") -> Column:
    """The first of several values as a number; null where it is none."""
    return F.get(values, F.lit(0)).try_cast(kind)


def number(raw: Column, kind: str = "double") -> Column:
    return F.trim(raw).try_cast(kind)


def implant_flag(raw: Column) -> Column:
    return F.when(raw.isNull(), F.lit(None).cast("boolean")).otherwise(F.upper(F.trim(raw)).isin("YES", "Y", "1"))


def slope(raw: Column) -> Column:
    """A rescale slope: missing, unreadable or zero is 1."""
    v = number(raw)
    return F.when(v.isNull() | (v == 0), F.lit(1.0)).otherwise(v)


def intercept(raw: Column) -> Column:
    return F.coalesce(number(raw), F.lit(0.0))


def exposure_uas(micro: Column, milli: Column) -> Column:
    """Exposure in microampere-seconds, from the milliampere value where need be."""
    return F.coalesce(number(micro), number(milli) * 1000)


def megapixels(rows: Column, cols: Column) -> Column:
    return F.when((rows > 0) & (cols > 0), F.round(rows.cast("double") * cols / 1e6, 2))


def aspect_ratio(rows: Column, cols: Column) -> Column:
    return F.when((rows > 0) & (cols > 0), F.round(cols.cast("double") / rows, 3))


def extension(path: Column) -> Column:
    """Lower-case extension of the last path part, with its dot; empty where there is none."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)$", 1))


def head_hash(content: Column, head: int = 4096) -> Column:
    """SHA-256 of the first bytes."""
    return F.sha2(F.substring(content, 1, head), 256)
