"""Names, numbers and dates in text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that mean "no value" in landed CSV files.
NULL_TOKENS = ("", "nan", "NaN", "NULL", "None")


def blank_to_null(c: Column) -> Column:
    return F.when(~F.trim(c).isin(*NULL_TOKENS), c)


def csv_cells(line: Column) -> Column:
    """The cells of a CSV record as an array; quoted cells may hold commas, and a doubled quote in them is one."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    quoted = lambda c: (F.length(c) > 1) & c.startswith('"') & c.endswith('"')
    return F.transform(raw, lambda c: F.when(quoted(c), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def named_cells(names: Column, cells: Column) -> Column:
    """A map from names to cells: missing cells are NULL, cells without a name go, of a repeated name the first counts."""
    pairs = F.transform(names, lambda n, i: F.struct(n.alias("key"), F.get(cells, i).alias("value"), (F.array_position(names, n) == i + 1).alias("first")))
    return F.map_from_entries(F.transform(F.filter(pairs, lambda p: p["first"]), lambda p: F.struct(p["key"], p["value"])))


def lenient_number(c: Column) -> Column:
    """A number with thousands commas or a trailing unit; NULL where none is found."""
    return F.regexp_replace(F.regexp_extract(F.trim(c), r"^([-+]?[\d,]*\.?\d+(?:[eE][-+]?\d+)?)", 1), ",", "").try_cast("double")


def name_date(name: Column) -> Column:
    """The first yyyymmdd or yyyy-mm-dd in a file name."""
    found = F.regexp_extract(name, r"((?:19|20)\d{2})[-_]?(0[1-9]|1[0-2])[-_]?(0[1-9]|[12]\d|3[01])", 0)
    return F.try_to_timestamp(F.regexp_replace(found, "[-_]", ""), F.lit("yyyyMMdd")).cast("date")


def platform_of(name: Column) -> Column:
    """``sd1030_tpos_2023`` from names that begin so, else the second token, else the first."""
    vehicle = F.regexp_extract(name, r"^(sd\d+_[A-Za-z]+_\d{4})", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.coalesce(F.nullif(vehicle, F.lit("")), F.get(F.split(stem, "[_-]"), F.lit(1)), F.get(F.split(stem, "[_-]"), F.lit(0)))


def cruise_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"([A-Z]{2,4}\d{4,6}[A-Z]?)", 1), F.lit(""))


def snake_case(name: str) -> str:
    """``TempDegC (mean)`` to ``temp_deg_c_mean``."""
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]+", "_", name)).strip("_").lower()


# Parts of upper-case names that tell a column's category, in order of precedence.
CATEGORIES = {
    "nav": ("SOG", "COG", "HDG", "ROLL", "PITCH", "WING", "YAW"),
    "met": ("WIND", "TEMP_AIR", "RH", "BARO", "PAR", "SW_IRRAD", "GUST"),
    "ocean": ("TEMP_SBE", "TEMP_DEPTH", "TEMP_IR", "SAL", "COND", "O2", "CHLOR", "WAVE"),
}


def column_category(name: str) -> str:
    upper = name.upper()
    return next((c for c, parts in CATEGORIES.items() if any(p in upper for p in parts)), "other")


def categories(names: Iterable[str]) -> dict[str, str]:
    return {n: column_category(n) for n in names}


def category_of(name: Column) -> Column:
    """``column_category`` of names in a column."""
    found = F.lit("other")
    for kind, parts in reversed(CATEGORIES.items()):
        found = F.when(F.upper(name).rlike("|".join(parts)), kind).otherwise(found)
    return found
