"""Small column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("B", "KB", "MB", "GB", "TB")


def year_of_key(key: Column) -> Column:
    """The first folder named by four digits, else the file's stem if it has four digits, else null."""
    folder = F.regexp_extract(key, r"(?:^|/)(\d{4})/", 1)
    stem = F.regexp_extract(key, r"(?:^|/)(\d{4})(?:\.[^./]*)?$", 1)
    return F.coalesce(F.when(folder != "", folder), F.when(stem != "", stem)).cast("long")


def month_of_key(key: Column) -> Column:
    """The month of a key ``.../<year>/<month>/<file>``, else null."""
    month = F.regexp_extract(key, r"/\d{4}/(\d{1,2})/[^/]+$", 1)
    return F.when(month != "", month).cast("long")


def prefix_of_key(key: Column, managed: list[str], depth: int = 3) -> Column:
    """A key's folders: the first ``depth`` of managed roots, else the first; ``(root)`` without any."""
    folders = F.slice(F.split(key, "/"), F.lit(1), F.size(F.split(key, "/")) - 1)
    root = F.try_element_at(folders, F.lit(1))
    return F.when(root.isNull(), "(root)").when(root.isin(*managed), F.array_join(F.slice(folders, 1, depth), "/")).otherwise(root)


def human_size(size: Column) -> Column:
    out = None
    for i, unit in enumerate(UNITS):
        text = F.concat(F.format_string("%.2f", size / float(1024**i)), F.lit(f" {unit}"))
        test = size < float(1024 ** (i + 1)) if unit != UNITS[-1] else F.lit(True)
        out = F.when(test, text) if out is None else out.when(test, text)
    return out


def rounded(value: Column, digits: int, half: str = "up") -> Column:
    """Rounding for sinks: ``up`` as NumPy's spelled-out decimals, ``even`` as Python's."""
    return F.bround(value, digits) if half == "even" else F.round(value, digits)


def present(value: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(value), value)


def local_time(ts: Column, zone: str = "America/New_York") -> Column:
    """UTC as a zone's wall clock, written without an offset."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd'T'HH:mm:ss")


def with_suffix(symbol: Column, suffix: str = ".T") -> Column:
    """A vendor's form of a local code; indices (``^``) stay as they are."""
    return F.when(symbol.startswith("^"), symbol).otherwise(F.concat(symbol, F.lit(suffix)))


def without_suffix(symbol: Column, suffix: str = ".T") -> Column:
    return F.when(symbol.endswith(suffix), F.substr(symbol, F.lit(1), F.length(symbol) - len(suffix))).otherwise(symbol)
