"""Number formatting for report text lines (JVM-side string functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerguard.config import BAR_EMPTY, BAR_FULL, BAR_WIDTH

__all__ = ["fmt_count", "fmt_money", "fmt_pct", "fmt_pct1", "bar"]


def _even(c: Column, places: int) -> Column:
    """Rounded with ties to the even digit, as report text has it (12.25 -> 12.2)."""
    return F.bround(c.cast("decimal(38,10)"), places).cast("double")


def fmt_count(c: Column, width: int = 0) -> Column:
    """Integer with thousands separators, right-aligned to ``width``."""
    s = F.format_number(c.cast("long"), 0)
    return F.lpad(s, width, " ") if width else s


def fmt_money(c: Column, width: int = 0) -> Column:
    """Two decimals with thousands separators."""
    s = F.format_number(_even(c, 2), 2)
    return F.lpad(s, width, " ") if width else s


def fmt_pct(c: Column) -> Column:
    return F.format_string("%.2f", _even(c, 2))


def fmt_pct1(c: Column, width: int = 0) -> Column:
    s = F.format_string("%.1f", _even(c, 1))
    return F.lpad(s, width, " ") if width else s


def bar(pct: Column, width: int = BAR_WIDTH) -> Column:
    """Share bar: one full block per 2 %, light blocks for the rest."""
    n = F.least(F.greatest(F.floor(pct / 2).cast("int"), F.lit(0)), F.lit(width))
    return F.concat(F.repeat(F.lit(BAR_FULL), n), F.repeat(F.lit(BAR_EMPTY), F.lit(width) - n))
