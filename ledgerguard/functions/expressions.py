"""Column expressions shared by the rules and reports.

All of these are built-in Spark SQL functions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

import re

from ledgerguard.config import HIGH_VALUE_REASON, TRAVEL_REASON, ScreeningConfig

__all__ = [
    "event_time_from_text", "epoch_micros", "as_instant", "wall_clock_from_micros", "nan_to_null", "unsummed", "money_sum",
    "money", "ratio", "pct_of", "high_value_reason", "travel_reason",
    "is_foreign_country", "is_branch_country", "foreign_countries_array", "partition_date",
    "earliest_by_time", "fill_template",
]

#: A time of day with something after its digits.
ZONED = r"\d:\d{1,2}(:\d{1,2}(\.\d*)?)?\s*([Zz]|[+-]\d|[A-Za-z]{2})"

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def event_time_from_text(text: Column) -> Column:
    """Zone-less ``yyyy-MM-dd HH:mm:ss[.ffffff]`` text -> TIMESTAMP_NTZ.

    ``try_cast`` yields NULL for unparseable text instead of failing the job
    under ANSI mode (which would kill a stream on one bad row). Text that names a
    zone after the time (``Z``, ``+05:30``, ``UTC``, ``Asia/Tokyo``) is that
    instant's wall clock in UTC; text that names none is the wall clock itself.
    """
    zoned = text.rlike(ZONED)
    # only zoned text passes the session zone, and with a zone of its own it does not depend on it
    instant = F.when(zoned, text).try_cast("timestamp")
    return F.when(zoned, wall_clock_from_micros(F.unix_micros(instant))).otherwise(text.try_cast("timestamp_ntz"))


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch for a TIMESTAMP or TIMESTAMP_NTZ column.

    A TIMESTAMP_NTZ wall clock is read as UTC, independent of the session zone.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(F.col(name))
    raise TypeError(f"{name} is {dtype}, expected a timestamp")


def wall_clock_from_micros(micros: Column) -> Column:
    """Epoch microseconds -> TIMESTAMP_NTZ wall clock read as UTC (no session zone)."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def as_instant(df: DataFrame, name: str) -> Column:
    """TIMESTAMP (instant) view of a timestamp column; NTZ is taken as UTC.

    Watermarks require TIMESTAMP, while the tables carry zone-less wall clocks.
    """
    if isinstance(df.schema[name].dataType, TimestampType):
        return F.col(name)
    return F.timestamp_micros(epoch_micros(df, name))


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL, so sums and means skip it the way pandas does."""
    return F.nanvl(c, F.lit(None).cast("double"))


#: Sums of money are exact: they do not depend on the order of tasks.
MONEY = "decimal(30,6)"


def exact(c: Column) -> Column:
    """A double amount as a decimal; NaN (and what is too large) is NULL."""
    return nan_to_null(c).try_cast(MONEY)


def unsummed(c: Column) -> Column:
    """Whether an amount is a number that ``exact`` cannot hold: infinite, or 1e24 and more.

    Sums leave such amounts out as they do NaN, and reports count them.
    """
    return F.coalesce(nan_to_null(c).isNotNull() & exact(c).isNull(), F.lit(False))


def no_money() -> Column:
    return F.lit(0).cast("decimal(38,6)")


def money(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def ratio(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def money_sum(c: Column) -> Column:
    """Sum that skips NaN/NULL and is 0.0 over no rows, rounded to cents."""
    return money(F.coalesce(F.sum(exact(c)), no_money()))


def pct_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double, 0 when ``whole`` is 0."""
    return ratio(F.when(whole > 0, part.cast("double") / whole.cast("double") * 100.0)
                 .otherwise(F.lit(0.0)))


def fill_template(template: str, **values: Column) -> Column:
    """``concat`` of a ``{name}`` template's literal pieces and the given columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    cols = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    return F.concat(*cols)


def high_value_reason(cfg: ScreeningConfig) -> Column:
    # NULL-propagating concat, like the screened system: NULL country -> NULL reason.
    return fill_template(HIGH_VALUE_REASON, amount=F.col("amount").cast("string"),
                         threshold=F.lit(cfg.threshold_text), country=F.col("country"))


def travel_reason(countries: Column, cfg: ScreeningConfig) -> Column:
    return fill_template(TRAVEL_REASON, count=F.size(countries).cast("string"),
                         countries=F.concat_ws(", ", countries), window=F.lit(cfg.travel_window))


def is_foreign_country(country: Column, cfg: ScreeningConfig) -> Column:
    return country != F.lit(cfg.home_country)


def is_branch_country(country: Column, cfg: ScreeningConfig) -> Column:
    return country.isin(*cfg.branch_countries)


def foreign_countries_array(cfg: ScreeningConfig) -> Column:
    branches = F.array(*[F.lit(c) for c in cfg.branch_countries])
    return F.filter(branches, lambda c: c != F.lit(cfg.home_country))


def partition_date(timestamp_text: Column) -> Column:
    """Lake partition value: the date of the zone-less timestamp text.

    Unparseable text gives NULL, which Spark writes as the default partition.
    """
    return event_time_from_text(timestamp_text).cast("date")


def earliest_by_time(value: Column, time_col: str = "event_time",
                     id_col: str = "transaction_id") -> Column:
    """Value of the earliest row by (event time, transaction id); keeps NULL values."""
    return F.min_by(value, F.struct(F.col(time_col), F.col(id_col)))
