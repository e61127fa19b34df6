"""Calendar projections: time parts (B1), cyclical encodings (B2),
season flags (B3), month names (B15) and week labels used by resampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's results.
# Season membership for the model flags (month numbers). October is in none.
SUMMER_MONTHS = (3, 4, 5)
MONSOON_MONTHS = (6, 7, 8, 9)
WINTER_MONTHS = (11, 12, 1, 2)
# Dashboard seasons (a different grouping from the model flags).
DASHBOARD_SEASONS = (
    ("Summer", (3, 4, 5)),
    ("Monsoon", (6, 7, 8, 9)),
    ("Post-Monsoon", (10, 11)),
    ("Winter", (12, 1, 2)),
)
# Short month names, January first.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# Cyclical periods of the encoded calendar parts.
CYCLE_PERIODS = (("hour", 24), ("day", 31), ("month", 12))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_parts(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """hour, day, month, weekday (Monday = 0), quarter, year as int columns."""
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "weekday": F.weekday(t),
        "quarter": F.quarter(t),
        "year": F.year(t),
    })


def cyclical(df: DataFrame, periods=CYCLE_PERIODS) -> DataFrame:
    """``<part>_sin`` / ``<part>_cos`` = sin/cos(2*pi*part/period)."""
    cols = {}
    for name, period in periods:
        angle = F.lit(2 * math.pi) * F.col(name) / F.lit(float(period))
        cols[f"{name}_sin"] = F.sin(angle)
        cols[f"{name}_cos"] = F.cos(angle)
    return df.withColumns(cols)


def season_flags(df: DataFrame, month: str = "month") -> DataFrame:
    m = F.col(month)
    return df.withColumns({
        "is_summer": m.isin(*SUMMER_MONTHS).cast("int"),
        "is_monsoon": m.isin(*MONSOON_MONTHS).cast("int"),
        "is_winter": m.isin(*WINTER_MONTHS).cast("int"),
    })


def month_name(month) -> Column:
    """1..12 -> 'Jan'..'Dec' (NULL outside the range)."""
    m = _col(month)
    return F.when(m.between(1, 12), F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), m.cast("int")))


def dashboard_season(month) -> Column:
    m = _col(month)
    expr = None
    for name, months in DASHBOARD_SEASONS:
        expr = F.when(m.isin(*months), F.lit(name)) if expr is None else expr.when(m.isin(*months), F.lit(name))
    return expr


def week_ending_sunday(ts) -> Column:
    """Label of a pandas ``resample('W')`` bucket: the Sunday closing the week.
    Pure date arithmetic, so the session time zone cannot move it."""
    d = F.to_date(_col(ts))
    return F.date_add(d, F.lit(6) - F.weekday(d))


def hour_start(ts) -> Column:
    """``ts`` truncated to the hour as ``timestamp_ntz`` (field arithmetic:
    independent of the session time zone and of daylight-saving gaps)."""
    t = _col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def day_start(ts) -> Column:
    """``ts`` truncated to midnight as ``timestamp_ntz``."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")
