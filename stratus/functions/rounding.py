"""Rounding helpers.

Two rounding modes appear in the reference workload:

* pandas/numpy ``.round(d)``: half-to-even        -> :func:`half_even`
* PostgreSQL ``ROUND(numeric, d)``: half-away-up   -> :func:`half_up`

Both first cast the double to ``decimal(38,10)``.  Floating-point sums are
order dependent, so a value that is "exactly" 0.285 may arrive as
0.2849999999999999; rounding the 10-digit decimal removes that noise and makes
ties round the same way on every engine and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import compile_wide

_DEC = "decimal(38,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Values of a lesser magnitude are rounded in doubles: their error stays far below MARGIN up to FAST_DIGITS digits.
FAST_BELOW, FAST_DIGITS, MARGIN = 1e6, 6, 1e-3


def _rounded(c: Column, digits: int, rounding) -> Column:
    """``rounding`` of the 10-digit decimal.

    Casts between doubles and decimals cost about a microsecond each.  They are kept for values near a tie, large ones
    and NaN: anywhere else the nearest multiple of 10 ** -digits is the same one, and dividing a whole number by a
    power of ten gives the double that the decimal would.
    """
    exact = rounding(c.cast(_DEC), digits).cast("double")
    if not 0 <= digits <= FAST_DIGITS:
        return exact
    x, scale = c.cast("double"), F.lit(10.0 ** digits)
    above = x * scale + 0.5
    whole = F.floor(above)
    clear = (F.abs(x) < FAST_BELOW) & (above - whole).between(MARGIN, 1 - MARGIN)
    return F.when(clear, whole / scale).otherwise(exact)


def half_up(c, digits: int = 2) -> Column:
    """HALF_UP rounding to ``digits`` (SQL ``ROUND`` semantics), as double."""
    return _rounded(_col(c), digits, F.round)


def half_even(c, digits: int = 2) -> Column:
    """HALF_EVEN rounding to ``digits`` (pandas ``.round`` semantics), as double."""
    return _rounded(_col(c), digits, F.bround)


def js_round(c) -> Column:
    """JavaScript ``Math.round``: halves go towards +infinity (-2.5 -> -2)."""
    return F.floor(_col(c) + F.lit(0.5)).cast("long")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """HALF_UP-round every double column (stable values for hashing/compare)."""
    cols = {f.name: half_up(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return compile_wide(df.withColumns(cols)) if cols else df
