"""Numeric helpers reproducing MySQL / R arithmetic under ANSI Spark.

* ``lenient_int`` / ``lenient_double``: MySQL reads the leading number of a
  text ('3室1厅' -> 3) where ANSI ``CAST`` raises and ``try_cast`` gives NULL.
* ``r_div``: R division, x/0 -> +-Inf, 0/0 -> NaN (kept as NULL).
* ``snap_price``: round a price onto the house's ...30/...60/...90 grid with R's
  floored modulo.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_PREFIX = r"^\s*([+-]?[0-9]+)"
NUM_PREFIX = r"^\s*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lenient_int(col: Column | str) -> Column:
    """FN6 ``cast(text as signed)``: the leading integer, NULL if there is none."""
    return F.regexp_extract(_c(col).cast("string"), INT_PREFIX, 1).try_cast("bigint")


def lenient_double(col: Column | str) -> Column:
    """MySQL text-to-number conversion used by comparisons (``'600' > 500``)."""
    return F.regexp_extract(_c(col).cast("string"), NUM_PREFIX, 1).try_cast("double")


def r_div(num: Column | str, den: Column | str) -> Column:
    """PRJ9 R division: x/0 is +Inf or -Inf, 0/0 (R's NaN) is NULL, NULL stays NULL."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return (
        F.when(d == 0, F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf"))))
        .otherwise(n / d)
    )


def clamp_nonneg(col: Column | str) -> Column:
    """ENC12 ``case when d<0 then 0 else d end`` (NULL stays NULL, unlike greatest)."""
    c = _c(col)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def snap_price(col: Column | str) -> Column:
    """PRJ11: r - r%%100 + {30, 60, 90} for r%%100 in [0,30], (30,60], (60,100).

    ``pmod`` is R's floored modulo, so -17.5 snaps to -10 and 2195 to 2190.
    """
    r = _c(col).cast("double")
    m = F.pmod(r, F.lit(100.0))
    base = r - m
    return (
        F.when(m <= 30, base + 30)
        .when(m <= 60, base + 60)
        .when(m > 60, base + 90)
    )
