"""Numeric scalar helpers (F11–F15, F18, F21, F22) as Column expressions.

ANSI mode is on in Spark 4: bare ``x / 0`` raises, so every ratio in the
library goes through :func:`safe_div`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def safe_div(num, den, default: float | None = 0.0) -> Column:
    """F11 guarded division: ``num / den`` when ``den <> 0`` else ``default``."""
    n, d = _c(num), _c(den)
    dflt = F.lit(default) if default is not None else F.lit(None).cast("double")
    return F.when(d != 0, n / d).otherwise(dflt)


def total(c) -> Column:
    """Exact sum of a decimal amount, cast to double once summed."""
    return F.sum(_c(c)).cast("double")


def mean(c) -> Column:
    """Mean as (exact sum) / count — identical in any engine or order."""
    return F.sum(_c(c)).cast("double") / F.count(_c(c))


def exact_sum(c, scale: int = 6) -> Column:
    """Sum of a double column through DECIMAL(38, scale): exact and order-free
    (values are first rounded to ``scale`` places), returned as double."""
    return F.sum(_c(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_mean(c, scale: int = 6) -> Column:
    """Mean via :func:`exact_sum` — the same bits in any engine and order."""
    return exact_sum(c, scale) / F.count(_c(c))


def exact_mean_over(c, w, scale: int = 6) -> Column:
    """Window form of :func:`exact_mean`."""
    x = _c(c)
    return F.sum(x.cast(f"decimal(38,{scale})")).over(w).cast("double") / F.count(x).over(w)


def xsum_sql(expr: str, scale: int = 6) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def xmean_sql(expr: str, scale: int = 6) -> str:
    return f"({xsum_sql(expr, scale)} / count({expr}))"


def safe_corr(x, y) -> Column:
    """Pearson r that is null (not an error) when either side is constant:
    Spark's ``corr`` divides by zero inside the aggregate under ANSI mode."""
    a, b = _c(x).cast("double"), _c(y).cast("double")
    sa, sb = F.stddev_pop(a), F.stddev_pop(b)
    return F.when((sa > 0) & (sb > 0), F.covar_pop(a, b) / (sa * sb))


def round_half_up(c, places: int) -> Column:
    """Half-up rounding done in IEEE double arithmetic only, so every engine
    returns the same bits (``round()`` implementations disagree on ties)."""
    k = float(10 ** places)
    return F.floor(_c(c) * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)


def round_half_up_sql(expr: str, places: int) -> str:
    k = float(10 ** places)
    return f"(CAST(floor(({expr}) * {k} + 0.5) AS DOUBLE) / {k})"


def clip(c, lo=None, hi=None) -> Column:
    """F12 clip to [lo, hi]; nulls stay null (unlike bare greatest/least)."""
    x = _c(c)
    out = x
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def finite_or_null(c) -> Column:
    """P13/P19 helper: NaN and ±inf become null."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def to_number(c, default: float = 0.0) -> Column:
    """F21 safe coercion with default."""
    return F.coalesce(_c(c).cast("string").try_cast("double"), F.lit(default))


def null_safe_equal(a, b) -> Column:
    """F22."""
    return _c(a).eqNullSafe(_c(b))


# Coefficients of the Abramowitz & Stegun 26.2.17 rational
# approximation of the standard normal tail (absolute error < 7.5e-8).
NORMAL_TAIL_P = 0.2316419
NORMAL_TAIL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
INV_SQRT_2PI = 1.0 / math.sqrt(2.0 * math.pi)


def normal_sf(z) -> Column:
    """F15 upper-tail probability P(Z > z) of the standard normal."""
    x = _c(z)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(NORMAL_TAIL_P) * ax)
    b1, b2, b3, b4, b5 = (F.lit(b) for b in NORMAL_TAIL_B)
    poly = t * (b1 + t * (b2 + t * (b3 + t * (b4 + t * b5))))
    tail = F.lit(INV_SQRT_2PI) * F.exp(F.lit(-0.5) * ax * ax) * poly
    return F.when(x >= 0, tail).otherwise(F.lit(1.0) - tail)


def normal_sf_sql(z: str) -> str:
    """The identical expression as SQL text (oracle side)."""
    b1, b2, b3, b4, b5 = NORMAL_TAIL_B
    t = f"(1.0 / (1.0 + {NORMAL_TAIL_P} * abs({z})))"
    poly = f"({t} * ({b1} + {t} * ({b2} + {t} * ({b3} + {t} * ({b4} + {t} * {b5})))))"
    tail = f"({INV_SQRT_2PI!r} * exp(-0.5 * abs({z}) * abs({z})) * {poly})"
    return f"(CASE WHEN ({z}) >= 0 THEN {tail} ELSE 1.0 - {tail} END)"
