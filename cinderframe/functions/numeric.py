"""Numeric helpers: missing is NULL inside the engine, NaN at its edges; infinities are values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def ieee_div(n: Column, d: Column) -> Column:
    """n / d as floating point hardware does it: a zero denominator gives an infinity, or NULL for 0 / 0, and no error."""
    return F.when(d != 0, n / F.nullif(d, F.lit(0.0))).when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))


def f32(x: Column) -> Column:
    """Rounded to single precision; after each + - * / of two singles this is what single-precision hardware gives."""
    return x.cast("float")


def trunc0(x: Column) -> Column:
    return F.signum(x) * F.floor(F.abs(x)).cast("double")


def trunc_scaled(x: Column, scale: float = 1000.0, digits: int | None = None) -> Column:
    """x * scale cut toward zero; with digits, noise below them is rounded away first, so that it can't flip a unit."""
    scaled = x * scale
    return trunc0(scaled if digits is None else F.round(scaled, digits))


def floor2(x: Column, digits: int | None = None) -> Column:
    """x cut down to hundredths, in single precision; with digits, in double precision after rounding noise below them away."""
    if digits is None:
        return f32(F.floor(f32(f32(x).cast("double") * 100)).cast("double") / 100).cast("double")
    return F.floor(F.round(x * 100, digits)).cast("double") / 100


def round_binary(x: Column, digits: int) -> Column:
    """x rounded half away from zero as x * 10^digits in floating point, as DuckDB does it; F.round rounds x's shortest decimal.

    They differ where the product lands on a half, or is so large that it loses bits. Where it is infinite, x stays.
    """
    scale = F.lit(10.0**digits)
    a = F.abs(x * scale)
    low = F.floor(a).cast("double")
    up = F.when(a - low >= 0.5, low + 1.0).otherwise(low)
    return F.when(a < F.lit(2.0**52), F.signum(x) * up / scale).when(a < F.lit(INF), x * scale / scale).otherwise(x)


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != INF)


def clip(x: Column, low: float, high: float) -> Column:
    """x within [low, high]; NULL stays NULL."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))
