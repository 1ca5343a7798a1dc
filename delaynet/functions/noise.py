"""Laplace noise as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaynet.functions.hashing import unit_interval


def laplace(scale: Column | float, uniform: Column) -> Column:
    """Laplace(0, scale) by inverse distribution from `uniform` in (-0.5, 0.5)."""
    if isinstance(scale, (int, float)):
        if scale <= 0:
            raise ValueError(f"noise has a positive scale, not {scale}")
        scale = F.lit(float(scale))
    return -scale * F.signum(uniform) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(uniform))


def random_uniform() -> Column:
    """A fresh draw per row. Draws of exactly 0 would leave the open interval."""
    return F.greatest(F.rand(), F.lit(2.0**-54)) - F.lit(0.5)


def keyed_uniform(*parts: Column) -> Column:
    """Repeatable draw for tests and checked queries; never use it for a release."""
    return unit_interval(F.concat_ws("|", *[part.cast("string") for part in parts]))


def noisy(value: Column, epsilon: Column, sensitivity: float, uniform: Column, clamp: float | None = 0.0) -> Column:
    result = value + laplace(F.lit(float(sensitivity)) / epsilon, uniform)
    return result if clamp is None else F.greatest(F.lit(float(clamp)), result)
