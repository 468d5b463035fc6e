"""Feature bounds, cleaning and the synthetic income."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the synthetic income.
INCOME_FLOOR = 15000.0
INCOME_PER_VOLUME = 1.5
NOISE_MU, NOISE_SIGMA = 9.5, 0.5

MAX_REGULARITY = 30


def _number(c: Column) -> Column:
    """The column as a double, NaN as NULL (Spark would sort NaN above every bound)."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def _finite(c: Column) -> Column:
    return F.when(F.abs(c) != float("inf"), c)


def bounded(name: str) -> Column:
    """One training feature within its bounds; missing, NaN and what stays infinite is NULL."""
    value = _number(F.col(name))
    if name == "monthly_volume":
        value = F.when(value < 0, F.lit(0.0)).otherwise(value)
    elif name == "session_regularity":
        value = (
            F.when(value < 0, F.lit(0.0))
            .when(value > MAX_REGULARITY, F.lit(float(MAX_REGULARITY)))
            .otherwise(value)
        )
    elif name == "income":
        value = F.when(value >= 0, value)
    return _finite(value).alias(name)


def uniform(key: Column, seed: int, part: int = 0) -> Column:
    """A number in [0, 1) fixed by key and seed: the same on every run and partitioning."""
    digits = F.substring(F.md5(F.concat_ws("|", key, F.lit(str(seed)))), 1 + 8 * part, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**32))


def standard_normal(key: Column, seed: int) -> Column:
    """Box-Muller on two hash-based uniforms."""
    u = uniform(key, seed, 0) + F.lit(1.0 / 2**32)
    v = uniform(key, seed, 1)
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2 * math.pi) * v)


def synthetic_income(volume: Column, key: Column, seed: int = 42) -> Column:
    """max(15000, 1.5 x volume + log-normal noise), the noise fixed by ``key`` and ``seed``."""
    noise = F.exp(F.lit(NOISE_MU) + F.lit(NOISE_SIGMA) * standard_normal(key, seed))
    return F.greatest(F.lit(INCOME_FLOOR), F.lit(INCOME_PER_VOLUME) * volume + noise)
