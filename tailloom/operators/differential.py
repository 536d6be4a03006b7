"""Significance of folds between two samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profiles import placed

#: Terms of the continued fraction, an even number: 24 give a relative error of 1e-14 for values up to 10^6 ppm.
TERMS = 28


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for z over 0: Stirling's series at z + 8, less the logarithm of z (z + 1) ... (z + 7)."""
    far, below = z + 8, z
    for i in range(1, 8):
        below = below * (z + i)
    over = 1 / (far * far)
    series = (1 / 12.0 + over * (-1 / 360.0 + over * (1 / 1260.0 + over * (-1 / 1680.0 + over * (1 / 1188.0))))) / far
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function for 0 < x < 1: its continued fraction, from the last term to the first.

    The fraction converges fast where x is under (a + 1) / (a + b + 2); past that, the other side's is taken from 1.
    """
    swap = x > (a + 1) / (a + b + 2)
    pick = F.struct(F.when(swap, b).otherwise(a).alias("a"), F.when(swap, a).otherwise(b).alias("b"), F.when(swap, 1 - x).otherwise(x).alias("x"), swap.alias("swap"))

    def part(v: Column) -> Column:
        a, b, x = v["a"], v["b"], v["x"]
        front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x)) / a

        def term(after: Column, k: Column) -> Column:
            m = F.floor(k / 2).cast("double")
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.when(k % 2 == 0, even).otherwise(odd) / (1 + after)

        value = front / (1 + F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(0.0), term))
        return F.when(v["swap"], 1 - value).otherwise(value)

    return F.transform(F.array(pick), part)[0]  # names the picked values once


def fold_p(high: Column, low: Column) -> Column:
    """p of a fold high / low, both at least 1 and high the larger."""
    fold = high / low
    return 1 - incomplete_beta(3.26 + F.log(high), 1.63 + F.log(low), fold / (1 + fold))


def with_p(folds: DataFrame) -> DataFrame:
    """p of each row of pairwise folds, from x + 1 and y + 1."""
    x, y = F.col("x") + 1, F.col("y") + 1
    return folds.withColumn("p", fold_p(F.greatest(x, y), F.least(x, y)))


def differential_summary(folds: DataFrame, totals: DataFrame, keys: tuple[str, ...] = ("anno",)) -> DataFrame:
    """total over samples and the smallest p over pairs (rows of with_p) of each of the keys, with the place in their order.

    That is by total from the largest, then p, then name from the last; see profiles.placed for its bound.
    """
    total = totals.groupBy(*keys).agg(F.round(F.sum("ppm"), 6).alias("total"))
    rows = total.join(folds.groupBy(*keys).agg(F.min("p").alias("min_p")), list(keys))
    return placed(rows, F.desc("total"), F.asc("min_p"), *(F.desc(k) for k in reversed(keys)))
