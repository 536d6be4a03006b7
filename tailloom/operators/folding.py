"""Reads held against the folded precursors that they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import precursor_of
from .intervals import BIN


def join_fold(annotated: DataFrame, folds: DataFrame) -> DataFrame:
    """Reads with the precursor of their annotation's name (arm left off) that they lie in.

    Adds pre_start, pre_end (0-based start, as in the fold table), entropy, and offset: the place of the read's
    5' end in the precursor, from 0.  A name may stand for very many precursors, so the join is by name and bin:
    that of the read's start, which is one of those that its precursor touches.
    """
    bins = F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor(F.greatest("start", "end") / BIN))).alias("_bin")
    pre = folds.select(F.col("name").alias("mir"), F.col("start").alias("pre_start"), F.col("end").alias("pre_end"), "entropy", bins)
    inside = (F.col("t_start") >= F.col("pre_start") + 1) & (F.col("t_end") <= F.col("pre_end") + 1)
    reads = annotated.withColumns({"mir": precursor_of(F.col("anno")), "_bin": F.floor((F.col("t_start") - 1) / BIN)})
    rows = reads.join(pre, ["mir", "_bin"]).where(inside).drop("_bin")
    return rows.withColumn("offset", F.when(F.col("strand") == "-", F.col("pre_end") + 1 - F.col("t_end")).otherwise(F.col("t_start") - F.col("pre_start") - 1))


def window_mean(values: Column, start: Column, length: int) -> Column:
    """Mean of ``length`` values from ``start`` (from 0), moved back from the end where it runs over; null if there are fewer."""
    n = F.size(values)
    at = F.least(start, n - length).cast("int")
    whole = (n >= length) & (at >= 0)  # slice() raises on a place under 1, wherever it is evaluated
    window = F.slice(values, F.when(whole, at + 1).otherwise(1), F.lit(length))
    return F.when(whole, F.aggregate(window, F.lit(0.0), lambda a, x: a + x) / length)


def fold_entropy(annotated: DataFrame, folds: DataFrame) -> DataFrame:
    """Mean entropy under the reads' first 8, next 4 and last 8 templated bases, by sample and annotation.

    Each read counts once, whatever its ppm; tail3 is over tailed reads only.
    """
    rows = join_fold(annotated, folds)
    last = window_mean(F.col("entropy"), F.col("offset") + 1 + F.col("gm_len") - 8, 8)
    means = rows.select("sample", "anno", "tail", window_mean(F.col("entropy"), F.col("offset"), 8).alias("w5"), window_mean(F.col("entropy"), F.col("offset") + 8, 4).alias("wm"), last.alias("w3"))
    tailed = F.when(F.coalesce(F.col("tail"), F.lit("")) != "", F.col("w3"))
    return means.groupBy("sample", "anno").agg(F.avg("w5").alias("e5"), F.avg("wm").alias("mid"), F.avg("w3").alias("e3"), F.avg(tailed).alias("tail3"))
