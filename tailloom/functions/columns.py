"""Column helpers for sequences, tails and measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAIL_CLASSES = ("A", "C", "G", "U", "Other", "GM")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def to_rna(seq: Column) -> Column:
    return F.translate(seq, "T", "U")


def to_dna(seq: Column) -> Column:
    return F.translate(seq, "U", "T")


def seed(seq: Column) -> Column:
    """Bases 2 to 8 as RNA."""
    return to_rna(F.substring(seq, 2, 7))


def classify_tail(tail: Column) -> Column:
    """GM for no tail, the base of a tail of one kind, else Other."""
    one = F.when(tail.rlike("^A+$"), "A").when(tail.rlike("^C+$"), "C").when(tail.rlike("^G+$"), "G").when(tail.rlike("^[TU]+$"), "U")
    return F.when(F.coalesce(tail, F.lit("")) == "", "GM").otherwise(F.coalesce(one, F.lit("Other")))


def arm_of(name: Column) -> Column:
    return F.substring_index(name, "-", -1)


def precursor_of(name: Column) -> Column:
    return F.regexp_replace(name, "-[35]p$", "")


def guarded_log(value: Column, base: float) -> Column:
    return F.when(value > 0, F.log(base, value)).otherwise(F.lit(0.0))


def gm() -> Column:
    return F.sum(F.when(F.col("tail_class") == "GM", F.col("ppm")).otherwise(0.0))


def pm() -> Column:
    return F.sum(F.when(F.col("tail_class") != "GM", F.col("ppm")).otherwise(0.0))


def of_tail(kind: str) -> Column:
    return F.sum(F.when(F.col("tail_class") == kind, F.col("ppm")).otherwise(0.0))


def tailing(gm_: Column, pm_: Column) -> Column:
    """Per cent of tailed reads; 0 where the whole is under 1."""
    return F.when(gm_ + pm_ < 1, 0.0).otherwise(pm_ * 100 / (gm_ + pm_))
