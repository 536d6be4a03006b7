"""Targets of isoforms by predicted seed matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import to_dna


def join_targets(targets: DataFrame, names: DataFrame) -> DataFrame:
    """anno, seed (as DNA), gene and pct of the predictions (mir, seed, gene, pct) whose mir has a name in names (mir, anno)."""
    by = targets.select("mir", to_dna(F.col("seed")).alias("seed"), "gene", "pct")
    return by.join(names.select("mir", "anno").distinct(), "mir").select("anno", "seed", "gene", "pct").distinct()


def preference_targets(preferences: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct targets of the isoforms that a sample prefers or avoids.

    An isoform is name_seed, with the mismatches of its seed after a bar, which take no part.
    """
    plain = F.substring_index("anno", "|", 1)
    isoforms = preferences.select("sample", "kind", F.substring_index(plain, "_", 1).alias("anno"), to_dna(F.get(F.split(plain, "_"), F.lit(1))).alias("seed"))
    return isoforms.join(targets, ["anno", "seed"]).select("sample", "kind", "gene", "pct").distinct()
