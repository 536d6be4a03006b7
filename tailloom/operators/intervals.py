"""Interval joins by bins, so that an overlap predicate is an equi-join with a residual.

Both sides are spread over the bins that they touch; a pair is kept in the first bin that both touch,
so nothing needs to be made distinct.  Features over ``LONG`` bins are spread like any other: their rows
grow with their own length only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 512


def _binned(df: DataFrame, start: Column, end: Column, size: int) -> DataFrame:
    low, high = F.floor(start / size), F.floor((end - 1) / size)
    return df.withColumn("_low", low).withColumn("_bin", F.explode(F.sequence(low, F.greatest(low, high))))


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[Column, Column], right_span: tuple[Column, Column], keys: list[str], size: int = BIN, how: str = "inner") -> DataFrame:
    """Rows of left and right with equal keys whose half-open spans overlap.

    ``how`` is inner, left_semi or left_anti; other columns' names must not clash.
    """
    a = _binned(left.withColumns({"_ls": left_span[0], "_le": left_span[1]}), F.col("_ls"), F.col("_le"), size).withColumnRenamed("_low", "_llow")
    b = _binned(right.withColumns({"_rs": right_span[0], "_re": right_span[1]}), F.col("_rs"), F.col("_re"), size).withColumnRenamed("_low", "_rlow")
    meets = (F.col("_ls") < F.col("_re")) & (F.col("_le") > F.col("_rs"))
    if how == "inner":
        joined = a.join(b, [*keys, "_bin"]).where(meets & (F.col("_bin") == F.greatest("_llow", "_rlow")))
        return joined.drop("_bin", "_llow", "_rlow", "_ls", "_le", "_rs", "_re")
    # an element may meet others in several bins: find the rows with a partner, filter by all their columns
    row = a.select("*", *(F.col(c).alias(f"_of_{c}") for c in left.columns))
    hit = row.join(b, [*keys, "_bin"]).where(meets).select(*(f"_of_{c}" for c in left.columns)).distinct()
    same = reduce(and_, (left[c].eqNullSafe(hit[f"_of_{c}"]) for c in left.columns))
    return left.join(hit, same, how)


def annotate_intervals(tags: DataFrame, features: DataFrame, stranded: bool = True, size: int = BIN) -> DataFrame:
    """Every tag with each feature it overlaps; tags are 1-based, features 0-based half-open."""
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    features = features if stranded else features.drop("strand")
    return overlap_join(tags, features, (F.col("t_start") - 1, F.col("t_end") - 1), (F.col("f_start"), F.col("f_end")), keys, size)


def annotate_starts(tags: DataFrame, features: DataFrame, longest: int, size: int = BIN) -> DataFrame:
    """annotate_intervals by strand for tags of at most ``longest``, with the bin of each tag's start (_bin).

    A tag is in that bin alone, and features are in those of all tags that may meet them.  So a tag's hits come from one
    partition of the join, and steps by chrom, strand, _bin and tag need no shuffle after it.
    """
    low = F.floor((F.col("f_start") - longest + 1) / size)
    spread = features.withColumn("_bin", F.explode(F.sequence(low, F.greatest(low, F.floor((F.col("f_end") - 1) / size)))))
    meets = (F.col("t_start") - 1 < F.col("f_end")) & (F.col("t_end") - 1 > F.col("f_start"))
    return tags.withColumn("_bin", F.floor((F.col("t_start") - 1) / size)).join(spread, ["chrom", "strand", "_bin"]).where(meets)


def assign_arm(hits: DataFrame) -> DataFrame:
    """Names of miRNA and mirtron hits without an arm get one by the midpoints; each hit uses its own feature."""
    right = F.col("t_start") + F.col("t_end") > F.col("f_start") + F.col("f_end")
    arm = F.when((F.col("strand") == "+") == right, "-3p").otherwise("-5p")
    without = F.col("biotype").isin("miRNA", "mirtron") & ~F.col("name").rlike("-[35]p$")
    return hits.withColumn("name", F.when(without, F.concat("name", arm)).otherwise(F.col("name")))


def exclude_overlapping(features: DataFrame, blockers: DataFrame, size: int = BIN) -> DataFrame:
    """Features that overlap no blocker of their chrom and strand (ends inclusive)."""
    b = blockers.select("chrom", "strand", F.col("f_start").alias("b_start"), F.col("f_end").alias("b_end"))
    return overlap_join(features, b, (F.col("f_start"), F.col("f_end") + 1), (F.col("b_start"), F.col("b_end") + 1), ["chrom", "strand"], size, "left_anti")


def retype_trna(features: DataFrame) -> DataFrame:
    """Biotypes that contain tRNA become tRNA, and go before the name."""
    of_trna = F.col("biotype").contains("tRNA")
    name = F.when(of_trna, F.concat_ws("_", "biotype", "name")).otherwise(F.col("name"))
    return features.withColumns({"name": name, "biotype": F.when(of_trna, "tRNA").otherwise(F.col("biotype"))})


def assemble_features(genes: DataFrame, mirtrons: DataFrame, *others: DataFrame, size: int = BIN) -> DataFrame:
    """One table of features: genes without the miRNAs that meet a mirtron, mirtrons and the others, tRNA retyped."""
    is_mir = F.col("biotype").eqNullSafe("miRNA")
    out = genes.where(~is_mir).unionByName(exclude_overlapping(genes.where(is_mir), mirtrons, size)).unionByName(mirtrons)
    for other in others:
        out = out.unionByName(other)
    return retype_trna(out)


def annotate_variants(variants: DataFrame, features: DataFrame, slots: dict[str, str], size: int = BIN) -> DataFrame:
    """Variants with a column for each slot: the name of the last feature of its biotype that they overlap, else '.'."""
    hits = overlap_join(variants, features.drop("strand"), (F.col("pos") - 1, F.col("pos") - 1 + F.length("ref")), (F.col("f_start"), F.col("f_end")), ["chrom"], size)
    last = F.struct("db_idx", "f_start", "f_end", "name")
    picked = hits.groupBy("variant_id").agg(*(F.max(F.when(F.col("biotype") == b, last)).getField("name").alias(s) for s, b in slots.items()))
    return variants.join(picked, "variant_id", "left").fillna(".", list(slots))
