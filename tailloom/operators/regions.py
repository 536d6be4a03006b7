"""Regions of reads: clusters of a bounded length, pileups, and chains of seeds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import arm_of, precursor_of, seed, to_rna
from ..storage import written

SEED = 7
#: Places of a bin: distinct reads that begin in one are bounded by it and by their lengths.
BIN = 1 << 16


def running_max(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str, width: int, before: bool = False) -> DataFrame:
    """Adds the largest value up to each row (before: of the rows before it) among rows of the same keys.

    order begins with a place; null values don't count.  Windows run within bins of that many places, and what the bins before hold
    comes from a table of a row for each bin, so that no window runs over a chromosome's rows.
    """
    binned = rows.withColumn("_bin", F.floor(F.col(order[0]) / width))
    top = binned.groupBy(*keys, "_bin").agg(F.max(value).alias("_top"))
    carried = F.max("_top").over(Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    w = Window.partitionBy(*keys, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    within = binned.withColumn("_within", F.max(value).over(w))
    found = within.join(top.select(*keys, "_bin", carried.alias("_carried")), [*keys, "_bin"])
    return found.withColumn(name, F.greatest("_within", "_carried")).drop("_bin", "_top", "_within", "_carried")


def islands(regions: DataFrame, keys: list[str], gap: int = 0, width: int = BIN) -> DataFrame:
    """Adds island to distinct regions: the first start of those that no gap (of more than ``gap``) parts."""
    reached = running_max(regions, keys, ["t_start", "t_end"], "t_end", "_reach", width, before=True)
    head = F.when(F.coalesce(F.col("t_start") > F.col("_reach") + gap, F.lit(True)), F.col("t_start"))
    return running_max(reached.withColumn("_head", head), keys, ["t_start", "t_end"], "_head", "island", width).drop("_reach", "_head")


def _next_heads(found: DataFrame, keys: list[str], max_merge: int) -> DataFrame:
    """The island that begins the next cluster after each island (i_start), if it begins one: the first after it whose first region ends more than max_merge past its start.

    Ends and the places they must lie past are put in one order, by bins of max_merge; past a bin, the next one's first end counts.
    """
    width = max(1, max_merge)
    ends = found.select(*keys, F.col("first_end").alias("at"), F.struct("first_end", "i_start").alias("held"), F.lit(None).cast("long").alias("asks"))
    asks = found.select(*keys, F.greatest(F.col("i_start") + max_merge, "first_end").alias("at"), F.lit(None).cast("struct<first_end:bigint,i_start:bigint>").alias("held"), F.col("i_start").alias("asks"))
    both = ends.union(asks).withColumn("_bin", F.floor(F.col("at") / width))
    first = both.groupBy(*keys, "_bin").agg(F.min("held").alias("_first"))
    later = F.min("_first").over(Window.partitionBy(*keys).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1))
    # at equal places an end doesn't lie past what asks, so what asks comes first in the order from the last
    w = Window.partitionBy(*keys, "_bin").orderBy(F.desc("at"), F.col("asks").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_near", F.min("held").over(w)).where("asks is not null")
    answered = near.join(first.select(*keys, "_bin", later.alias("_later")), [*keys, "_bin"])
    return answered.select(*keys, F.col("asks").alias("i_start"), F.coalesce("_near", "_later").getField("i_start").alias("next")).where("next is not null")


def merge_regions(regions: DataFrame, max_merge: int, width: int = BIN) -> DataFrame:
    """Regions of a sample and chromosome in clusters, with each cluster's extent and ppm.

    In order of start and end, a region begins a new cluster where a gap parts it from all before it and the
    cluster would come to be longer than ``max_merge`` with it.  Where two islands are cut depends on where their
    cluster began.  So each island first finds the one that would begin the next cluster after it; pointers are
    then doubled, round by round, and reach every head from each chromosome's first island in as many rounds as
    the logarithm of its clusters.  No window or group is larger than a bin.
    """
    keys = ["sample", "chrom"]
    distinct = written(regions.groupBy(*keys, "t_start", "t_end").agg(F.sum("ppm").alias("ppm")))
    first = F.min(F.struct("t_start", "t_end")).getField("t_end")
    found = islands(distinct, keys, 0, width).groupBy(*keys, F.col("island").alias("i_start")).agg(first.alias("first_end"), F.max("t_end").alias("i_end"), F.sum("ppm").alias("ppm"))
    found = written(found)
    jump = written(_next_heads(found, keys, max_merge))
    heads = written(found.groupBy(*keys).agg(F.min("i_start").alias("i_start")))
    held = heads.count()
    while True:
        heads = written(heads.union(heads.join(jump, [*keys, "i_start"]).select(*keys, "next")).distinct())
        n = heads.count()
        if n == held:
            break
        held = n
        jump = written(jump.join(jump.toDF(*keys, "next", "after"), [*keys, "next"]).select(*keys, "i_start", F.col("after").alias("next")))
    marked = found.join(heads.withColumn("head", F.col("i_start")), [*keys, "i_start"], "left")
    placed = running_max(marked, keys, ["i_start"], "head", "cluster", width)
    return placed.groupBy(*keys, "cluster").agg(F.min("i_start").alias("m_start"), F.max("i_end").alias("m_end"), F.sum("ppm").alias("ppm")).drop("cluster")


def region_extents(reads: DataFrame, by: list[str], extend: int = 10) -> DataFrame:
    """r_start and r_end of each region: the reads with equal ``by``, from the first start to the last end.

    ``extend`` more is taken on both sides, as far as the chromosome's first base.
    """
    return reads.groupBy(*by).agg(F.greatest(F.min("t_start") - extend, F.lit(1)).alias("r_start"), (F.max("t_end") + extend).alias("r_end"))


def region_pileup(reads: DataFrame, by: list[str], extend: int = 10, anchor: tuple[str, str] | None = None) -> DataFrame:
    """Reads of each region (see region_extents; ``by`` holds chrom and strand) in order of place, length and ppm.

    offset is the distance of a read's 5' end from the region's, or from that of the precursor whose 0-based start
    and end are the columns in ``anchor``.
    """
    rows = reads.join(region_extents(reads, by, extend), by)
    low, high = (F.col(anchor[0]) + 1, F.col(anchor[1]) + 1) if anchor else (F.col("r_start"), F.col("r_end"))
    offset = F.when(F.col("strand") == "-", high - F.col("t_end")).otherwise(F.col("t_start") - low)
    shown = F.when(F.coalesce(F.col("tail"), F.lit("")) == "", ".").otherwise(to_rna(F.col("tail")))
    arm = F.when(F.col("name").rlike("-[35]p$"), arm_of(F.col("name"))).otherwise(".")
    out = rows.select(*by, "r_start", "r_end", "tag_id", "sample", offset.alias("offset"), F.col("gm_len").alias("read_len"), "ppm", "is_flagged", arm.alias("arm"), seed(F.col("seq")).alias("seed"), shown.alias("tail"), "mismatch_pos")
    return out.orderBy(*by, "offset", F.desc("read_len"), F.desc("ppm"), "tag_id")


def region_expression(reads: DataFrame, by: list[str]) -> DataFrame:
    """Sum of ppm of each region's reads, by sample."""
    return reads.groupBy("sample", *by).agg(F.sum("ppm").alias("ppm"))


def chain(seeds: list[str], most: int = 6, least: int = 3) -> str:
    """One reference of seeds, the first of which begins it.

    Each next seed is laid over the end, else the start, by an overlap from ``most`` down to ``least`` bases that
    lies in the last ``most`` bases of what it continues; a seed without any is left out.  After a seed is laid,
    the next starts at that overlap; after one is left out, at ``most``.
    """
    ref, overlap = seeds[0], most
    for s in seeds[1:]:
        while overlap >= least:
            if (at := ref[-most:].find(s[:overlap])) >= 0:
                ref = ref[: max(len(ref) - most, 0) + at] + s
                break
            if (at := s[-most:].find(ref[:overlap])) >= 0:
                ref = s[: max(len(s) - most, 0) + at] + ref
                break
            overlap -= 1
        else:
            overlap = most
    return ref


def seed_chain(iso: DataFrame) -> DataFrame:
    """mir, arm, seed and place (of its last occurrence) in the reference chained of a precursor arm's seeds.

    Seeds go by their ppm over all samples, ties by name.  There are at most 4 ** 7 seeds in a group.
    """
    rows = iso.select(precursor_of(F.col("anno")).alias("mir"), arm_of(F.col("anno")).alias("arm"), "seed", "ppm").where(F.col("arm").isin("5p", "3p") & (F.length("seed") == SEED))
    levels = rows.groupBy("mir", "arm", "seed").agg(F.round(F.sum("ppm"), 6).alias("ppm"))

    def places(frame: pd.DataFrame) -> pd.DataFrame:
        ref = chain(frame.sort_values(["ppm", "seed"], ascending=[False, True])["seed"].tolist())
        at = {ref[i : i + SEED]: i for i in range(len(ref) - SEED + 1)}
        return pd.DataFrame({"mir": frame["mir"].iat[0], "arm": frame["arm"].iat[0], "seed": list(at), "place": list(at.values())})

    return levels.groupBy("mir", "arm").applyInPandas(places, "mir string, arm string, seed string, place int")
