"""Normalisation, ranks, differences and profiles over the fact table of expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import TAIL_CLASSES, arm_of, classify_tail, precursor_of, to_rna
from ..storage import parts, written
from .regions import islands
from .sequences import extract_sequence
from .tags import tagged_places


def annotation_totals(iso: DataFrame) -> DataFrame:
    return iso.groupBy("sample", "anno").agg(F.round(F.sum("ppm"), 6).alias("ppm"))


def trim_rank_band(iso: DataFrame, low: int = 15, high: int = 85, keys: tuple[str, ...] = ("anno",)) -> DataFrame:
    """Annotations (or isoforms, by keys) whose rank by total is in the band (per cent, integer arithmetic), without those equal to the least.

    The rank is over all annotations, of which there are as many as the feature files name (and 4 ** 7 seeds of each at most).
    """
    total = iso.groupBy(*keys).agg(F.round(F.sum("ppm"), 6).alias("t"))
    order = total.withColumn("n", F.count("*").over(Window.partitionBy())).withColumn("r", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("t", *keys)))
    least = F.min("t").over(Window.partitionBy())
    kept = order.withColumn("least", least).where(f"r > n * {low} div 100 and r <= n * {high} div 100 and t > least")
    return iso.join(kept.select(*keys), list(keys), "left_semi")


def quantile_normalize(iso: DataFrame) -> DataFrame:
    """ppm scaled so that samples share one distribution of annotation totals; ties share their ranks' mean."""
    totals = iso.groupBy("sample", "anno").agg(F.sum("ppm").alias("exact")).withColumn("ppm", F.round("exact", 6))
    ranked = totals.withColumn("r", F.row_number().over(Window.partitionBy("sample").orderBy("ppm", "anno")))
    means = ranked.groupBy("r").agg(F.avg("ppm").alias("m"))
    back = ranked.join(means, "r").withColumn("norm", F.avg("m").over(Window.partitionBy("sample", "ppm")))
    scale = back.select("sample", "anno", (F.col("norm") / F.col("exact")).alias("scale"))
    return iso.join(scale, ["sample", "anno"]).withColumn("ppm", F.col("ppm") * F.col("scale")).drop("scale")


def tmm_normalize(totals: DataFrame, m_trim: float = 30.0, a_trim: float = 5.0, trim_mean: float = 1.0) -> DataFrame:
    """ppm scaled by each sample's trimmed mean of log ratios to a uniform reference, which comes as column tmm.

    Values at 0 take no part.  Both trims (per cent at each end) go by rank; the log ratio and the mean log level
    against a uniform reference rise with the value alone, so that one order serves both.  tmm is null, and so is
    the scaled value, where the weighted mean is not over 0 (a sample of one annotation, for instance).
    """
    w = Window.partitionBy("sample")
    ranked = totals.where("ppm > 0").withColumns({"i": F.row_number().over(w.orderBy("ppm", "anno")) - 1, "n": F.count("*").over(w), "whole": F.sum("ppm").over(w)})
    cut = F.col("n") * max(m_trim, a_trim) / 100
    kept = (F.col("i") >= cut) & (F.col("i") <= F.col("n") - cut)
    ratio = F.when(F.col("n") > 1, F.log2(F.col("ppm") / F.col("whole")) / F.log2(1 / F.col("n")))
    weight = (F.col("whole") - F.col("ppm")) / (F.col("whole") * F.col("ppm")) + (F.col("n") - 1) / (F.col("n") * trim_mean)
    mean = F.sum(F.when(kept, weight * ratio)).over(w) / F.nullif(F.sum(F.when(kept, weight)).over(w), F.lit(0.0))
    scaled = ranked.withColumn("tmm", F.sqrt(F.when(mean > 0, mean)))
    return scaled.select("sample", "anno", (F.col("ppm") * 1e6 / (F.col("whole") * F.col("tmm"))).alias("ppm"), "tmm")


def normalized_expression(iso: DataFrame) -> DataFrame:
    """Totals by annotation (seed null) and by isoform."""
    return iso.groupingSets([["sample", "anno"], ["sample", "anno", "seed"]], "sample", "anno", "seed").agg(F.sum("ppm").alias("ppm"))


def rank_report(totals: DataFrame) -> DataFrame:
    return totals.withColumn("rank", F.row_number().over(Window.partitionBy("sample").orderBy("ppm", "anno")))


def rank_sum(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("anno").agg(F.sum("rank").alias("rank_sum"))


def rank_sum_tokens(table: DataFrame, *keys: str) -> DataFrame:
    """token, keys, rank_sum and place of the four tokens of a token table by sample and keys: places by the sum of ranks, then keys, from the last."""
    tokens = F.explode(F.array(*(F.struct(F.lit(t).alias("token"), F.round(t, 6).alias("value")) for t in ("gmpm", "gm", "pm", "tailing")))).alias("x")
    each = table.select("sample", *keys, tokens).select("sample", *keys, "x.token", "x.value")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("token", "sample").orderBy("value", *keys)))
    summed = ranked.groupBy("token", *keys).agg(F.sum("rank").alias("rank_sum"))
    return summed.withColumn("place", F.row_number().over(Window.partitionBy("token").orderBy(F.desc("rank_sum"), *map(F.desc, keys))))


def sample_pairs(samples: DataFrame) -> DataFrame:
    """All unordered pairs of samples, of which there are few."""
    return samples.select(F.col("sample").alias("s1")).join(samples.select(F.col("sample").alias("s2")), F.col("s1") < F.col("s2"))


def pairwise_fold(totals: DataFrame, keys: tuple[str, ...] = ("anno",)) -> DataFrame:
    """fold = (x+1)/(y+1) for each annotation (or other keys) and pair of samples, both ways; a missing value is 0."""
    samples = totals.select("sample").distinct()
    pairs = sample_pairs(samples)
    both = pairs.union(pairs.select("s2", "s1"))
    values = totals.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("sample", "ppm"))).alias("v"))  # as long as the list of samples
    out = values.crossJoin(F.broadcast(both))  # as many pairs as the samples give
    value = lambda s: F.coalesce(F.try_element_at("v", F.col(s)), F.lit(0.0))
    out = out.select(*keys, "s1", "s2", value("s1").alias("x"), value("s2").alias("y")).where("x > 0 or y > 0")
    return out.withColumn("fold", (F.col("x") + 1) / (F.col("y") + 1)).withColumn("total", F.col("x") + F.col("y"))


def preference_sets(folds: DataFrame, fold: float = 2.0, max_p: float | None = 0.05, keys: tuple[str, ...] = ("anno",)) -> DataFrame:
    """Annotations whose fold against every other sample is at least ``fold`` (UniLike) or at most its inverse (DisLike).

    Folds whose p (a column of folds, unless max_p is None) is over ``max_p`` count neither way.
    """
    n = folds.select(F.count_distinct("s1").alias("n"))
    sure = F.lit(True) if max_p is None else F.col("p") <= max_p
    by = folds.groupBy(*keys, "s1").agg(F.count_if(sure & (F.col("fold") >= fold)).alias("up"), F.count_if(sure & (F.col("fold") <= 1 / fold)).alias("down"))
    kind = F.when(F.col("up") == F.col("n") - 1, "UniLike").when(F.col("down") == F.col("n") - 1, "DisLike")
    return by.crossJoin(F.broadcast(n)).select(*keys, F.col("s1").alias("sample"), kind.alias("kind")).where("kind is not null")


def loading_difference(totals: DataFrame) -> DataFrame:
    """(max - min) / min over all samples, with the samples; ties go to the first sample.

    A sample that lacks an annotation has 0 of it, and the least value counts as 1e-6 at least.  The difference is
    negative if any third sample lies as far above the least as the least itself, or above a least of 0.
    """
    samples = totals.agg(F.array_sort(F.collect_set("sample")).alias("samples"))  # one row, as long as the list of samples
    by = totals.groupBy("anno").agg(F.sum("ppm").alias("total"), F.map_from_entries(F.collect_list(F.struct("sample", "ppm"))).alias("v"))
    value = lambda s: F.coalesce(F.try_element_at("v", s), F.lit(0.0))
    by = by.crossJoin(F.broadcast(samples)).select("anno", "total", F.transform("samples", lambda s: F.struct(value(s).alias("v"), s.alias("sample"))).alias("held"))
    high = F.array_min(F.transform("held", lambda x: F.struct((-x["v"]).alias("v"), x["sample"].alias("sample"))))
    by = by.select("anno", "total", "held", high.alias("hi"), F.array_min("held").alias("lo"))
    third = lambda x: ~x["sample"].isin(F.col("hi.sample"), F.col("lo.sample")) & F.when(F.col("lo.v") > 0, x["v"] >= 2 * F.col("lo.v")).otherwise(x["v"] > 0)
    low = F.greatest(F.col("lo.v"), F.lit(1e-6))
    diff = (-F.col("hi.v") - low) / low * F.when(F.exists("held", third), -1).otherwise(1)
    return by.select("anno", "total", F.when(F.col("total") > 0, diff).otherwise(0.0).alias("diff"), F.col("hi.sample").alias("max_sample"), F.col("lo.sample").alias("min_sample"))


def length_difference(iso: DataFrame) -> DataFrame:
    """Modal length of each sample, and the largest difference between samples."""
    by = iso.groupBy("anno", "sample", "read_len").agg(F.round(F.sum("ppm"), 6).alias("ppm"))
    modal = by.groupBy("anno", "sample").agg(F.min(F.struct((-F.col("ppm")).alias("v"), "read_len")).getField("read_len").alias("len"))
    return modal.groupBy("anno").agg((F.max("len") - F.min("len")).alias("diff"), F.max("len").alias("len_max"), F.min("len").alias("len_min"))


def length_difference_samples(iso: DataFrame) -> DataFrame:
    """length_difference's diff, with the samples in order and the modal length of each, joined by commas."""
    by = iso.groupBy("anno", "sample", "read_len").agg(F.round(F.sum("ppm"), 6).alias("ppm"))
    modal = by.groupBy("anno", "sample").agg(F.min(F.struct((-F.col("ppm")).alias("v"), "read_len")).getField("read_len").alias("len"))
    held = modal.groupBy("anno").agg((F.max("len") - F.min("len")).alias("diff"), F.array_sort(F.collect_list(F.struct("sample", "len"))).alias("held"))  # as long as the list of samples
    return held.select("anno", "diff", F.array_join("held.sample", ",").alias("samples"), F.array_join(F.col("held.len").cast("array<string>"), ",").alias("lengths"))


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with their place in an order, from 1: for reports of a row for each annotation, which the feature files bound."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def order_by_total(rows: DataFrame, name: str = "anno") -> DataFrame:
    """Places by total, then name, both from the last."""
    return placed(rows, F.desc("total"), F.desc(name))


def order_difference(rows: DataFrame, name: str = "anno") -> DataFrame:
    """Places by total from the largest, then name."""
    return placed(rows, F.desc("total"), F.asc(name))


def arm_difference(iso: DataFrame) -> DataFrame:
    """Dominant arm of each sample by precursor; Y where the arms differ."""
    arms = iso.where(arm_of(F.col("anno")).isin("5p", "3p")).groupBy(precursor_of(F.col("anno")).alias("mir"), "sample", arm_of(F.col("anno")).alias("arm")).agg(F.round(F.sum("ppm"), 6).alias("ppm"))
    best = arms.groupBy("mir", "sample").agg(F.min(F.struct((-F.col("ppm")).alias("v"), "arm")).getField("arm").alias("arm"), F.sum("ppm").alias("t"))
    return best.groupBy("mir").agg(F.sum("t").alias("total"), F.when(F.count_distinct("arm") > 1, "Y").otherwise("N").alias("is_diff"))


def arm_report(iso: DataFrame) -> DataFrame:
    """arm_difference with the samples and their dominant arms, each joined by colons in order of samples."""
    arms = iso.where(arm_of(F.col("anno")).isin("5p", "3p")).groupBy(precursor_of(F.col("anno")).alias("anno"), "sample", arm_of(F.col("anno")).alias("arm")).agg(F.round(F.sum("ppm"), 6).alias("ppm"))
    best = arms.groupBy("anno", "sample").agg(F.min(F.struct((-F.col("ppm")).alias("v"), "arm")).getField("arm").alias("arm"), F.sum("ppm").alias("t"))
    held = F.array_sort(F.collect_list(F.struct("sample", "arm")))  # as long as the list of samples
    by = best.groupBy("anno").agg(F.sum("t").alias("total"), F.when(F.count_distinct("arm") > 1, "Y").otherwise("N").alias("diff"), held.alias("h"))
    return by.select("anno", "total", "diff", F.array_join("h.sample", ":").alias("samples"), F.array_join("h.arm", ":").alias("info"))


def filter_difference_rows(report: DataFrame, mode: str, min_len_diff: int = 0, fold: float = 0.0, max_expr: float = 0.0, min_expr: float = 0.0) -> DataFrame:
    """Rows of a difference report (anno, total, diff, samples, info; the last two joined by colons) in limits; 0 sets none.

    Arm: one row (anno, sample, arm) for each arm that only one sample of a flagged annotation has.  Length: a
    difference from ``min_len_diff`` up.  Loading: a rise from ``fold`` up, or a value at most ``fold`` if it isn't
    over 0; the annotation is split into name and seed, and the samples in two columns.
    """
    rows = report.where(F.col("total") >= min_expr) if min_expr else report
    rows = rows.where(F.col("total") <= max_expr) if max_expr else rows
    if mode == "Arm":
        arms, samples = F.split("info", ":"), F.split("samples", ":")
        each = rows.where("diff = 'Y'").select("anno", arms.alias("arms"), F.explode(F.arrays_zip(samples.alias("sample"), arms.alias("arm"))).alias("z"))
        return each.where(F.size(F.filter("arms", lambda a: a == F.col("z.arm"))) == 1).select("anno", "z.sample", "z.arm")
    if mode == "Length":
        return (rows.where(F.col("diff") >= min_len_diff) if min_len_diff else rows).select("anno", "diff", "samples", "info")
    if mode != "Loading":
        raise ValueError(f"unknown mode {mode!r}")
    rows = rows.where(F.when(F.col("diff") > 0, F.col("diff") >= fold).otherwise(F.col("diff") <= fold)) if fold else rows
    name, of = F.split("anno", "_"), F.split("samples", ":")
    return rows.select(F.get(name, F.lit(0)).alias("anno"), F.get(name, F.lit(1)).alias("seed"), "diff", F.get(of, F.lit(0)).alias("sample1"), F.get(of, F.lit(1)).alias("sample2"))


def boxplot_stats(totals: DataFrame, trim: float = 0.0) -> DataFrame:
    """Quartiles (element at floor((n-1)q)) of the values over 0, by sample, and those at the rates ``trim`` and 1 - trim (the least and the largest)."""
    w = Window.partitionBy("sample")
    ranked = totals.where("ppm > 0").withColumn("r", F.row_number().over(w.orderBy("ppm", "anno"))).withColumn("n", F.count("*").over(w))
    at = lambda q: F.max(F.when(F.col("r") == F.floor((F.col("n") - 1) * q) + 1, F.col("ppm")))
    return ranked.groupBy("sample").agg(at(trim).alias("lo"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"), at(1 - trim).alias("hi"))


def loading_trend(totals: DataFrame) -> DataFrame:
    return totals.select("sample", "anno", (F.col("ppm") / F.sum("ppm").over(Window.partitionBy("anno"))).alias("share"))


def end_heterogeneity(annotated: DataFrame) -> DataFrame:
    """ppm-weighted distance of 5' ends, 3' ends and 3' ends with their tails (h5, h3, h_tail) from the modal ends, by sample and annotation.

    The modal end has the most ppm, and of such the lowest coordinate.
    """
    plus, tail = F.col("strand") == "+", F.length(F.coalesce("tail", F.lit("")))
    end3 = F.when(plus, F.col("t_end")).otherwise(F.col("t_start"))
    ends = {"h5": F.when(plus, F.col("t_start")).otherwise(F.col("t_end")), "h3": end3, "h_tail": F.when(plus, end3 + tail).otherwise(end3 - tail)}
    each = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("e")) for kind in ends))).alias("x")
    reads = annotated.groupBy("sample", "anno", *(end.alias(kind) for kind, end in ends.items())).agg(F.sum("ppm").alias("ppm"))
    dealt = reads.repartition(parts(annotated), "sample", "anno")  # each place once; its three ends are made there
    by = dealt.select("sample", "anno", "ppm", each).groupBy("sample", "anno", "x.kind", "x.e").agg(F.round(F.sum("ppm"), 6).alias("p"))
    w = Window.partitionBy("sample", "anno", "kind")
    far = by.withColumn("mode", F.min(F.struct((-F.col("p")).alias("v"), "e")).over(w).getField("e"))
    of = lambda kind: (F.sum(F.when(F.col("kind") == kind, F.col("p") * F.abs(F.col("e") - F.col("mode")))) / F.sum(F.when(F.col("kind") == kind, F.col("p")))).alias(kind)
    return far.groupBy("sample", "anno").agg(*(of(kind) for kind in ends))


def tail_profile(annotated: DataFrame, *level: str) -> DataFrame:
    """ppm, mean tail length of tailed reads, their share, and the shares of tail classes among them, by sample, annotation and level (seed).

    Without tailed reads all are 0.
    """
    tail = F.coalesce("tail", F.lit(""))
    rows = annotated.withColumns({"_class": classify_tail(tail), "_tailed": F.when(tail != "", F.col("ppm")).otherwise(0.0)})
    part = lambda kind: F.sum(F.when(F.col("_class") == kind, F.col("ppm")).otherwise(0.0)).alias(f"f_{kind.lower()}")
    kinds = [k for k in TAIL_CLASSES if k != "GM"]
    by = rows.groupBy("sample", "anno", *level).agg(F.sum("ppm").alias("gmpm"), F.sum("_tailed").alias("pm"), F.sum(F.length(tail) * F.col("ppm")).alias("mean_tail_len"), *(part(k) for k in kinds))
    some = lambda value: F.when(F.col("pm") > 0, value).otherwise(0.0)
    shares = [some(F.col(c) / F.col("pm")).alias(c) for c in ("mean_tail_len", *(f"f_{k.lower()}" for k in kinds))]
    return by.select("sample", "anno", *level, some(F.col("gmpm")).alias("gmpm"), *shares, some(F.col("pm") / F.col("gmpm")).alias("tailing"))


def tail_bases(annotated: DataFrame) -> DataFrame:
    """ppm, untailed and tailed ppm, and tailed ppm by base, by sample, annotation and seed; a mixed tail counts by each base's share of it."""
    tail = to_rna(F.coalesce("tail", F.lit("")))
    tailed = lambda value: F.sum(F.when(F.length(tail) > 0, value).otherwise(0.0))
    bases = [tailed(F.col("ppm") * (F.length(tail) - F.length(F.replace(tail, F.lit(b)))) / F.length(tail)).alias(b.lower()) for b in "ACGU"]
    return annotated.groupBy("sample", "anno", "seed").agg(F.sum("ppm").alias("gmpm"), F.sum(F.when(F.length(tail) == 0, F.col("ppm")).otherwise(0.0)).alias("gm"), tailed(F.col("ppm")).alias("pm"), *bases)


def mismatch_kinds(tags: DataFrame) -> DataFrame:
    """ppm of mismatches (MD) and of T to C conversions (TC) at each place from 1, by sample; of tags with md_tag and tc_tag."""
    of = lambda tag, kind: F.coalesce(F.transform(tagged_places(tag, "base"), lambda m: F.struct(F.lit(kind).alias("kind"), m["at"].alias("at"))), F.array().cast("array<struct<kind:string,at:int>>"))
    each = tags.select("sample", F.explode(F.concat(of("md_tag", "MD"), of("tc_tag", "TC"))).alias("m"), "ppm")
    return each.groupBy("sample", "m.kind", (F.col("m.at") + 1).alias("pos")).agg(F.sum("ppm").alias("ppm"))


def mismatch_positions(tags: DataFrame) -> DataFrame:
    return tags.where("mismatch_pos is not null").groupBy("sample", F.col("mismatch_pos").alias("pos")).agg(F.sum("ppm").alias("ppm"))


def positional_composition(tags: DataFrame, positions: int = 8) -> DataFrame:
    """ppm by nucleotide at the leading positions of reads, by sample."""
    bases = F.posexplode(F.split(F.substring("seq", 1, positions), "")).alias("slot", "nt")
    return tags.select("sample", "ppm", bases).groupBy("sample", "slot", F.translate("nt", "T", "U").alias("nt")).agg(F.sum("ppm").alias("ppm"))


#: Slots of position_profile: 8 leading bases, the last 5 of tailed reads (from the end), and the 4 before the last of tailed and of untailed reads.
LEADING, LAST, TAILED_4N, PLAIN_4N = 8, 5, 13, 14


def position_profile(annotated: DataFrame) -> DataFrame:
    """ppm by base (RNA) in each of 15 slots, by sample, annotation and seed, of tags with md_tag and tc_tag.

    A read is its templated bases with its tail.  Mismatches show the read's base; a converted T stays U.  Reads are
    dealt by sample, annotation and seed, and spread to their slots there, so that no slots are shuffled.
    """
    whole, n = to_rna(F.concat("seq", F.coalesce("tail", F.lit("")))), F.length("_read")
    rows = annotated.select("sample", "anno", "seed", "ppm", whole.alias("_read"), "md_tag", "tc_tag", (F.length(F.coalesce("tail", F.lit(""))) > 0).alias("_tailed"))
    rows = rows.repartition(parts(annotated), "sample", "anno", "seed")
    at_most = lambda tag: F.coalesce(F.filter(tagged_places(tag, "base"), lambda m: m["at"] < n), F.array().cast("array<struct<at:int,base:string>>"))
    shown = lambda text, tag, base: F.aggregate(at_most(tag), text, lambda s, m: F.overlay(s, base(m), m["at"] + 1, F.lit(1)))
    # what the tags change is laid over the read
    changed = shown(F.col("_read"), "md_tag", lambda m: to_rna(m["base"]))
    rows = rows.withColumn("_shown", shown(changed, "tc_tag", lambda m: F.lit("U")))
    slot = lambda number, at: F.struct(F.lit(number).alias("slot"), at.cast("int").alias("at"))
    front = [slot(i, F.lit(i)) for i in range(LEADING)]
    back = [slot(LEADING + i, n - 1 - i) for i in range(LAST)] + [slot(TAILED_4N, n - 5 + i) for i in range(4)]
    each = F.when(F.col("_tailed"), F.array(*front, *back)).otherwise(F.array(*front, *(slot(PLAIN_4N, n - 5 + i) for i in range(4))))
    spread = rows.select("sample", "anno", "seed", "ppm", "_shown", F.explode(each).alias("x")).where((F.col("x.at") >= 0) & (F.col("x.at") < F.length("_shown")))
    return spread.groupBy("sample", "anno", "seed", "x.slot", F.substring("_shown", F.col("x.at") + 1, F.lit(1)).alias("nt")).agg(F.sum("ppm").alias("ppm"))


def merged_ranges(annotated: DataFrame, extend: int = 2) -> DataFrame:
    """Overlapping ranges (± extend) of an annotation merged; support is the number of distinct ranges."""
    key = ["anno", "chrom", "strand"]
    found = islands(annotated.select(*key, "t_start", "t_end").distinct(), key, 2 * extend)
    return found.groupBy(*key, "island").agg(F.min("t_start").alias("m_start"), F.max("t_end").alias("m_end"), F.count("*").alias("support")).drop("island")


def best_ranges(annotated: DataFrame, extend: int = 2) -> DataFrame:
    """The merged range that most tags of an annotation support (the first on a tie), with seed_end.

    Ranges are longer by ``extend`` at the 3' end, and merge where they meet.  seed_end lies 8 bases after the last 5' end.
    """
    key, plus = ["anno", "chrom", "strand"], F.col("strand") == "+"
    start, end = F.when(plus, F.col("t_start")).otherwise(F.col("t_start") - extend), F.when(plus, F.col("t_end") + extend).otherwise(F.col("t_end"))
    ranges = annotated.select(*key, start.alias("t_start"), end.alias("t_end")).groupBy(*key, "t_start", "t_end").agg(F.count("*").alias("n"))
    found = islands(ranges, key).groupBy(*key, "island")
    merged = found.agg(F.max("t_end").alias("r_end"), F.sum("n").alias("support"), (F.max("t_start") + 8).alias("after"), (F.min("t_end") - 8).alias("before"))
    merged = merged.select(*key, F.col("island").alias("r_start"), "r_end", F.when(plus, F.col("after")).otherwise(F.col("before")).alias("seed_end"), "support")
    best = F.min(F.struct((-F.col("support")).alias("v"), "chrom", "strand", "r_start", "r_end", "seed_end")).alias("b")
    return merged.groupBy("anno").agg(best).select("anno", "b.chrom", "b.r_start", "b.r_end", "b.strand", "b.seed_end", (-F.col("b.v")).alias("support"))


def seed_sequences(best: DataFrame, iso: DataFrame, genome: DataFrame, size: int) -> DataFrame:
    """mir, mean ppm over samples, and the seeds of both arms at their best ranges (null where there is none), as RNA."""
    plus = F.col("strand") == "+"
    cut = best.withColumns({"at": F.when(plus, F.col("r_start")).otherwise(F.col("seed_end") - 1), "bases": F.when(plus, F.col("seed_end") - F.col("r_start")).otherwise(F.col("r_end") - F.col("seed_end")) - 1})
    arms = cut.select("chrom", "strand", "at", "bases", precursor_of(F.col("anno")).alias("mir"), arm_of(F.col("anno")).alias("arm")).where(F.col("arm").isin("5p", "3p"))
    found = extract_sequence(arms, genome, "at", "bases", size).withColumn("sequence", to_rna(F.col("sequence")))
    of = lambda arm: F.max(F.when(F.col("arm") == arm, F.col("sequence")))
    samples = iso.agg(F.count_distinct("sample").alias("samples"))  # one row
    ppm = iso.groupBy(precursor_of(F.col("anno")).alias("mir")).agg(F.sum("ppm").alias("ppm")).crossJoin(F.broadcast(samples))
    seeds = found.groupBy("mir").agg(of("5p").alias("seed5"), of("3p").alias("seed3"))
    return seeds.join(ppm, "mir").select("mir", (F.col("ppm") / F.col("samples")).alias("mean_ppm"), "seed5", "seed3")


def _depths(reads: DataFrame, key: list[str], width: int, n: int, points: Column | None = None) -> DataFrame:
    """Runs of positions (first to next) of equal depth, with ppm and templated, and with the sums of points at their first position.

    reads have key, the places that they cover (low, high) and their templated ones (t_start, t_end).  They are dealt by
    key and bin of positions to n partitions, and give events at their ends, or at the bin's, there: neither events nor positions are shuffled.
    """
    bins = F.sequence(F.floor(F.col("low") / width), F.greatest(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    dealt = reads.withColumn("bin", F.explode(bins)).repartition(n, *key, "bin")
    begin, border = F.col("bin") * width, (F.col("bin") + 1) * width
    event = lambda at, kind, n, v: F.struct(at.cast("long").alias("pos"), F.lit(kind).alias("kind"), F.lit(n).alias("n"), v.alias("v"))
    none = F.array().cast("array<struct<pos:bigint,kind:string,n:int,v:double>>")
    some = lambda when, *events: F.when(when, F.array(*events)).otherwise(none)

    def ends(start: str, end: str, kind: str, n: int) -> list[Column]:
        here = (F.col(start) < border) & (F.col(end) > begin)
        return [some(here, event(F.greatest(F.col(start), begin), kind, n, F.col("ppm"))), some(here & (F.col(end) < border), event(F.col(end), kind, -n, -F.col("ppm")))]

    each = F.concat(*ends("low", "high", "ppm", 1), *ends("t_start", "t_end", "templated", 0), *([] if points is None else [F.filter(points, lambda e: (e["pos"] >= begin) & (e["pos"] < border))]))
    rows = dealt.select(*key, "bin", F.explode(each).alias("e")).select(*key, "bin", "e.*")
    of = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("v")).otherwise(0.0))
    sums = {"mismatch": of("mA", "mC", "mG", "mU"), "tc": of("tc"), "a": of("A", "mA"), "c": of("C", "mC", "tc"), "g": of("G", "mG"), "u": of("U", "mU")} if points is not None else {}
    at = rows.groupBy(*key, "bin", "pos").agg(of("ppm").alias("ppm"), of("templated").alias("templated"), F.sum("n").alias("n"), *(v.alias(c) for c, v in sums.items()))
    w = Window.partitionBy(*key, "bin").orderBy("pos")
    runs = at.withColumns({c: F.sum(c).over(w) for c in ("ppm", "templated", "n")} | {"next": F.coalesce(F.lead("pos").over(w), (F.col("bin") + 1) * width)})
    return runs.where("n > 0").select(*key, "ppm", "templated", *sums, F.col("pos").alias("first"), "next")


def pileup_coverage(annotated: DataFrame, width: int = 1 << 12) -> DataFrame:
    """ppm, templated ppm, and ppm by kind at each position of each annotation, chromosome and strand, of tags with md_tag and tc_tag.

    ppm counts templated bases and tails, which run on past the 3' end.  a, c, g and u hold mismatches (mismatch), T to C
    conversions (tc, as c) and tail bases; scaled is per cent of the annotation's highest ppm, and the shares of
    templated and the four bases come to 1 (or all are 0, under a tail of unknown bases).  The depth at a position is the
    sum of the events up to it, in bins of positions (see _depths).
    """
    key, plus, tail = ["anno", "chrom", "strand"], F.col("strand") == "+", to_rna(F.coalesce("tail", F.lit("")))
    length = F.length(tail)
    low, high = F.when(plus, F.col("t_start")).otherwise(F.col("t_start") - length), F.when(plus, F.col("t_end") + length).otherwise(F.col("t_end"))
    reads = annotated.select(*key, low.alias("low"), high.alias("high"), "t_start", "t_end", "ppm", tail.alias("tail"), "md_tag", "tc_tag")
    place = lambda i: F.when(plus, F.col("t_start") + i).otherwise(F.col("t_end") - 1 - i)
    beyond = lambda i: F.when(plus, F.col("t_end") + i).otherwise(F.col("t_start") - 1 - i)
    point = lambda at, kind: F.struct(at.cast("long").alias("pos"), kind.alias("kind"), F.lit(0).alias("n"), F.col("ppm").alias("v"))
    mismatches = F.transform(tagged_places("md_tag", "base"), lambda m: point(place(m["at"]), F.concat(F.lit("m"), to_rna(m["base"]))))
    conversions = F.transform(tagged_places("tc_tag", "base"), lambda m: point(place(m["at"]), F.lit("tc")))
    tails = F.transform(F.filter(F.split("tail", ""), lambda x: x != ""), lambda x, i: point(beyond(i), x))
    n = parts(annotated)
    runs = _depths(reads, key, width, n, F.concat(mismatches, conversions, tails))
    most = written(_depths(reads.select(*key, "low", "high", "t_start", "t_end", "ppm"), key, width, n).groupBy(*key).agg(F.max("ppm").alias("most")))  # Spark knows a table's size
    points = ["mismatch", "tc", "a", "c", "g", "u"]
    spread = runs.select("*", F.explode(F.sequence("first", F.col("next") - 1)).alias("pos"))
    depth = spread.select(*key, "pos", "ppm", "templated", *(F.when(F.col("pos") == F.col("first"), F.col(c)).otherwise(0.0).alias(c) for c in points))
    total = F.col("templated") + F.col("a") + F.col("c") + F.col("g") + F.col("u")
    shares = [F.when(total > 1e-9, F.col(c) / total).otherwise(0.0).alias(f"share_{c}") for c in ("templated", "a", "c", "g", "u")]
    return depth.join(most, key).select(*key, "pos", "ppm", "templated", *points, (F.col("ppm") * 100 / F.col("most")).alias("scaled"), *shares)


def dataset_overlap(rows: DataFrame, *keys: str) -> DataFrame:
    """Annotations (and other keys, such as sample or info) that several datasets hold, with the datasets."""
    by = rows.groupBy("anno", *keys).agg(F.array_join(F.array_sort(F.collect_set("dataset")), ",").alias("datasets"), F.count_distinct("dataset").alias("n"))
    return by.where("n > 1")


def dataset_combinations(rows: DataFrame) -> DataFrame:
    """Number of annotations of each exact combination of datasets."""
    by = rows.groupBy("anno").agg(F.array_join(F.array_sort(F.collect_set("dataset")), ",").alias("datasets"))
    return by.groupBy("datasets").agg(F.count("*").alias("n"))
