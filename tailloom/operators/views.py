"""Tables behind single displays: pileups, heat maps, histograms, scatter plots and stacked shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import arm_of, gm, guarded_log, of_tail, pm, precursor_of, tailing
from .regions import islands


def two_sample_table(totals: DataFrame, first: str, second: str, floor: float = 0.0, log: float | None = None) -> DataFrame:
    """Values x and y of two samples for each annotation that either has, of at least ``floor`` in one of them; one aggregation instead of an outer join.

    With log, values are logarithms to that base (0 for a value of 0), to two digits.
    """
    of = lambda s: F.sum(F.when(F.col("sample") == s, F.col("ppm")).otherwise(0.0))
    by = totals.where(F.col("sample").isin(first, second)).groupBy("anno").agg(of(first).alias("x"), of(second).alias("y"))
    by = by.where((F.col("x") >= floor) | (F.col("y") >= floor)) if floor else by
    return by if log is None else by.withColumns({c: F.round(guarded_log(F.col(c), log), 2) for c in "xy"})


def difference_histogram(table: DataFrame, bins: int = 10, low: float = 0.0, high: float | None = None) -> DataFrame:
    """Annotations by the size of x - y, from low to high if given, in bins of equal width, counted apart by its sign."""
    rows = table.select(F.abs(F.col("x") - F.col("y")).alias("d"), F.signum(F.col("x") - F.col("y")).cast("int").alias("side")).where("d > 0").where(F.col("d") >= low)
    rows = rows if high is None else rows.where(F.col("d") <= high)
    bounds = rows.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))  # one row
    at = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("d") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))).otherwise(0)
    return rows.crossJoin(F.broadcast(bounds)).groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"), "side").agg(F.count("*").alias("n"))


def merge_regions(regions: DataFrame) -> DataFrame:
    """Regions of a sample and chromosome in clusters that a gap parts, with each cluster's extent and ppm."""
    key = ["sample", "chrom"]
    distinct = regions.groupBy(*key, "t_start", "t_end").agg(F.sum("ppm").alias("ppm"))
    return islands(distinct, key).groupBy(*key, "island").agg(F.min("t_start").alias("m_start"), F.max("t_end").alias("m_end"), F.sum("ppm").alias("ppm")).drop("island")


def pileup_segments(annotated: DataFrame) -> DataFrame:
    """The segment of overlapping reads with the most ppm of each annotation; the first on a tie."""
    key = ["anno", "chrom", "strand"]
    reads = annotated.groupBy(*key, "t_start", "t_end").agg(F.sum("ppm").alias("ppm"))
    segments = islands(reads, key).groupBy(*key, "island").agg(F.min("t_start").alias("s_start"), F.max("t_end").alias("s_end"), F.round(F.sum("ppm"), 6).alias("ppm"))
    best = F.min(F.struct((-F.col("ppm")).alias("v"), "chrom", "strand", "s_start", "s_end"))
    return segments.groupBy("anno").agg(best.alias("b")).select("anno", "b.chrom", "b.strand", "b.s_start", "b.s_end", (-F.col("b.v")).alias("ppm"))


def pileup_seeds(annotated: DataFrame) -> DataFrame:
    """Measures, number of reads and longest read at each distance from an annotation's first start."""
    first = annotated.groupBy("anno", "chrom", "strand").agg(F.min("t_start").alias("first"))
    rows = annotated.join(first, ["anno", "chrom", "strand"]).withColumn("distance", F.col("t_start") - F.col("first"))
    return rows.groupBy("anno", "chrom", "strand", "distance").agg(gm().alias("gm"), pm().alias("pm"), F.count("*").alias("n"), F.max("read_len").alias("longest"))


def seed_length_matrix(iso: DataFrame, log2: bool = False) -> DataFrame:
    """Measures and tails of each precursor arm by seed and length (or their logarithms, 0 for 0), with totals by seed and by length (the other one null)."""
    rows = iso.select(precursor_of(F.col("anno")).alias("mir"), arm_of(F.col("anno")).alias("arm"), "seed", "read_len", "tail_class", "ppm").where(F.col("arm").isin("5p", "3p"))
    sets = [["mir", "arm", "seed", "read_len"], ["mir", "arm", "seed"], ["mir", "arm", "read_len"]]
    tails = [of_tail(k).alias(f"{k.lower()}_tail") for k in ("A", "C", "G", "U", "Other")]
    found = rows.groupingSets(sets, "mir", "arm", "seed", "read_len").agg(gm().alias("gm"), pm().alias("pm"), F.sum("ppm").alias("gmpm"), *tails)
    return found.withColumns({c: guarded_log(F.col(c), 2.0) for c in found.columns[4:]}) if log2 else found


def seed_heatmap(iso: DataFrame, width: int = 5) -> DataFrame:
    """Mean ppm of each seed in bins of ``width`` annotations in order of name, with the bin's highest annotation.

    The order is over all annotations, of which there are as many as the feature files name.
    """
    names = iso.select("anno").distinct().withColumn("bin", F.floor((F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("anno")) - 1) / width).cast("int"))
    names = names.withColumn("members", F.count("*").over(Window.partitionBy("bin")))
    cells = iso.groupBy("seed", "anno").agg(F.round(F.sum("ppm"), 6).alias("ppm")).join(names, "anno")
    top = F.min(F.struct((-F.col("ppm")).alias("v"), "anno")).getField("anno")
    return cells.groupBy("seed", "bin").agg((F.sum("ppm") / F.max("members")).alias("value"), top.alias("top"))


def seed_slices(iso: DataFrame, floor: float, seed: str | None = None) -> DataFrame:
    """Annotations of a seed (or of every seed) with at least ``floor`` ppm in a sample."""
    rows = iso if seed is None else iso.where(F.col("seed") == seed)
    return rows.groupBy("sample", "seed", "anno").agg(F.sum("ppm").alias("ppm")).where(F.col("ppm") >= floor)


def scale_to_max(table: DataFrame, value: str, *by: str) -> DataFrame:
    """value in per cent of the largest of its group."""
    return table.withColumn("scaled", F.col(value) * 100 / F.max(value).over(Window.partitionBy(*by)))


def length_by_tail(iso: DataFrame, anno: str, divisor: float = 1.0) -> DataFrame:
    """ppm over the divisor of each tail class of one annotation, by sample and length."""
    by = iso.where(F.col("anno") == anno).groupBy("sample", "read_len")
    return by.agg(*((of_tail(k) / divisor).alias(k.lower()) for k in ("A", "C", "G", "U", "Other", "GM")))


def tail_scatter(iso: DataFrame, tail: str, floor: float, arm: str | None = None) -> DataFrame:
    """log2 of ppm and the share of one tail class, of annotations with at least ``floor`` ppm."""
    by = iso.groupBy("sample", "anno").agg(F.sum("ppm").alias("all"), of_tail(tail).alias("tailed")).where(F.col("all") >= floor)
    by = by if arm is None else by.where(arm_of(F.col("anno")) == arm)
    return by.select("sample", "anno", F.log2("all").alias("x"), (F.col("tailed") / F.col("all")).alias("y"))


def rank_annotations(totals: DataFrame, merge_arms: bool = False) -> DataFrame:
    """Rank of annotations in each sample by value, then name, both descending; optionally with arms merged."""
    name = precursor_of(F.col("anno")) if merge_arms else F.col("anno")
    by = totals.groupBy("sample", name.alias("anno")).agg(F.round(F.sum("ppm"), 6).alias("ppm"))
    return by.withColumn("rank", F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("ppm"), F.desc("anno"))))


def stacked_cumulative(composition: DataFrame) -> DataFrame:
    """Share of each nucleotide at a position, and the running sum of shares in order of nucleotides."""
    w = Window.partitionBy("sample", "slot")
    share = composition.withColumn("share", F.col("ppm") / F.sum("ppm").over(w))
    return share.select("sample", "slot", "nt", "share", F.sum("share").over(w.orderBy("nt")).alias("top"))


def ranked_bin_composition(iso: DataFrame, every: int = 10, rank_by: str = "gmpm", part: str = "all", n: int = 0, trim: int = 0, ratio: bool = True) -> DataFrame:
    """Mean composition by tail classes of annotations in bins of ``every``, in order of a measure (gmpm, gm, pm or tailing) in a sample.

    part takes the ``n`` lowest, the n highest, or all without ``trim`` per cent at both ends.  ratio gives each
    annotation the same weight; without it their sums are brought to 1.
    """
    by = iso.groupBy("sample", "anno").agg(F.round(F.sum("ppm"), 6).alias("all"), gm().alias("gm"), pm().alias("pm"), *(of_tail(k).alias(f"_{k}") for k in ("A", "C", "G", "U", "Other", "GM")))
    order = {"gmpm": F.col("all"), "gm": F.round("gm", 6), "pm": F.round("pm", 6), "tailing": F.round(tailing(F.col("gm"), F.col("pm")), 6)}[rank_by]
    w = Window.partitionBy("sample")
    ranked = by.where(F.col("all") > 0).withColumns({"r": F.row_number().over(w.orderBy(order, "anno")), "of": F.count("*").over(w)})
    if part == "all":
        ranked = ranked.where((F.col("r") > F.floor(F.col("of") * trim / 100)) & (F.col("r") <= F.col("of") - F.floor(F.col("of") * trim / 100)))
    else:
        ranked = ranked.where(F.col("r") <= n) if part == "lowest" else ranked.where(F.col("r") > F.col("of") - n)
    ranked = ranked.withColumn("r", F.row_number().over(w.orderBy("r")))
    mean = lambda k: (F.avg(F.col(f"_{k}") / F.col("all")) if ratio else F.sum(f"_{k}") / F.sum("all")).alias(k.lower())
    return ranked.groupBy("sample", F.floor((F.col("r") - 1) / every).cast("int").alias("bin")).agg(*map(mean, ("A", "C", "G", "U", "Other", "GM")))


def token_view(iso: DataFrame, token: str | int) -> DataFrame:
    """The fact table by seed alone ('Seed'), of one arm ('5p', '3p') or of one length."""
    if token == "Seed":
        return iso.groupBy("sample", "seed", "tail_class", "read_len").agg(F.sum("ppm").alias("ppm"))
    return iso.where(F.col("read_len") == token) if isinstance(token, int) else iso.where(arm_of(F.col("anno")) == token)


def filter_value_matrix(totals: DataFrame, low: float, high: float, log: float | None = None, arm: str | None = None, kept: DataFrame | None = None) -> DataFrame:
    """Annotations without those at most ``low``, or at least ``high``, in all samples; a missing value is 0.

    log compares logarithms to that base (0 for 0); arm takes names of one arm, and kept those in a table of anno (dominant isoforms, say).
    """
    totals = totals if arm is None else totals.where(arm_of(F.col("anno")) == arm)
    totals = totals if kept is None else totals.join(kept.select("anno").distinct(), "anno", "left_semi")
    totals = totals if log is None else totals.withColumn("ppm", guarded_log(F.col("ppm"), log))
    n = totals.agg(F.count_distinct("sample").alias("n"))  # one row
    by = totals.groupBy("anno").agg(F.max("ppm").alias("most"), F.min("ppm").alias("least"), F.count("*").alias("held"), F.sum("ppm").alias("total")).crossJoin(F.broadcast(n))
    least = F.when(F.col("held") < F.col("n"), F.least(F.col("least"), F.lit(0.0))).otherwise(F.col("least"))
    return by.where((F.col("most") > low) & (least < high)).select("anno", "total")


def length_tables_merged(iso: DataFrame) -> DataFrame:
    """Measures of each precursor and arm by sample, isoforms and lengths merged."""
    rows = iso.withColumn("arm", arm_of(F.col("anno"))).where(F.col("arm").isin("5p", "3p"))
    return rows.groupBy(precursor_of(F.col("anno")).alias("mir"), "arm", "sample").agg(gm().alias("gm"), pm().alias("pm"), F.sum("ppm").alias("gmpm"))


def map_names(hits: DataFrame, source: str, target: str) -> DataFrame:
    """Names of one biotype and those of another that share a tag."""
    of = lambda kind, name: hits.where(F.col("biotype") == kind).select("tag_id", F.col("name").alias(name)).distinct()
    return of(source, "source").join(of(target, "target"), "tag_id").select("source", "target").distinct()


def filter_fold_pvalue(rows: DataFrame, log2_fold: float = 1.0, p: float = 0.05) -> DataFrame:
    return rows.where((F.abs(F.log2("fold")) >= log2_fold) & (F.col("p") <= p))


def volcano_points(rows: DataFrame, floor: float = 0.0, colours: DataFrame | None = None) -> DataFrame:
    """log2 of the fold and -log10 of p, of rows with a total over ``floor``; colours (sample, anno, colour) give each the colour of its first sample, or 0."""
    negative: Column = -F.log10(F.greatest(F.col("p"), F.lit(1e-300)))
    points = rows.where(F.col("total") > floor).select("anno", "s1", "s2", F.log2("fold").alias("log2_fold"), negative.alias("log10_p"))
    if colours is None:
        return points
    return points.join(colours.select(F.col("sample").alias("s1"), "anno", "colour"), ["s1", "anno"], "left").withColumn("colour", F.coalesce("colour", F.lit(0.0)))


def differential_bars(filtered: DataFrame, lengths: DataFrame, k: int, mode: str = "ppm", measure: str = "gmpm") -> DataFrame:
    """A measure by length and sample of the ``k`` filtered annotations (anno, total) with the largest totals.

    mode gives ppm, its log2 (0 where there is none), or its per cent of the samples' sum at that length.
    """
    top = filtered.select("anno", "total").orderBy(F.desc("total"), "anno").limit(k)
    rows = lengths.select("anno", "read_len", "sample", F.col(measure).alias("value")).join(F.broadcast(top.select("anno")), "anno", "left_semi")  # k rows
    if mode == "log2":
        return rows.withColumn("value", guarded_log(F.col("value"), 2.0))
    if mode == "percent":
        whole = F.sum("value").over(Window.partitionBy("anno", "read_len"))
        return rows.withColumn("value", F.when(whole > 0, F.col("value") * 100 / whole).otherwise(0.0))
    return rows


def head_tail_n(rows: DataFrame, value: str, n: int, by: list[str], ties: list[str]) -> DataFrame:
    """The n lowest and the n highest rows of each group, each once; ties go by other columns.

    Each end is a ranked limit, which Spark also applies before the shuffle.
    """
    ends = []
    for way in (F.asc, F.desc):
        order = [way(value), *map(way, ties)]
        ends.append(rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= n).drop("_r"))
    return ends[0].union(ends[1]).dropDuplicates([*by, value, *ties])
