"""Decoding of alignments and collapsing of reads into tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import reverse_complement


def filter_read_quality(reads: DataFrame, min_len: int = 15, max_len: int = 30) -> DataFrame:
    return reads.where(F.length("seq").between(min_len, max_len) & F.col("seq").rlike("^[ACGT]+$"))


def decode_alignment(alignments: DataFrame) -> DataFrame:
    """strand, chrom, gm_len and t_end from flag, reference name and CIGAR."""
    gm_len = F.regexp_extract("cigar", r"(\d+)M", 1).cast("int")
    chrom = F.when(F.col("rname").startswith("chr"), F.col("rname")).otherwise(F.concat(F.lit("chr"), "rname"))
    return alignments.withColumns({"strand": F.when(F.col("flag") == 0, "+").otherwise("-"), "chrom": chrom, "gm_len": gm_len, "t_end": F.col("pos") + gm_len})


def parse_mismatches(decoded: DataFrame, allow_t2c: bool = False) -> DataFrame:
    """md_map (index to read base), tc_pos, md_tag and tc_tag (their texts), and templated, from the MD tag; md_error for deletions.

    Indices are in read orientation: on the reverse strand they run from the end, bases complemented.  Only the
    matched part of the read counts: its first gm_len bases, on the reverse strand its last.  With allow_t2c,
    conversions of T to C (read orientation) are in tc_pos in place of md_map.  templated is the matched part as the
    reference has it, in read orientation.
    """
    reverse = F.col("flag") == 16
    matched = F.when(reverse, F.expr("right(seq, gm_len)")).otherwise(F.expr("left(seq, gm_len)"))
    steps = F.regexp_extract_all("md", F.lit(r"(\d+)([ACGT])"), F.lit(1)).cast("array<int>")
    refs = F.regexp_extract_all("md", F.lit(r"(\d+)([ACGT])"), F.lit(2))
    df = decoded.withColumns({"_n": steps, "_ref": refs, "_seq": matched})
    # a walk along the tag: each mismatch lies a step and a base after the one before it
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<int>").alias("all"))
    walked = F.aggregate("_n", start, lambda a, n: F.struct((a["at"] + n + 1).alias("at"), F.array_append(a["all"], a["at"] + n + 1).alias("all")))["all"]
    items = F.transform(F.arrays_zip(walked.alias("at"), F.col("_ref").alias("ref")), lambda z: F.struct(z["at"].alias("at"), z["ref"].alias("ref"), F.substring("_seq", z["at"] + 1, F.lit(1)).alias("base")))
    df = df.withColumn("_m", items)
    tc = lambda m: F.lit(allow_t2c) & ((~reverse & (m["ref"] == "T") & (m["base"] == "C")) | (reverse & (m["ref"] == "A") & (m["base"] == "G")))
    index = lambda m: F.when(reverse, F.col("gm_len") - 1 - m["at"]).otherwise(m["at"])
    base = lambda m: F.when(reverse, F.translate(m["base"], "ACGT", "TGCA")).otherwise(m["base"])
    kept = F.array_sort(F.transform(F.filter("_m", lambda m: ~tc(m)), lambda m: F.struct(index(m).alias("i"), base(m).alias("b"))))
    df = df.withColumns({"_kept": kept, "tc_pos": F.array_sort(F.transform(F.filter("_m", tc), index))})
    text = F.array_join(F.transform("_kept", lambda k: F.concat(k["i"].cast("string"), k["b"])), "")
    converted = F.array_join(F.transform("tc_pos", lambda i: F.concat(i.cast("string"), F.lit("C"))), "")
    restored = F.aggregate("_m", F.col("_seq"), lambda s, m: F.overlay(s, m["ref"], m["at"] + 1, F.lit(1)))
    df = df.withColumn("templated", F.when(reverse, reverse_complement(restored)).otherwise(restored))
    df = df.withColumns({"md_map": F.map_from_entries("_kept"), "md_tag": text, "tc_tag": converted, "md_error": F.col("md").contains("^")})
    return df.drop("_n", "_ref", "_seq", "_m", "_kept")


def seed_mismatch_tag(parsed: DataFrame) -> DataFrame:
    """seed_md: for mismatches at 1 to 7, the place in the seed and the base there."""
    inside = F.filter(F.array_sort(F.map_keys("md_map")), lambda i: i.between(1, 7))
    return parsed.withColumn("seed_md", F.array_join(F.transform(inside, lambda i: F.concat((i - 1).cast("string"), F.col("md_map")[i])), ""))


def trim_long_tail(df: DataFrame, max_tail_len: int = 5, tail: str = "tl") -> DataFrame:
    return df.withColumn(tail, F.when(F.length(tail) > max_tail_len, "").otherwise(F.col(tail)))


def collapse_tags(parsed: DataFrame) -> DataFrame:
    """Equal alignments of a sample as one tag with its number of reads, and the name of its first record as tag_id.

    Alignments are equal in place, mismatches, T to C conversions and tail (columns of parse_mismatches).  Their
    other columns of a tag are equal too, so the largest stands for all.
    """
    keys = ["sample", "strand", "chrom", "pos", "t_end", "md_tag", "tc_tag", "tl"]
    same = [F.max(c).alias(c) for c in ("gm_len", "templated", "seed_md") if c in parsed.columns]
    return parsed.groupBy(*keys).agg(F.count("*").alias("reads"), F.min("nh").alias("nh"), F.min("qname").alias("tag_id"), *same)


def tagged_places(tag: str, base: str) -> Column:
    """The places and bases of a tag text such as 7T17C, as an array of structs of those names."""
    parts = lambda group: F.regexp_extract_all(F.col(tag), F.lit(r"(\d+)([ACGT])"), F.lit(group))
    return F.arrays_zip(parts(1).cast("array<int>").alias("at"), parts(2).alias(base))


def tags_of(collapsed: DataFrame) -> DataFrame:
    """Collapsed alignments in the shape of tags, ready for normalize_ppm: mismatches stay as md_tag, tc_tag and seed_md."""
    return collapsed.select("sample", "tag_id", "chrom", "strand", F.col("pos").alias("t_start"), "t_end", "gm_len", F.col("tl").alias("tail"), "reads", "nh", F.col("templated").alias("seq"), "md_tag", "tc_tag", "seed_md")


def sample_weights(tags: DataFrame) -> DataFrame:
    """Sum of reads by sites of each sample (_total)."""
    return tags.groupBy("sample").agg(F.sum(F.col("reads") / F.col("nh")).alias("_total"))


def normalize_ppm(tags: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """weight (reads by sites) and ppm (weight per million of its sample); total: sample_weights of the tags, if they are there already."""
    weighted = tags.withColumn("weight", F.col("reads") / F.col("nh"))
    total = sample_weights(tags) if total is None else total  # a row for each sample: a join by it would deal all tags to so many tasks
    return weighted.join(F.broadcast(total), "sample").withColumn("ppm", F.col("weight") * 1e6 / F.col("_total")).drop("_total")


def mappability(reads: DataFrame, aligned: DataFrame) -> DataFrame:
    """RawReads, ReadsWithN, FilteredReads, Mappable and its per cent, by sample."""
    ids = aligned.select("sample", F.col("qname").alias("read_id")).distinct().withColumn("hit", F.lit(1))
    good = F.col("seq").rlike("^[ACGT]+$") & F.length("seq").between(15, 30)
    by = reads.join(ids, ["sample", "read_id"], "left").groupBy("sample")
    out = by.agg(F.count("*").alias("raw"), F.count_if(F.col("seq").contains("N")).alias("with_n"), F.count_if(good).alias("filtered"), F.count_if(F.col("hit") == 1).alias("mappable"))
    return out.withColumn("pct", F.round(F.col("mappable") * 100 / F.col("raw"), 4))
