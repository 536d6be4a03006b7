"""Writers of reports and formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import seed, to_rna


def write_tags(tags: DataFrame, path: str) -> None:
    tags.write.mode("overwrite").partitionBy("sample").parquet(path)


def write_wide_report(long: DataFrame, path: str, samples: list[str], digits: int = 4) -> None:
    """anno, sample and value as one row for each annotation, missing values as 0."""
    wide = long.groupBy(F.col("anno").alias("Annotation")).pivot("sample", samples).agg(F.round(F.first("value"), digits))
    wide.fillna(0.0).write.mode("overwrite").options(sep="\t", header=True).csv(path)


def write_annobed(tags: DataFrame, hits: DataFrame, path: str) -> None:
    """One row for each hit of a tag, in 16 columns under a header; dots for no tail, no mismatch, and a tag without a hit.

    tags has seq (with the tail), md_tag, tc_tag and seed_md (texts).
    """
    rows = tags.join(hits.select("tag_id", "biotype", "name"), "tag_id", "left")
    shown = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) == "", ".").otherwise(F.col(c))
    marked = F.when(F.coalesce(F.col("seed_md"), F.lit("")) == "", "").otherwise(F.concat(F.lit("|"), "seed_md"))
    values = [
        "chrom", "t_start", "t_end", "strand", "nh", "reads", F.col("reads") / F.col("nh"), "ppm", "gm_len", F.length(F.coalesce("tail", F.lit(""))), "seq", shown("tail"), shown("md_tag"), shown("tc_tag"),
        F.coalesce("biotype", F.lit(".")), F.coalesce(F.concat("name", F.lit("_"), F.substring("seq", 2, 7), marked), F.lit(".")),
    ]
    columns = [(F.col(v) if isinstance(v, str) else v).alias(name) for v, name in zip(values, ANNO_BED, strict=True)]
    rows.select(*columns).write.mode("overwrite").options(sep="\t", header=True).csv(path)


#: Headers of reports: fixed values.
ANNO_BED = ["Chr", "Start", "End", "Strand", "AlignCounts", "RawCounts", "ReadCounts", "PPM", "Length", "TailLen", "Seq", "Tail", "MM", "T2C", "Type", "AnnoSeedMD"]
ANALYZED_BED = ["Chr", "Start", "End", "Strand", "AlignCounts", "RawCounts", "ReadCounts", "PPM", "RMSK", "Length", "TailLen", "Seq", "Tail", "MM", "T2C", "Type", "AnnoSeedMD"]
VCF_REPORT = {"chrom": "Chr", "pos": "Pos", "ref": "Ref", "alt": "Alt", "qual": "Qul"}
VCF_SLOTS = {
    "gene": "Gene", "rmsk": "Rmsk", "dbsnp": "dbSNP", "common_snp": "CommonSNP", "publication": "Publication", "omim": "OMIM", "clinvar": "Clinvar", "genetic_disorders": "GeneticDisorders",
    "cosmic": "Cosmic", "structural_variation": "StructuralVariation", "exac": "ExAC", "esp": "ExonSequencingProject", "kgenome": "1000Genome",
}


def write_analyzedbed(tags: DataFrame, prime: DataFrame, path: str, filter_ppm: float = 5.0) -> None:
    """Tags from ``filter_ppm`` up with each hit of their first biotype, bases as RNA; a dot for no tail or mismatch.

    tags has seq (with the tail), md_tag, seed_md and tc (texts) and is_flagged; prime has tag_id, biotype and name.
    """
    rows = tags.where(F.col("ppm") >= filter_ppm).join(prime, "tag_id")
    shown = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) == "", ".").otherwise(to_rna(F.col(c)))
    mismatch = F.when(F.coalesce(F.col("seed_md"), F.lit("")) == "", "").otherwise(F.concat(F.lit("|"), to_rna(F.col("seed_md"))))
    values = [
        "chrom", "t_start", "t_end", "strand", "nh", "reads", F.col("reads") / F.col("nh"), "ppm", F.when(F.col("is_flagged"), "Y").otherwise("N"), "gm_len", F.length(F.coalesce("tail", F.lit(""))),
        to_rna(F.col("seq")), shown("tail"), shown("md_tag"), shown("tc"), "biotype", F.concat("name", F.lit("_"), seed(F.col("seq")), mismatch),
    ]
    columns = [(F.col(v) if isinstance(v, str) else v).alias(name) for v, name in zip(values, ANALYZED_BED, strict=True)]
    rows.select(*columns).write.mode("overwrite").options(sep="\t", header=True).csv(path)


def write_vcf_report(variants: DataFrame, path: str, samples: list[str] | None = None) -> None:
    """Annotated variants with 13 slots, a dot where a slot is missing; of a cohort, each sample's genotype follows the first five columns."""
    fixed = [F.col(c).alias(name) for c, name in VCF_REPORT.items()]
    calls = [F.coalesce(F.try_element_at("genotypes", F.lit(s)), F.lit(".")).alias(s) for s in samples or []]
    slots = [(F.coalesce(F.col(c), F.lit(".")) if c in variants.columns else F.lit(".")).alias(name) for c, name in VCF_SLOTS.items()]
    variants.select(*fixed, *calls, *slots).write.mode("overwrite").options(sep="\t", header=True).csv(path)


def write_type_counts(features: DataFrame, path: str) -> None:
    """Number of features of each biotype, without a header."""
    features.groupBy("biotype").agg(F.count("*").alias("n")).write.mode("overwrite").option("sep", "\t").csv(path)


def write_sam(alignments: DataFrame, path: str) -> None:
    """SAM lines, a folder for each sample."""
    fixed = ["qname", "flag", "rname", "pos", "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual"]
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c
    optional = [F.concat(F.lit("NH:i:"), F.col("nh").cast("string")), F.concat(F.lit("MD:Z:"), F.when(F.col("md") != "", F.col("md"))), F.concat(F.lit("TL:Z:"), F.when(F.col("tl") != "", F.col("tl")))]
    alignments.select("sample", F.concat_ws("\t", *map(text, fixed), *optional).alias("value")).write.mode("overwrite").partitionBy("sample").text(path)
