"""Readers of sequencing formats, as DataFrames over Spark's text and CSV sources."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FEATURE_SCHEMA = "chrom string, f_start long, f_end long, strand string, biotype string, name string"
GTF_SCHEMA = "chrom string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"


def sample_of_path() -> Column:
    """File name up to its first dot."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/.]+)[^/]*$", 1)


def read_fastq(spark: SparkSession, paths: str | list[str], min_len: int = 15, max_len: int = 30) -> DataFrame:
    """Reads of FASTQ files with four lines a record, within the length window and of ACGT only.

    Files are split at line ends before '@', so large ones are read in parallel.  '@' also starts some quality
    lines: a part of three lines then lacks its quality, which is the next part, of one line.  Parts are put
    together as they are read; only those at the ends of a file's blocks, two for each at most, are joined.
    """
    raw = spark.read.option("lineSep", "\n@").text(paths).select("_metadata.file_path", "_metadata.file_block_start", sample_of_path().alias("sample"), "value")
    pieces = raw.mapInArrow(_stitch, "path string, block long, sample string, read_id string, seq string, qual string")
    whole = pieces.where("read_id is not null and qual is not null").drop("path", "block")
    after = Window.partitionBy("path").orderBy("block", F.col("read_id").isNotNull())
    ends = pieces.where("read_id is null or qual is null").withColumn("next", F.struct(F.lead("read_id").over(after).alias("id"), F.lead("qual").over(after).alias("qual")))
    joined = ends.where("qual is null and next.id is null and next.qual is not null").select("sample", "read_id", "seq", F.col("next.qual").alias("qual"))
    reads = whole.union(joined)
    return reads.where(F.length("seq").between(min_len, max_len) & F.col("seq").rlike("^[ACGT]+$"))


_PIECES = pa.schema([(c, pa.int64() if c == "block" else pa.string()) for c in ("path", "block", "sample", "read_id", "seq", "qual")])


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from parts of files in order; one without its quality, or a quality alone, at the ends of a block."""
    held: tuple | None = None
    place = None
    for batch in batches:
        rows = []
        for path, block, sample, value in zip(*(c.to_pylist() for c in batch.columns)):
            if held and place != (path, block):
                rows.append((*held, None))
                held = None
            first = place != (path, block)
            place = path, block
            lines = [x.rstrip("\r") for x in (value[1:] if first and block == 0 and value.startswith("@") else value).rstrip("\n").split("\n")]
            if len(lines) >= 4:
                rows.append((path, block, sample, lines[0].split(" ")[0], lines[1], lines[3]))
            elif len(lines) == 3:
                held = path, block, sample, lines[0].split(" ")[0], lines[1]
            elif len(lines) == 1 and held:
                rows.append((*held, "@" + lines[0]))
                held = None
            elif len(lines) == 1 and first:
                rows.append((path, block, sample, None, None, "@" + lines[0]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*held, None), _PIECES)], schema=_PIECES)


def read_fasta_reads(spark: SparkSession, paths: str | list[str], min_len: int = 15, max_len: int = 30) -> DataFrame:
    """Reads of FASTA files, with qualities of 'I'."""
    raw = spark.read.option("lineSep", ">").text(paths).where(F.length("value") > 0).select(sample_of_path().alias("sample"), F.split("value", "\n", 2).alias("l"))
    seq = F.upper(F.regexp_replace(F.col("l")[1], r"\s", ""))
    reads = raw.select("sample", F.split(F.col("l")[0], " ")[0].alias("read_id"), seq.alias("seq"))
    reads = reads.where(F.length("seq").between(min_len, max_len) & F.col("seq").rlike("^[ACGT]+$"))
    return reads.withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Alignments of SAM files; NH, MD and TL are optional."""
    lines = spark.read.text(paths).where(~F.col("value").startswith("@")).select(sample_of_path().alias("sample"), "value")
    f = F.split("value", "\t")
    tag = lambda name, kind: F.regexp_extract("value", rf"\t{name}:{kind}:([^\t]*)", 1)
    nh = F.coalesce(F.expr("try_cast(nullif(regexp_extract(value, '\tNH:i:([^\t]*)', 1), '') AS int)"), F.lit(1))
    return lines.where(F.size(f) >= 11).select(
        "sample", f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), f[3].cast("long").alias("pos"), f[4].cast("int").alias("mapq"),
        f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"), nh.alias("nh"), tag("MD", "Z").alias("md"), tag("TL", "Z").alias("tl"),
    )


def read_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Six-column feature files; db_idx is a file's place in the list."""
    out = None
    for i, path in enumerate(paths):
        one = spark.read.schema(FEATURE_SCHEMA).option("sep", "\t").csv(path).withColumn("db_idx", F.lit(i))
        out = one if out is None else out.unionByName(one)
    return out


def read_gtf(spark: SparkSession, path: str, genes_only: bool = True) -> DataFrame:
    """Features of a GTF file, 0-based, with gene_type and gene_name."""
    rows = spark.read.schema(GTF_SCHEMA).options(sep="\t", comment="#", quote="").csv(path)
    rows = rows.where("feature = 'gene'") if genes_only else rows
    attribute = lambda k: F.regexp_extract("attributes", rf'{k} "([^"]*)"', 1)
    return rows.select("chrom", (F.col("start") - 1).alias("f_start"), F.col("end").alias("f_end"), "strand", attribute("gene_type").alias("biotype"), attribute("gene_name").alias("name"))


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """miRNA rows of a GFF3 file, as biotype mirbase."""
    rows = spark.read.schema(GTF_SCHEMA).options(sep="\t", comment="#", quote="").csv(path).where("feature = 'miRNA'")
    return rows.select("chrom", (F.col("start") - 1).alias("f_start"), F.col("end").alias("f_end"), "strand", F.lit("mirbase").alias("biotype"), F.regexp_extract("attributes", r"Name=([^;]*)", 1).alias("name"))


def read_bed6(spark: SparkSession, path: str, label: str = "rmsk") -> DataFrame:
    rows = spark.read.schema("chrom string, f_start long, f_end long, name string, score string, strand string").option("sep", "\t").csv(path)
    return rows.select("chrom", "f_start", "f_end", "strand", F.lit(label).alias("biotype"), F.concat_ws("_", "name", "score").alias("name"))


def read_mirtron(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("chrom string, f_start long, f_end long, strand string, name string").option("sep", "\t").csv(path)
    return rows.select("chrom", "f_start", "f_end", "strand", F.lit("mirtron").alias("biotype"), "name")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Variants on main contigs; short contig names get a chr prefix."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(~f[0].contains("_"))
    chrom = F.when(F.length(f[0]) > 3, f[0]).otherwise(F.concat(F.lit("chr"), f[0]))
    return rows.select(chrom.alias("chrom"), f[1].cast("long").alias("pos"), f[3].alias("ref"), f[4].alias("alt"), f[5].alias("qual"), f[2].alias("id"))


def read_vcf_cohort(spark: SparkSession, path: str) -> DataFrame:
    """read_vcf with genotypes, a map from sample name to the text before the first colon."""
    header = spark.read.text(path).where(F.col("value").startswith("#CHROM")).first()  # one line
    names = header["value"].split("\t")[9:] if header else []
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(~f[0].contains("_"))
    chrom = F.when(F.length(f[0]) > 3, f[0]).otherwise(F.concat(F.lit("chr"), f[0]))
    calls = F.transform(F.slice(f, 10, len(names)), lambda x: F.split(x, ":")[0])
    genotypes = F.map_from_arrays(F.array(*map(F.lit, names)), calls) if names else F.lit(None).cast("map<string,string>")
    return rows.select(chrom.alias("chrom"), f[1].cast("long").alias("pos"), f[3].alias("ref"), f[4].alias("alt"), f[5].alias("qual"), f[2].alias("id"), genotypes.alias("genotypes"))


def read_fold_table(spark: SparkSession, path: str) -> DataFrame:
    """name, start, end, mfe, seq, structure and entropy (one value for each base)."""
    f = F.split("value", "\t")
    return spark.read.text(path).where(F.size(f) > 6).select(
        f[0].alias("name"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), f[3].cast("double").alias("mfe"), f[4].alias("seq"), f[5].alias("structure"),
        F.transform(F.slice(f, 7, 1 << 30), lambda x: x.cast("double")).alias("entropy"),
    )


def read_wide_report(spark: SparkSession, path: str) -> DataFrame:
    """anno, sample and value of a wide table whose first column is the annotation."""
    wide = spark.read.options(sep="\t", header=True).csv(path)
    first, *samples = wide.columns
    return wide.unpivot(first, samples, "sample", "value").select(F.col(first).alias("anno"), "sample", F.col("value").cast("double").alias("value"))


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """Tags that write_tags has written; a filter on sample reads the folders of those samples alone."""
    return spark.read.parquet(path)


#: Bases of a piece of a sequence on its way to its chunks.
PIECE = 1 << 16


def _sequence_pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the runs of sequence lines in each block of a file, each with its place in the run; a header begins a run, and names it."""
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("run", pa.int32()), ("name", pa.string()), ("at", pa.int64()), ("bases", pa.string())])
    place, run, name, at, held, size, rows = None, 0, None, 0, [], 0, []

    def piece() -> None:
        nonlocal at, held, size
        if place is not None:
            rows.append((*place, run, name, at, "".join(held)))
            at, held, size = at + size, [], 0

    def batch() -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()

    for lines in batches:
        for path, block, value in zip(*(c.to_pylist() for c in lines.columns)):
            if place != (path, block):
                piece()
                place, run, name, at = (path, block), 0, None, 0
            if value.startswith(">"):
                piece()
                run, name, at = run + 1, (value[1:].split() or [""])[0], 0
            else:
                held.append("".join(value.split()).upper())
                size += len(held[-1])
                if size >= most:
                    piece()
        yield from batch()
    piece()
    yield from batch()


def read_genome(spark: SparkSession, path: str | list[str], size: int = 1 << 16, beyond: int = 128, piece: int = PIECE) -> DataFrame:
    """chrom, chunk_id and chunk of FASTA files: ``size`` bases, and ``beyond`` of the next chunk.

    A chromosome is read in as many blocks as its file has.  Runs of its lines in the blocks (one for each block
    and header) get their places by a running sum, and pieces of them go to the chunks that they touch.
    """
    lines = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    pieces = lines.mapInArrow(lambda batches: _sequence_pieces(batches, piece), "path string, block long, run int, name string, at long, bases string")
    runs = pieces.groupBy("path", "block", "run").agg(F.max("name").alias("name"), F.max(F.col("at") + F.length("bases")).alias("n"))
    order = Window.partitionBy("path").orderBy("block", "run")
    named = runs.withColumns({"chrom": F.last("name", ignorenulls=True).over(order), "nth": F.count("name").over(order)})
    before = Window.partitionBy("path", "nth").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    starts = named.select("path", "block", "run", "chrom", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).where("chrom is not null")
    placed = pieces.where("bases <> ''").join(starts, ["path", "block", "run"]).select("chrom", (F.col("start") + F.col("at")).alias("low"), "bases")
    first, last = F.greatest(F.floor((F.col("low") - beyond) / size), F.lit(0)), F.floor((F.col("low") + F.length("bases") - 1) / size)
    dealt = placed.withColumn("chunk_id", F.explode(F.sequence(first, last)))
    skipped = F.greatest(F.col("chunk_id") * size - F.col("low"), F.lit(0))
    place = F.col("low") + skipped
    part = F.substring(F.col("bases"), (skipped + 1).cast("int"), F.greatest(F.col("chunk_id") * size + size + beyond - place, F.lit(0)).cast("int"))
    parts = F.array_sort(F.collect_list(F.struct(place.alias("place"), part.alias("part"))))  # as long as a chunk
    return dealt.groupBy("chrom", "chunk_id").agg(parts.alias("parts")).select("chrom", "chunk_id", F.array_join("parts.part", "").alias("chunk"))


def read_targets(spark: SparkSession, path: str, species: str = "hsa", least_pct: float | None = None) -> DataFrame:
    """transcript, gene, seed, mir and pct of target predictions of a species, with pct at least ``least_pct`` if given."""
    f = F.split("value", "\t")
    pct = F.expr("try_cast(split(value, '\t')[16] AS double)")
    rows = spark.read.text(path).where(F.col("value").startswith("ENST") & (F.size(f) > 16))
    rows = rows.select(f[0].alias("transcript"), f[1].alias("gene"), f[2].alias("seed"), f[13].alias("mir"), pct.alias("pct")).where(F.col("mir").startswith(species))
    return rows if least_pct is None else rows.where(F.col("pct") >= least_pct)
