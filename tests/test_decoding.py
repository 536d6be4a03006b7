import random

from pyspark.sql import functions as F

from tailloom.functions.columns import classify_tail, reverse_complement, seed
from tailloom.operators import counting, intervals, tags
from tailloom.sources import readers, writers

LINE = "test\t0\tchr14\t43718720\t251\t20M4S\t*\t0\t0\tAGCGGAGTGTATAATGGCTTAAAA\tIIIIIIIIIIIII*III%IIII%1"


def sam(spark, tmp_path, *lines):
    path = tmp_path / "s1.sam"
    path.write_text("@HD\tVN:1.0\n" + "\n".join(lines) + "\n")
    return readers.read_sam(spark, str(path))


def test_worked_example(spark, tmp_path):
    rows = tags.decode_alignment(sam(spark, tmp_path, LINE + "\tNH:i:1\tMD:Z:7A9T2\tTL:Z:AAAA"))
    r = tags.seed_mismatch_tag(tags.parse_mismatches(rows)).first()
    assert (r.gm_len, r.strand, r.t_end, r.md_map, r.seed_md, r.tl, r.sample) == (20, "+", 43718740, {7: "T", 17: "C"}, "6T", "AAAA", "s1")
    r = tags.parse_mismatches(rows, allow_t2c=True).first()
    assert (r.md_map, r.tc_pos, r.md_tag) == ({7: "T"}, [17], "7T")


def test_reverse_strand_mismatch(spark, tmp_path):
    line = LINE.replace("\t0\tchr14", "\t16\tchr14", 1).replace("20M4S", "4S20M")
    r = tags.parse_mismatches(tags.decode_alignment(sam(spark, tmp_path, line + "\tMD:Z:7A12"))).first()
    assert (r.strand, r.gm_len, r.md_map) == ("-", 20, {12: "A"})


def test_optional_tags_missing(spark, tmp_path):
    r = tags.parse_mismatches(tags.decode_alignment(sam(spark, tmp_path, LINE))).first()
    assert (r.nh, r.md, r.tl, r.md_map) == (1, "", "", {})


def test_sam_round_trip(spark, tmp_path):
    rows = sam(spark, tmp_path, LINE + "\tNH:i:2\tMD:Z:20\tTL:Z:A")
    writers.write_sam(rows, str(tmp_path / "out"))
    back = readers.read_sam(spark, str(tmp_path / "out"))
    assert back.drop("sample").first() == rows.drop("sample").first()


def test_fastq_and_fasta(spark, tmp_path):
    good, bad = "ACGTACGTACGTACGTAC", "ACGTNCGTACGTACGTAC"
    (tmp_path / "a.fastq").write_text("".join(f"@r{i} x\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate([good, bad, "ACGT", good])))
    assert [r.read_id for r in readers.read_fastq(spark, str(tmp_path / "a.fastq")).orderBy("read_id").collect()] == ["r0", "r3"]
    (tmp_path / "b.fasta").write_text(f">q1\n{good[:9]}\n{good[9:]}\n>q2\n{bad}\n")
    assert [tuple(r) for r in readers.read_fasta_reads(spark, str(tmp_path / "b.fasta")).collect()] == [("b", "q1", good, "I" * 18)]


def test_gtf_gff_bed_vcf(spark, tmp_path):
    (tmp_path / "g.gtf").write_text('##x\nchr1\tE\tgene\t11\t20\t.\t+\t.\tgene_type "miRNA"; gene_name "MIR1";\nchr1\tE\texon\t11\t20\t.\t+\t.\tx\n')
    assert tuple(readers.read_gtf(spark, str(tmp_path / "g.gtf")).first()) == ("chr1", 10, 20, "+", "miRNA", "MIR1")
    (tmp_path / "g.gff3").write_text("#x\nchr1\t.\tmiRNA\t11\t20\t.\t-\t.\tID=1;Name=m-5p;x=1\n")
    assert tuple(readers.read_gff3(spark, str(tmp_path / "g.gff3")).first()) == ("chr1", 10, 20, "-", "mirbase", "m-5p")
    (tmp_path / "v.vcf").write_text("##a\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tF\tI\tFMT\ts1\ts2\n1\t5\trs1\tA\tC\t9\t.\t.\tGT\t0/1:3\t1/1:4\nGL_1\t5\t.\tA\tC\t9\t.\t.\tGT\t0/1\t0/0\n")
    assert [tuple(r) for r in readers.read_vcf_cohort(spark, str(tmp_path / "v.vcf")).collect()] == [("chr1", 5, "A", "C", "9", "rs1", {"s1": "0/1", "s2": "1/1"})]
    assert readers.read_vcf(spark, str(tmp_path / "v.vcf")).count() == 1


def test_functions(spark):
    df = spark.createDataFrame([("", "AGCT"), ("AA", "T"), ("TT", "G"), ("ACA", "C"), ("N", "A"), (None, "A")], "tail string, s string")
    assert [r[0] for r in df.select(classify_tail(F.col("tail"))).collect()] == ["GM", "A", "U", "Other", "Other", "GM"]
    one = spark.createDataFrame([("ATGCTTACC",)], "s string").select(seed(F.col("s")), reverse_complement(F.col("s"))).first()
    assert tuple(one) == ("UGCUUAC", "GGTAAGCAT")


def test_biotype_list():
    assert counting.expand_biotype_list(["miRNA_mirtron", "tRNA"]) == ["mirtron", "miRNA", "tRNA", "un_annotated"]
    assert counting.expand_biotype_list(["miRNA", "mirtron"], True) == ["mirtron", "miRNA"]


def test_bin_size_changes_nothing(spark):
    t = spark.range(300).selectExpr("id AS tag_id", "'chr1' AS chrom", "'+' AS strand", "id * 7 % 900 + 1 AS t_start", "id * 7 % 900 + 21 AS t_end")
    f = spark.range(80).selectExpr("'chr1' AS chrom", "'+' AS strand", "id * 13 % 950 AS f_start", "id * 13 % 950 + 1 + id % 90 AS f_end", "id AS name")
    pairs = [{(r.tag_id, r.name) for r in intervals.annotate_intervals(t, f, size=s).collect()} for s in (8, 64, 4096)]
    ts, fs = t.collect(), f.collect()
    want = {(a.tag_id, b.name) for a in ts for b in fs if a.t_start - 1 < b.f_end and a.t_end - 1 > b.f_start}
    assert pairs == [want] * 3
    assert sum(intervals.annotate_intervals(t, f, size=8).groupBy("tag_id", "name").count().where("count > 1").count() for _ in range(1)) == 0


def test_fastq_qualities_that_look_like_headers(spark, tmp_path):
    """Reads whose quality begins with @ or +, over files cut into many blocks."""
    rng = random.Random(2)
    seqs = ["".join(rng.choices("ACGT", k=20)) for _ in range(400)]
    quals = [rng.choice("@@+I") + "".join(rng.choices("@+I5", k=19)) for _ in seqs]
    (tmp_path / "s1.fastq").write_text("".join(f"@r{i} x\n{s}\n+\n{q}\n" for i, (s, q) in enumerate(zip(seqs, quals))))
    want = sorted((f"r{i}", s, q) for i, (s, q) in enumerate(zip(seqs, quals)))
    for size in ("128m", "700", "97"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = readers.read_fastq(spark, str(tmp_path / "s1.fastq")).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted((r.read_id, r.seq, r.qual) for r in got) == want and {r["sample"] for r in got} == {"s1"}
