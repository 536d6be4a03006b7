"""Readers and writers on small files."""

import random

import pytest

from tailloom.sources import readers, writers


def lines(spark, path):
    return [r.value.split("\t") for r in spark.read.text(str(path)).collect()]


def test_feature_files(spark, tmp_path):
    (tmp_path / "a.bed").write_text("chr1\t5\t9\t+\tmiRNA\tm-5p\n")
    (tmp_path / "b.bed").write_text("chr2\t1\t4\t-\ttRNA\tt1\nchr2\t7\t8\t+\ttRNA\tt2\n")
    rows = readers.read_features(spark, [str(tmp_path / "a.bed"), str(tmp_path / "b.bed")]).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [("chr1", 5, 9, "+", "miRNA", "m-5p", 0), ("chr2", 1, 4, "-", "tRNA", "t1", 1), ("chr2", 7, 8, "+", "tRNA", "t2", 1)]


def test_bed6_and_mirtron(spark, tmp_path):
    (tmp_path / "r.bed").write_text("chr1\t5\t9\tL1\t33\t+\n")
    assert [tuple(r) for r in readers.read_bed6(spark, str(tmp_path / "r.bed")).collect()] == [("chr1", 5, 9, "+", "rmsk", "L1_33")]
    (tmp_path / "m.bed").write_text("chr1\t5\t9\t-\tmt1\n")
    assert [tuple(r) for r in readers.read_mirtron(spark, str(tmp_path / "m.bed")).collect()] == [("chr1", 5, 9, "-", "mirtron", "mt1")]


def test_fold_table(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("pre1\t3\t7\t-1.5\tACGU\t(..)\t0.5\t1\t0\t2.25\npre2\t1\t2\t0\tA\t.\t0.1\n")
    rows = {r.name: r for r in readers.read_fold_table(spark, str(tmp_path / "f.tsv")).collect()}
    assert tuple(rows["pre1"])[1:] == (3, 7, -1.5, "ACGU", "(..)", [0.5, 1.0, 0.0, 2.25]) and rows["pre2"].entropy == [0.1]


def test_wide_report_round_trip(spark, tmp_path):
    long = spark.createDataFrame([("m", "s1", 1.23456), ("m", "s2", 2.0), ("n", "s2", 3.0)], "anno string, sample string, value double")
    writers.write_wide_report(long, str(tmp_path / "wide"), ["s1", "s2", "s3"])
    assert sorted(lines(spark, tmp_path / "wide"))[0] == ["Annotation", "s1", "s2", "s3"]
    got = sorted(tuple(r) for r in readers.read_wide_report(spark, str(tmp_path / "wide")).collect())
    assert got == [("m", "s1", 1.2346), ("m", "s2", 2.0), ("m", "s3", 0.0), ("n", "s1", 0.0), ("n", "s2", 3.0), ("n", "s3", 0.0)]


def test_annobed(spark, tmp_path):
    schema = "tag_id long, chrom string, t_start long, t_end long, strand string, nh int, reads long, ppm double, gm_len int, tail string, seq string, md_tag string, tc_tag string, seed_md string"
    tags = spark.createDataFrame([(1, "chr1", 5, 14, "+", 2, 3, 7.5, 9, "T", "ACGTACGTAT", "6T", "8C", "5T"), (2, "chr1", 50, 59, "-", 1, 4, 1.0, 9, "", "ACGTACGTA", "", "", "")], schema)
    hits = spark.createDataFrame([(1, "miRNA", "m-5p"), (1, "rmsk", "L1")], "tag_id long, biotype string, name string")
    writers.write_annobed(tags, hits, str(tmp_path / "bed"))
    head, *rows = sorted(lines(spark, tmp_path / "bed"), key=lambda r: (r[0] != "Chr", r))
    assert head == writers.ANNO_BED and len(head) == 16
    first = ["chr1", "5", "14", "+", "2", "3", "1.5", "7.5", "9", "1", "ACGTACGTAT", "T", "6T", "8C"]
    assert rows == [[*first, "miRNA", "m-5p_CGTACGT|5T"], [*first, "rmsk", "L1_CGTACGT|5T"], ["chr1", "50", "59", "-", "1", "4", "4.0", "1.0", "9", "0", "ACGTACGTA", ".", ".", ".", ".", "."]]


@pytest.mark.parametrize("block", ["128m", "211", "37"])
@pytest.mark.parametrize("piece", [1 << 16, 5])
def test_genome_in_blocks(spark, tmp_path, block, piece):
    """A chromosome over many blocks and files of several chromosomes give the chunks of the whole text."""
    rng = random.Random(4)
    whole = {f"chr{k}": "".join(rng.choices("ACGTNacgt", k=n)) for k, n in enumerate([700, 1, 64, 333, 0])}
    body = "".join(f">{name} of a genome\r\n" + "".join(seq[i : i + 50] + "\n" for i in range(0, len(seq), 50)) for name, seq in whole.items())
    (tmp_path / "g.fa").write_text(body)
    (tmp_path / "h.fa").write_text("\n>other\nACGT\n\nAC\n")
    whole["other"] = "ACGTAC"
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = {(r.chrom, r.chunk_id): r.chunk for r in readers.read_genome(spark, [str(tmp_path / "g.fa"), str(tmp_path / "h.fa")], 64, 10, piece).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(c, i // 64): seq[i : i + 74].upper() for c, seq in whole.items() for i in range(0, len(seq), 64)}
