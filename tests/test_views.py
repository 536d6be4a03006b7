import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tailloom.operators import differential, sequences
from tailloom.plans import catalog
from tailloom.sources import readers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["merge_regions", "pileup_segments", "seed_heatmap", "read_sequence", "precursor_sequences", "seed_length_matrix", "ranked_bin_composition"])
def test_view_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("lineitem", "part", "orders"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = catalog.queries()[name](spark, SF)
    result = con.execute(catalog.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in sorted(df.columns)]
    got, want = df.select(*sorted(df.columns)).collect(), result.fetchall()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r[i] for i in at)) for r in want)


def test_fold_p(spark):
    rows = spark.createDataFrame([("a", 100.0, 10.0), ("b", 0.0, 0.0), ("c", 100.0, 1000.0)], "anno string, x double, y double")
    p = {r.anno: r.p for r in differential.with_p(rows).collect()}
    assert p["a"] == pytest.approx(0.016032, abs=1e-6) and p["b"] == pytest.approx(0.792277, abs=1e-6) and p["c"] == pytest.approx(0.001049, abs=1e-6)
    cells = spark.createDataFrame([(1.0, 1.0, 0.3, 0.3), (2.0, 1.0, 0.5, 0.25), (2.0, 3.0, 0.4, 0.5248), (20.0, 17.0, 0.9, 1.0)], "a double, b double, x double, want double")
    assert all(r.got == pytest.approx(r.want, abs=1e-6) for r in cells.select("want", differential.incomplete_beta(*map(F.col, "abx")).alias("got")).collect())
    gammas = spark.createDataFrame([(z / 7,) for z in range(1, 400)], "z double").select("z", differential.log_gamma(F.col("z")).alias("got")).collect()
    assert all(r.got == pytest.approx(math.lgamma(r.z), rel=1e-11, abs=1e-11) for r in gammas)
    assert differential.with_p(rows.limit(0)).count() == 0


def test_mapping_equals_brute_force(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("ACGT") for _ in range(700))
    text = text[:300] + text[100:160] + text[300:]
    size = 200
    genome = spark.createDataFrame([("chr1", i // size, text[i : i + size + sequences.LONGEST]) for i in range(0, len(text), size)], "chrom string, chunk_id long, chunk string")
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = set()
    for _ in range(60):
        i, n = rng.randrange(len(text) - 30), rng.randrange(14, 28)
        piece = text[i : i + n]
        reads.add((piece if rng.random() < 0.5 else turned(piece)) + rng.choice(["", "A", "TT", "ACG"]))
    reads |= {text[:20], turned(text[:20]), text[-20:], turned(text[-20:]), text[190:214], "ACGTACGTACGTNNNN", "ACG", text[110:130]}
    want = set()
    for r in reads:
        sites = []
        for i in range(len(text)):
            for strand in "+-":
                whole = text[i : i + 64] if strand == "+" else turned(text[max(0, i - 63) : i + 1])
                n = next((k for k, (x, y) in enumerate(zip(r, whole, strict=False)) if x != y), min(len(r), len(whole)))
                if n >= 12:
                    sites.append((n, strand, i if strand == "+" else i + 1 - n))
        best = [s for s in sites if s[0] == max(t[0] for t in sites)]
        want |= {(r, "chr1", s, at, n, r[n:], len(best)) for n, s, at in best if len(best) <= 10}
    got = sequences.seed_map_reads(spark.createDataFrame([(r,) for r in reads] * 2, "seq string"), genome, size)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_genome_and_targets(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 x\nacgta\ncgtac\n>chr2\nTTTT\n")
    rows = {(r.chrom, r.chunk_id): r.chunk for r in readers.read_genome(spark, str(tmp_path / "g.fa"), 4, 2).collect()}
    assert rows == {("chr1", 0): "ACGTAC", ("chr1", 1): "ACGTAC", ("chr1", 2): "AC", ("chr2", 0): "TTTT"}
    tags = spark.createDataFrame([("chr1", "+", 2, 3, "A"), ("chr1", "-", 2, 3, "")], "chrom string, strand string, at int, n int, tail string")
    genome = readers.read_genome(spark, str(tmp_path / "g.fa"), 4, 4)
    assert [r.sequence for r in sequences.extract_sequence(tags, genome, "at", "n", 4, "tail").orderBy(F.desc("tail")).collect()] == ["GTAA", "TAC"]
    line = lambda mir, pct: "\t".join(["ENST1", "G", "GAGGUA", *["x"] * 10, mir, "x", "x", pct])
    (tmp_path / "t.txt").write_text("\n".join(["head", line("hsa-let-7", "0.9"), line("hsa-mir-1", "NULL"), line("mmu-let-7", "0.9")]) + "\n")
    assert readers.read_targets(spark, str(tmp_path / "t.txt")).count() == 2
    assert [r.mir for r in readers.read_targets(spark, str(tmp_path / "t.txt"), least_pct=0.5).collect()] == ["hsa-let-7"]
