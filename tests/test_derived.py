import random

import duckdb
import pytest

from tailloom.operators import counting, folding, profiles, regions, targets, views
from tailloom.plans import reports
from tailloom.sources import writers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["preference_targets", "fold_entropy", "tmm_normalize", "merge_regions_bounded", "region_pileup", "region_sequences", "differential_bars", "head_tail_n", "filter_difference_arm", "filter_difference_loading"])
def test_derived_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("lineitem", "part", "orders", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = reports.queries()[name](spark, SF)
    result = con.execute(reports.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in sorted(df.columns)]
    got, want = df.select(*sorted(df.columns)).collect(), result.fetchall()
    assert got and sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r[i] for i in at)) for r in want)


def test_chain():
    assert regions.chain(["ACGUACG"]) == "ACGUACG"
    assert regions.chain(["AAACCCG", "AACCCGU"]) == "AAACCCGU"  # over the end
    assert regions.chain(["AACCCGU", "AAACCCG"]) == "AAACCCGU"  # over the start
    assert regions.chain(["AAACCCG", "UUUUUUU"]) == "AAACCCG"  # left out
    assert regions.chain(["AAACCCG", "CCGUUUU"]) == "AAACCCGUUUU"  # three bases
    assert regions.chain(["AAACCCG", "CCGUUUU", "GUUUUAC"]) == "AAACCCGUUUUAC"


def test_seed_chain(spark):
    rows = [("s", "mir-1-5p", "AAACCCG", 9.0), ("s", "mir-1-5p", "AACCCGU", 3.0), ("t", "mir-1-5p", "AACCCGU", 2.0), ("s", "mir-1-3p", "GGGGGGG", 1.0), ("s", "trna", "AAACCCG", 1.0), ("s", "mir-1-5p", "AC", 9.0)]
    iso = spark.createDataFrame(rows, "sample string, anno string, seed string, ppm double")
    assert sorted(tuple(r) for r in regions.seed_chain(iso).collect()) == [("mir-1", "3p", "GGGGGGG", 0), ("mir-1", "5p", "AAACCCG", 0), ("mir-1", "5p", "AACCCGU", 1)]
    assert regions.seed_chain(iso.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [1, 60, 400])
def test_bounded_merge_equals_a_walk(spark, limit):
    rng = random.Random(limit)
    rows = [(s, c, a, a + rng.randrange(1, 40), 1.0) for s in "ab" for c in ("chr1", "chr2") for a in (rng.randrange(3000) for _ in range(60))]
    want = set()
    for key in {r[:2] for r in rows}:
        cluster = None
        for _, _, a, b, _ in sorted(r for r in rows if r[:2] == key):
            if cluster and not (b - cluster[0] > limit and cluster[1] < a):
                cluster = (cluster[0], max(cluster[1], b))
                continue
            want |= {(*key, *cluster)} if cluster else set()
            cluster = (a, b)
        want.add((*key, *cluster))
    got = regions.merge_regions(spark.createDataFrame(rows, "sample string, chrom string, t_start long, t_end long, ppm double"), limit)
    assert sorted(r[:4] for r in got.collect()) == sorted(want)
    assert sum(r.ppm for r in got.collect()) == len(rows)


def test_fold_windows(spark):
    folds = spark.createDataFrame([("mir-1", 100, 120, [float(i) for i in range(20)]), ("mir-2", 100, 104, [1.0] * 4)], "name string, start long, end long, entropy array<double>")
    reads = [("s", "mir-1-5p", "+", 101, 115, 14, ""), ("s", "mir-1-5p", "+", 103, 117, 14, "A"), ("s", "mir-1-3p", "-", 107, 121, 14, None), ("s", "mir-1-5p", "+", 100, 114, 14, ""), ("s", "mir-2-5p", "+", 101, 105, 4, "")]
    annotated = spark.createDataFrame(reads, "sample string, anno string, strand string, t_start long, t_end long, gm_len int, tail string")
    rows = {r.anno: r for r in folding.fold_entropy(annotated, folds).collect()}
    first = rows["mir-1-5p"]  # starts 0 and 2; last windows from 7 and 9
    assert (first.e5, first.mid, first.e3, first.tail3) == (4.5, 10.5, 11.5, 12.5)
    assert rows["mir-1-3p"].e5 == 3.5 and rows["mir-1-3p"].tail3 is None
    assert rows["mir-2-5p"].e5 is None and rows["mir-2-5p"].mid == 1.0


def test_targets(spark):
    t = spark.createDataFrame([("m1", "GAGGUAG", "G1", 0.5), ("m1", "GAGGUAG", "G1", 0.5), ("m2", "AAAAAAA", "G2", None)], "mir string, seed string, gene string, pct double")
    joined = targets.join_targets(t, spark.createDataFrame([("m1", "x-5p")], "mir string, anno string"))
    assert [tuple(r) for r in joined.collect()] == [("x-5p", "GAGGTAG", "G1", 0.5)]
    preferred = spark.createDataFrame([("x-5p_GAGGUAG", "s", "UniLike"), ("x-5p_GAGGUAG|3A", "s", "UniLike"), ("x-5p", "s", "DisLike")], "anno string, sample string, kind string")
    assert [tuple(r) for r in targets.preference_targets(preferred, joined).collect()] == [("s", "UniLike", "G1", 0.5)]


def test_filter_difference_rows(spark):
    schema = "anno string, total double, diff string, samples string, info string"
    arms = spark.createDataFrame([("m", 9.0, "Y", "a:b:c", "5p:3p:5p"), ("n", 9.0, "N", "a:b", "5p:5p"), ("o", 1.0, "Y", "a:b", "5p:3p")], schema)
    assert [tuple(r) for r in profiles.filter_difference_rows(arms, "Arm", min_expr=2).collect()] == [("m", "b", "3p")]
    schema = schema.replace("diff string", "diff double")
    rows = spark.createDataFrame([("m_S", 9.0, 3.0, "a:b", "20:23"), ("n", 9.0, -2.0, "a:b", "20:22"), ("o_T", 90.0, 3.0, "a:b", "20:23")], schema)
    assert [r.anno for r in profiles.filter_difference_rows(rows, "Length", min_len_diff=2, max_expr=10).collect()] == ["m_S"]
    assert [tuple(r) for r in profiles.filter_difference_rows(rows, "Loading", fold=1.5, max_expr=10).collect()] == [("m", "S", 3.0, "a", "b"), ("n", None, -2.0, "a", "b")]
    with pytest.raises(ValueError, match="unknown mode"):
        profiles.filter_difference_rows(rows, "Other")


def test_small_tables(spark):
    totals = spark.createDataFrame([("s", "a", 5.0), ("s", "b", 0.0)], "sample string, anno string, ppm double")
    assert [(r.anno, r.ppm, r.tmm) for r in profiles.tmm_normalize(totals).collect()] == [("a", None, None)]
    assert views.head_tail_n(totals, "ppm", 5, ["sample"], ["anno"]).count() == 2
    assert profiles.tmm_normalize(totals.limit(0)).count() == 0


def test_report_writers(spark, tmp_path):
    schema = "tag_id long, chrom string, t_start long, t_end long, strand string, nh int, reads long, ppm double, is_flagged boolean, gm_len int, tail string, seq string, md_tag string, seed_md string, tc string"
    tags = spark.createDataFrame([(1, "chr1", 5, 8, "+", 2, 3, 7.0, True, 9, "T", "ACGTACGTAT", "6T", "5T", ""), (2, "chr1", 5, 8, "+", 2, 3, 1.0, True, 9, "", "ACGTACGTA", "", "", "")], schema)
    prime = spark.createDataFrame([(1, "miRNA", "m-5p"), (2, "miRNA", "m-5p")], "tag_id long, biotype string, name string")
    writers.write_analyzedbed(tags, prime, str(tmp_path / "bed"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "bed")).collect()]
    assert lines[0].split("\t") == writers.ANALYZED_BED
    assert lines[1].split("\t") == ["chr1", "5", "8", "+", "2", "3", "1.5", "7.0", "Y", "9", "1", "ACGUACGUAU", "U", "6U", ".", "miRNA", "m-5p_CGUACGU|5U"]
    assert len(lines) == 2
    variants = spark.createDataFrame([("chr1", 5, "A", "C", "9", "G1", None, {"p": "0/1"})], "chrom string, pos long, ref string, alt string, qual string, gene string, rmsk string, genotypes map<string,string>").coalesce(1)
    writers.write_vcf_report(variants, str(tmp_path / "vcf"))
    head, row = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "vcf")).collect()]
    assert len(head) == 18 and head[:6] == ["Chr", "Pos", "Ref", "Alt", "Qul", "Gene"] and row[5:] == ["G1", *["."] * 12]
    writers.write_vcf_report(variants, str(tmp_path / "cohort"), ["p", "q"])
    assert [r.value.split("\t")[5:8] for r in spark.read.text(str(tmp_path / "cohort")).collect()] == [["p", "q", "Gene"], ["0/1", ".", "G1"]]
    writers.write_type_counts(spark.createDataFrame([("miRNA",), ("tRNA",), ("miRNA",)], "biotype string"), str(tmp_path / "types"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "types")).collect()) == ["miRNA\t2", "tRNA\t1"]


def test_preference_needs_significance(spark):
    rows = [("m", a, b, f, p) for a, b, f, p in [("x", "y", 3.0, 0.01), ("x", "z", 4.0, 0.05), ("y", "x", 1 / 3, 0.01), ("y", "z", 3.0, 0.2), ("z", "x", 0.25, 0.05), ("z", "y", 0.3, 0.2)]]
    folds = spark.createDataFrame(rows, "anno string, s1 string, s2 string, fold double, p double")
    got = lambda **k: {(r.anno, r["sample"], r.kind) for r in profiles.preference_sets(folds, **k).collect()}
    assert got() == {("m", "x", "UniLike")}
    assert got(max_p=None) == {("m", "x", "UniLike"), ("m", "z", "DisLike")}


def test_loading_difference_of_absent_samples(spark):
    rows = [("a", "m", 10.0), ("b", "m", 5.0), ("c", "n", 4.0), ("a", "n", 3.0), ("b", "n", 2.0), ("a", "k", 2.0), ("b", "k", 2.0), ("c", "k", 2.0), ("a", "o", 8.0), ("b", "o", 2.0), ("c", "o", 4.0)]
    got = {r.anno: (pytest.approx(r.diff), r.max_sample, r.min_sample) for r in profiles.loading_difference(spark.createDataFrame(rows, "sample string, anno string, ppm double")).collect()}
    assert got == {"m": (-(10 - 1e-6) / 1e-6, "a", "c"), "n": (1.0, "c", "b"), "k": (0.0, "a", "a"), "o": (-3.0, "a", "b")}


def test_whole_of_a_token_table_is_one_sum(spark):
    """GMPM and tailing come from the sum that SQL takes; GM + PM differs from it in the last bit here."""
    values = [1.3333333333333333, 16.666666666666668, 18.666666666666668, 0.3333333333333333]
    rows = spark.createDataFrame([("s", "m", k, v) for k, v in zip(["GM", "A", "GM", "A"], values)], "sample string, anno string, tail_class string, ppm double").coalesce(1)
    (row,) = counting.token_table(rows, "anno").collect()
    assert row.gm + row.pm != row.gmpm
    assert row.gmpm == ((values[0] + values[1]) + values[2]) + values[3] and row.tailing == row.pm * 100 / row.gmpm
