"""Steps whose work must grow no faster than their tables."""

import random

import pytest
from pyspark.sql import functions as F

from tailloom.operators import counting, folding, intervals, profiles, sequences, tags
from tailloom.plans import adapters, aligned, catalog, reports


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _shuffles(df):
    """Lines of the plan's shuffles, under a threshold that broadcasts no given table."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if " Exchange " in line]


@pytest.fixture
def nothing_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fold_join_by_name_and_bin(spark):
    """Precursors of one name meet the reads near them only, also over the borders of bins; the pairs are those of all compared with all."""
    rng = random.Random(3)
    starts = [0, intervals.BIN - 30, intervals.BIN, 2 * intervals.BIN - 1, *(rng.randrange(4000) for _ in range(60))]
    folds = [("mir-1", s, s + rng.choice([20, 60, 1500]), [1.0]) for s in starts]
    reads = [(i, "mir-1-5p", rng.choice("+-"), s, s + rng.randrange(1, 25)) for i, s in enumerate(rng.choice(starts) + rng.randrange(40) for _ in range(200))]
    want = sorted((i, s, e, e + 1 - b if strand == "-" else a - s - 1) for i, _, strand, a, b in reads for _, s, e, _ in folds if a >= s + 1 and b <= e + 1)
    got = folding.join_fold(spark.createDataFrame(reads, "tag_id long, anno string, strand string, t_start long, t_end long"), spark.createDataFrame(folds, "name string, start long, end long, entropy array<double>"))
    assert want and sorted(tuple(r) for r in got.select("tag_id", "pre_start", "pre_end", "offset").collect()) == want
    (join,) = [line for line in _plan(got).splitlines() if "Join Inner" in line]
    assert "_bin" in join


def test_reads_meet_sites_by_a_long_prefix_first(spark):
    """Reads that have 18 bases of the genome never meet the sites that share 12 by chance; those that have fewer are still mapped."""
    rng = random.Random(5)
    shared, bases = "ACGTTGCAAGTC", lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    text = "".join(shared + bases(38) for _ in range(40))  # forty sites of the same twelve bases
    size = 100
    genome = spark.createDataFrame([("chr1", i // size, text[i : i + size + 64]) for i in range(0, len(text), size)], "chrom string, chunk_id long, chunk string")
    long = text[100:122] + "A"
    few = text[515:530] + ("C" if text[530] != "C" else "G") + "TTTTT"  # fifteen bases, then others
    got = {r.seq: (r.start, r.matched, r.nh) for r in sequences.seed_map_reads(spark.createDataFrame([(long,), (few,), (text[100:112],)], "seq string"), genome, size).collect()}
    whole = len(long) if text[122] == "A" else 22
    assert got == {long: (100, whole, 1), few: (515, 15, 1)}  # the twelve bases alone have forty places
    pairs = sequences._longest_sites(spark.createDataFrame([(long,)], "seq string"), genome, size, 18)
    assert [(r.start, r.matched, r.nh) for r in pairs.collect()] == [(100, whole, 1)]
    assert "RepartitionByExpression [chrom" in _plan(pairs)  # one small file of chunks is not one task of all their sites


def test_sites_and_chunks_are_not_broadcast(spark):
    """Sites are far more than Spark guesses from the chunks that it explodes: neither go through the driver."""
    text = "".join(random.Random(7).choices("ACGT", k=400))
    genome = spark.createDataFrame([("chr1", i // 100, text[i : i + 164]) for i in range(0, 400, 100)], "chrom string, chunk_id long, chunk string")
    turned = text[100:122][::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([(text[290:312],), (turned,), (text[390:],)], "seq string")
    found = sequences._longest_sites(reads, genome, 100, 18)
    assert {(r.seq, r.strand, r.start, r.matched, r.nh) for r in found.where("chrom is not null").collect()} == {(text[290:312], "+", 290, 22, 1), (turned, "-", 100, 22, 1)}
    rows = spark.createDataFrame([("chr1", "+", 290, 22)], "chrom string, strand string, at long, n int")
    cut = sequences.extract_sequence(rows, genome, "at", "n", 100)
    assert [r.sequence for r in cut.collect()] == [text[290:312]]
    assert not any("Broadcast" in df._jdf.queryExecution().executedPlan().toString() for df in (found, cut))


def test_tags_are_not_dealt_by_sample(spark):
    """Totals of the few samples go to the tags: a join by sample deals all tags to as many tasks as there are samples."""
    rows = spark.createDataFrame([("s", 1, 6, 2), ("s", 2, 1, 1), ("t", 3, 5, 1)], "sample string, tag_id long, reads long, nh int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tags.normalize_ppm(rows)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert {r.tag_id: (r.weight, r.ppm) for r in found.collect()} == {1: (3.0, 750000.0), 2: (1.0, 250000.0), 3: (5.0, 1e6)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


READS = "sample string, tag_id long, anno string, chrom string, strand string, t_start long, t_end long, seq string, seed string, tail string, ppm double, md_tag string, tc_tag string"


def test_pileup_shuffles_reads_alone(spark):
    """Reads go to their bins, where they become events and positions: neither are shuffled."""
    rows = [("s", i, "m", "c", "+-"[i % 2], 10 + i, 30 + i, "A" * 20, "x", "", 1.0, "", "") for i in range(8)]
    found = profiles.pileup_coverage(spark.createDataFrame(rows, READS), 16)
    (shuffle,) = _shuffles(found)
    assert "pos" not in shuffle and "RepartitionByExpression [anno" in _plan(found)
    assert sum(r.ppm for r in found.collect()) == 160


def test_profile_shuffles_reads_alone(spark):
    """Reads go to their annotation and seed and are spread over their slots there; what the tags change is at its slots."""
    rows = [("s", 1, "m", "c", "+", 1, 9, "ACGTTTTT", "x", "A", 1.0, "1G", "3C"), ("s", 2, "m", "c", "+", 1, 9, "ACGTTTTT", "x", "", 2.0, "", "")]
    found = profiles.position_profile(spark.createDataFrame(rows, READS))
    (shuffle,) = _shuffles(found)
    assert "slot" not in shuffle
    got = {(r.slot, r.nt): r.ppm for r in found.collect()}
    assert got[1, "G"] == 1.0 and got[1, "C"] == 2.0 and got[3, "U"] == 3.0 and (3, "C") not in got and got[8, "A"] == 1.0 and got[14, "U"] == 8.0


def test_ends_are_made_after_the_shuffles(spark):
    """Reads of equal places are one row before they move, and a read's three ends are made where its annotation is."""
    rows = [("s", i, "m", "c", "+-"[i % 4 == 3], 10 + i % 2, 30, "A" * 20, "x", "AA"[: i % 3], 1.0 + i, "", "") for i in range(12)]
    found = profiles.end_heterogeneity(spark.createDataFrame(rows, READS))
    shuffles = _shuffles(found)
    assert len(shuffles) == 2 and not any("kind" in line for line in shuffles)
    want = []
    for ends in ([b if s == "+" else e for *_, s, b, e, _, _, _, _, _, _ in rows], [e if s == "+" else b for *_, s, b, e, _, _, _, _, _, _ in rows], [e + len(t) if s == "+" else b - len(t) for *_, s, b, e, _, _, t, _, _, _ in rows]):
        weight = {at: sum(r[10] for r, e in zip(rows, ends) if e == at) for at in ends}
        mode = min(weight, key=lambda at: (-weight[at], at))
        want.append(sum(w * abs(at - mode) for at, w in weight.items()) / sum(weight.values()))
    ((_, _, *got),) = found.collect()
    assert got == pytest.approx(want)


def test_prime_hits_of_one_join(spark, nothing_broadcast):
    """The hits of tags in bins of their starts are those of all bins, and their first biotype takes no further shuffle."""
    rng = random.Random(9)
    spots = [0, 1, intervals.BIN - 25, intervals.BIN - 1, intervals.BIN, *(rng.randrange(3 * intervals.BIN) for _ in range(80))]
    tag_rows = [(i, "c", "+-"[i % 2], s + 1, s + 1 + rng.randrange(15, 26)) for i, s in enumerate(spots)]
    features = [("c", s, s + rng.choice([0, 1, 20, 900]), rng.choice("+-"), rng.choice(["miRNA", "tRNA", "rmsk"]), f"f{i}") for i, s in enumerate(spots)]
    reads = spark.createDataFrame(tag_rows, "tag_id long, chrom string, strand string, t_start long, t_end long")
    of = spark.createDataFrame(features, "chrom string, f_start long, f_end long, strand string, biotype string, name string")
    want = counting.prime_hits(intervals.annotate_intervals(reads, of)).select("tag_id", "anno").collect()
    found = counting.prime_hits(intervals.annotate_starts(reads, of, 25), dealt=("chrom", "strand", "_bin"))
    assert len(_shuffles(found)) == 2  # the join's own
    assert want and sorted(map(tuple, found.select("tag_id", "anno").collect())) == sorted(map(tuple, want))


def test_tags_are_made_once(spark, tmp_path):
    """What makes the tags runs once, and not again for the samples' weights."""
    seen = spark.sparkContext.accumulator(0)

    class Counted(reports.Base):
        def source_tags(self):
            def count(row):
                seen.add(1)
                return row

            rows = spark.createDataFrame([("s", i, "chr1", "+", i, i + 20, 2, 1) for i in range(1, 6)], "sample string, tag_id long, chrom string, strand string, t_start long, t_end long, reads long, nh int")
            return spark.createDataFrame(rows.rdd.map(count), rows.schema)

    base = Counted(spark, str(tmp_path))
    assert [r.ppm for r in base.tags().collect()] == [200000.0] * 5 and base.tags().count() == 5
    assert seen.value == 5


def test_mismatches_move_the_biotypes_tags_alone(spark, nothing_broadcast):
    """A tag with two hits counts once, and no join deals all tags by their ids."""
    base = aligned.Aligned(spark, "")
    rows = [("s", 1, "a", "c", "+", 1, 9, "", "x", "", 1.0, "1G", "3C"), ("s", 1, "b", "c", "+", 1, 9, "", "x", "", 1.0, "1G", "3C"), ("s", 2, "a", "c", "+", 1, 9, "", "x", "", 2.0, "1G", "")]
    df = spark.createDataFrame(rows, READS)
    base.kept = {"annotated": df.withColumn("biotype", F.lit("miRNA")), "tags": df.drop("ppm", "anno").distinct().withColumn("reads", F.lit(1)).withColumn("nh", F.lit(1)), "weights": spark.createDataFrame([("s", 2.0)], "sample string, _total double")}
    found = profiles.mismatch_kinds(base.of_biotype("miRNA_mirtron"))
    assert "Join" not in _plan(found)
    assert sorted(map(tuple, found.collect())) == [("s", "MD", 2, 3.0), ("s", "TC", 4, 1.0)]


#: Order keys of 360 copies of sf0.1 and more, by a step that leaves what the views take from a key's remainders.
FAR = 80 * 700_000
FAR_QUERIES = ["filter_difference_loading", "preference_significant", "differential_filter", "differential_summary", "volcano_points", "pileup_segments", "tail_breakdown_isoform", "merge_regions", "best_ranges", "match_biotype", "biotype_composition", "collapse_tags"]


@pytest.fixture(scope="module")
def far_keys(spark, tmp_path_factory):
    """sf0.001 with order keys whose ids pass 63 bits."""
    path = tmp_path_factory.mktemp("far")
    for table in ("lineitem", "part"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        (df.withColumn("l_orderkey", F.col("l_orderkey") + FAR) if table == "lineitem" else df).write.parquet(f"{path}/{table}.parquet")
    return str(path)


@pytest.mark.parametrize("name", FAR_QUERIES)
def test_ids_over_63_bits(spark, far_keys, name):
    """Results without ids are those of the same lines under small keys."""
    plain = lambda df: sorted(str([f"{x:.3f}" if isinstance(x, float) else x for x in r]) for r in df.collect())
    build = (reports.REPORTS | aligned.REPORTS)[name][0]
    kind = aligned.Aligned if name in aligned.REPORTS else reports.Base
    near, far = (build(kind.of(spark, d)) for d in ("/root/testdata/sf0.001", far_keys))
    assert near.schema == far.schema and plain(near) == plain(far)


@pytest.mark.parametrize("name", ["prioritize_biotype", "normalize_ppm"])
def test_wide_ids_are_exact(spark, far_keys, name):
    """Ids are the SQL's numbers, also where they take more than 63 bits; where all fit they stay long."""
    near, far = (catalog.queries()[name](spark, d) for d in ("/root/testdata/sf0.001", far_keys))
    assert dict(near.dtypes)["tag_id"] == "bigint" and dict(far.dtypes)["tag_id"] == "decimal(38,0)"
    others = [c for c in near.columns if c != "tag_id"]
    ids = lambda df, more: sorted((int(r.tag_id) + more, str([r[c] for c in others])) for r in df.collect())
    assert ids(far, 0) == ids(near, FAR * 8 * adapters.PLACES)


def test_flags_come_with_the_first_biotype(spark, nothing_broadcast):
    """Whether a tag also hits a repeat is found where its first biotype is: isoforms' flags take no second join with the features, and none by tag."""
    found = reports.Base(spark, "/root/testdata/sf0.001").flagged()
    assert "Join" not in _plan(found) and len(_shuffles(found)) == 1
    rng = random.Random(6)
    spots = [rng.randrange(3 * intervals.BIN) for _ in range(90)]
    reads = spark.createDataFrame([("s", i, "c", "+-"[i % 2], s + 1, s + 22, "ACGT" * 5) for i, s in enumerate(spots)], "sample string, tag_id long, chrom string, strand string, t_start long, t_end long, seq string")
    features = [("c", s, s + 30, rng.choice("+-"), rng.choice(["miRNA", "tRNA", "rmsk", "other"]), f"f{i % 9}") for i, s in enumerate(spots)]
    of = spark.createDataFrame(features, "chrom string, f_start long, f_end long, strand string, biotype string, name string")
    hits = intervals.annotate_intervals(reads, of)
    want = counting.flag_isoform(counting.prime_hits(hits), counting.label_rules(hits, reports.REPEATS))
    rows = sorted(map(tuple, want.collect()))
    for own in (counting.prime_hits(hits, rules=reports.REPEATS), counting.prime_hits(intervals.annotate_starts(reads, of, 21), dealt=("chrom", "strand", "_bin"), rules=reports.REPEATS)):
        assert sorted(map(tuple, counting.flag_isoform(own).collect())) == rows
        tags = lambda df: sorted(map(tuple, df.select("tag_id", "biotype", "anno").collect()))
        assert tags(own) == tags(counting.prime_hits(hits))
    assert {r[3] for r in rows} == {True, False}
