"""Reports from alignments, tags' mismatches, regions in bins, and the stored facts."""

import random

import duckdb
import pytest

from tailloom.operators import profiles, regions, tags, views
from tailloom.plans import aligned, catalog, reports

SF = "/root/testdata/sf0.001"
NEW = [
    *aligned.REPORTS, "end_heterogeneity", "tail_profile", "tail_profile_isoform", "tail_bases", "length_distribution", "length_distribution_isoform", "isoform_marks", "token_table_marked", "tail_breakdown_isoform",
    "pairwise_differential", "preference_significant", "preference_targets_significant", "differential_filter", "volcano_points", "differential_summary", "biotype_counts", "seed_map_reads",
]


@pytest.mark.parametrize("name", NEW)
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("lineitem", "part", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = catalog.queries()[name](spark, SF)
    result = con.execute(catalog.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in sorted(df.columns)]
    plain = lambda rows: sorted(repr([f"{x:.3f}" if isinstance(x, float) else x for x in r]) for r in rows)
    assert plain(df.select(*sorted(df.columns)).collect()) == plain([[r[i] for i in at] for r in result.fetchall()])


def test_every_report_scans_the_tags_twice_at_most(spark):
    for name, query in catalog.queries().items():
        plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_orderkey") == 0 or plan.count("Relation [l_orderkey") <= 2, name


def test_facts_are_written_once(spark):
    one, other = reports.Base.of(spark, SF), reports.Base.of(spark, SF)
    assert one is other and one.iso().inputFiles() == other.iso().inputFiles()
    assert aligned.Aligned.of(spark, SF) is not one


def test_matched_part_and_conversions(spark):
    """On the reverse strand the clipped tail comes first; a converted T is apart, and the template has it back."""
    schema = "sample string, qname string, flag int, rname string, pos long, cigar string, seq string, md string, nh int, tl string"
    rows = [("s", "a", 16, "1", 5, "2S8M", "GGACGTTGCA", "1A0C5", 1, "CC"), ("s", "b", 0, "chr1", 5, "8M2S", "ACCTTGCAGG", "2T5", 2, "GG"), ("s", "c", 0, "chr1", 5, "8M", "ACCTTGCA", "0^A8", 1, "")]
    parsed = tags.seed_mismatch_tag(tags.parse_mismatches(tags.decode_alignment(spark.createDataFrame(rows, schema)), True))
    got = {r.qname: (r.md_tag, r.tc_tag, r.templated, r.seed_md, r.md_error) for r in parsed.collect()}
    # a: ACGTTGCA shows C for the template's A, and G for its C; read from the other strand
    assert got == {"a": ("5C6G", "", "TGCAAGTT", "4C5G", False), "b": ("", "2C", "ACTTTGCA", "", False), "c": ("", "", "ACCTTGCA", "", True)}
    plain = {r.qname: (r.md_tag, r.tc_tag) for r in tags.parse_mismatches(tags.decode_alignment(spark.createDataFrame(rows, schema))).collect()}
    assert plain["b"] == ("2C", "")
    twice = tags.collapse_tags(parsed.union(parsed.withColumn("qname", parsed.qname.substr(1, 1)))).collect()
    assert sorted((r.tag_id, r.reads, r.md_tag, r.tc_tag) for r in twice) == [("a", 2, "5C6G", ""), ("b", 2, "", "2C"), ("c", 2, "", "")]


def greedy(rows, limit):
    """Clusters by a walk over regions in order."""
    out = []
    for start, end, ppm in sorted(rows):
        if out and (end - out[-1][0] <= limit or start <= out[-1][1]):
            out[-1] = [out[-1][0], max(out[-1][1], end), out[-1][2] + ppm]
        else:
            out.append([start, end, ppm])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("limit,width", [(0, 16), (60, 16), (60, 1 << 16), (400, 64), (10**9, 1)])
def test_bounded_merging_in_bins(spark, limit, width):
    rng = random.Random(limit + width)
    rows = [(s, c, a := rng.randrange(4000), a + rng.choice([1, 20, 20, 20, 90]), float(rng.randrange(1, 9))) for s in "xy" for c in "12" for _ in range(120)]
    got = regions.merge_regions(spark.createDataFrame(rows, "sample string, chrom string, t_start long, t_end long, ppm double"), limit, width)
    want = [(s, c, *x) for s in "xy" for c in "12" for x in greedy([r[2:] for r in rows if r[:2] == (s, c)], limit)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_islands_in_bins(spark, width):
    rng = random.Random(width)
    rows = sorted({("m", "c", "+", a := rng.randrange(900), a + rng.choice([1, 5, 40])) for _ in range(150)})
    df = spark.createDataFrame(rows, "anno string, chrom string, strand string, t_start long, t_end long")
    for gap in (0, 4):
        got = {(r.t_start, r.t_end): r.island for r in regions.islands(df, ["anno", "chrom", "strand"], gap, width).collect()}
        want, island, reach = {}, None, -(10**9)
        for *_, a, b in rows:
            island = a if a > reach + gap else island
            reach = max(reach, b)
            want[a, b] = island
        assert got == want
    assert regions.islands(df.limit(0), ["anno"], 0, width).count() == 0


@pytest.mark.parametrize("width", [1, 8, 1 << 12])
def test_coverage_in_bins(spark, width):
    """Events at the ends of reads give what adding up every base does."""
    rng = random.Random(width)
    rows = []
    for i in range(60):
        start, n = rng.randrange(1, 60), rng.randrange(18, 24)
        at = rng.randrange(n)
        rows.append((i, "m", "c", rng.choice("+-"), start, start + n, n, rng.choice(["", "A", "TT", "CAN"]), float(rng.randrange(1, 9)), rng.choice(["", f"{at}G"]), rng.choice(["", f"{(at + 1) % n}C"])))
    df = spark.createDataFrame(rows, "tag_id long, anno string, chrom string, strand string, t_start long, t_end long, gm_len int, tail string, ppm double, md_tag string, tc_tag string")
    want = {}
    for _, _, _, strand, start, end, n, tail, ppm, md, tc in rows:
        for i in range(n + len(tail)):
            cell = want.setdefault((strand, start + i if strand == "+" else end - 1 - i), dict.fromkeys(["ppm", "templated", "mismatch", "tc", "a", "c", "g", "u"], 0.0))
            cell["ppm"] += ppm
            if i < n:
                cell["templated"] += ppm
                for tag, kind in ((md, "mismatch"), (tc, "tc")):
                    if tag and int(tag[:-1]) == i:
                        cell[kind] += ppm
                        cell[tag[-1].lower()] += ppm
            elif (b := tail[i - n].replace("T", "U").lower()) in cell:
                cell[b] += ppm
    got = profiles.pileup_coverage(df, width).collect()
    assert {(r.strand, r.pos): {k: round(r[k], 6) for k in next(iter(want.values()))} for r in got} == want and len(got) == len(want)
    for r in got:
        assert sum(r[f"share_{k}"] for k in ("templated", "a", "c", "g", "u")) == pytest.approx(1 if r.templated + r.a + r.c + r.g + r.u > 1e-9 else 0)
    assert {s: max(r.scaled for r in got if r.strand == s) for s in "+-"} == {"+": pytest.approx(100), "-": pytest.approx(100)}


def test_segments_use_islands(spark):
    rows = [("m", "c", "+", 1, 20, 5.0), ("m", "c", "+", 15, 30, 1.0), ("m", "c", "+", 40, 60, 5.5), ("n", "c", "-", 3, 9, 1.0)]
    got = views.pileup_segments(spark.createDataFrame(rows, "anno string, chrom string, strand string, t_start long, t_end long, ppm double")).collect()
    assert sorted(tuple(r) for r in got) == [("m", "c", "+", 1, 30, 6.0), ("n", "c", "-", 3, 9, 1.0)]
