"""Assembly, orders, measures and small filters."""

import duckdb
import pytest

from tailloom.operators import counting, differential, intervals, profiles
from tailloom.plans import reports
from tailloom.sources import readers, writers

SF = "/root/testdata/sf0.001"
NEW = [
    "exclude_overlapping", "assemble_features", "assembled_type_counts", "ordered_hits", "ordered_hits_others", "match_biotype", "length_window", "filter_arm", "token_length_tables", "seed_totals",
    "measure_folds", "measure_preferences", "length_difference_samples", "order_by_total", "order_difference", "region_expression",
]


@pytest.mark.parametrize("name", NEW)
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = reports.queries()[name](spark, SF)
    result = con.execute(reports.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in sorted(df.columns)]
    got, want = df.select(*sorted(df.columns)).collect(), result.fetchall()
    assert got and sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r[i] for i in at)) for r in want)


def test_exclusion_keeps_repeated_rows_and_nulls(spark):
    schema = "chrom string, f_start long, f_end long, strand string, biotype string, name string"
    rows = [("c", 1, 9, "+", "miRNA", None)] * 2 + [("c", 5, 9, "-", "miRNA", "x"), ("c", 20, 30, "+", "miRNA", None), (None, 1, 9, "+", "miRNA", "y")]
    genes = spark.createDataFrame(rows, schema)
    mirtron = spark.createDataFrame([("c", 30, 40, "+", "mirtron", "m")], schema)
    left = intervals.exclude_overlapping(genes, mirtron).collect()
    assert sorted((str(r.chrom), r.f_start) for r in left) == [("None", 1), ("c", 1), ("c", 1), ("c", 5)]
    trna = spark.createDataFrame([("c", 50, 60, "+", "Mt_tRNA", "t")], schema)
    assert sorted((r.biotype, str(r.name)) for r in intervals.assemble_features(genes, mirtron, trna).where("f_start >= 20").collect()) == [("mirtron", "m"), ("tRNA", "Mt_tRNA_t")]


def test_ordered_hits(spark):
    hits = spark.createDataFrame([(1, "tRNA", "t"), (1, "miRNA", "m"), (1, "mirbase", "b"), (2, "rmsk", "r"), (3, "rmsk", "r"), (3, "mirbase", "b")], "tag_id long, biotype string, name string")
    assert sorted(tuple(r)[:3] for r in counting.ordered_hits(hits).collect()) == [(1, 1, "miRNA"), (1, 2, "mirbase"), (3, 1, "mirbase")]
    assert sorted(tuple(r)[:3] for r in counting.ordered_hits(hits, ["tRNA"], True).collect()) == [(1, 1, "tRNA"), (1, 2, "miRNA"), (1, 3, "mirbase"), (2, 1, "rmsk"), (3, 1, "rmsk"), (3, 2, "mirbase")]


def test_differential_order(spark):
    totals = spark.createDataFrame([("s", "a", 100.0), ("u", "a", 10.0), ("s", "b", 60.0), ("u", "b", 50.0), ("s", "c", 1.0)], "sample string, anno string, ppm double")
    rows = differential.differential_summary(differential.with_p(profiles.pairwise_fold(totals)), totals).orderBy("place").collect()
    assert [r.anno for r in rows] == ["a", "b", "c"] and abs(rows[0].min_p - 0.016032) < 1e-5


def test_tags_round_trip(spark, tmp_path):
    tags = spark.createDataFrame([(1, "s"), (2, "t")], "tag_id long, sample string")
    writers.write_tags(tags, str(tmp_path / "tags"))
    assert sorted(tuple(r) for r in readers.read_tags(spark, str(tmp_path / "tags")).select("tag_id", "sample").collect()) == [(1, "s"), (2, "t")]
