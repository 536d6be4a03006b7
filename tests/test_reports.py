import duckdb
import pytest

from tailloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["annotate_intervals", "biotype_composition", "quantile_normalize", "tail_breakdown", "merge_supported_ranges", "annotate_variants"])
def test_report_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("lineitem", "part", "orders"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(catalog.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    plain = lambda rows: sorted(str([f"{x:.3f}" if isinstance(x, float) else x for x in r]) for r in rows)
    assert plain(df.select(*columns).collect()) == plain([[r[i] for i in at] for r in result.fetchall()])


def test_composition_sums_to_100(spark):
    rows = catalog.queries()["biotype_composition"](spark, SF).groupBy("sample").sum("pct").collect()
    assert rows and all(abs(r[1] - 100) < 0.01 for r in rows)
