"""All queries over the given tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aligned, reports


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: (lambda spark, sf_dir, build=build: reports.rounded(build(aligned.Aligned.of(spark, sf_dir)))) for name, (build, *_) in aligned.REPORTS.items()}
    return reports.queries() | found


def oracle_sql() -> dict[str, str]:
    return reports.oracle_sql() | {name: reports._with(reports._shifted(sql), needs, aligned.CTES, aligned.NEEDS) for name, (_, sql, needs) in aligned.REPORTS.items()}
