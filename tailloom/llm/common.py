"""Helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows in an Arrow batch given to Python: bounds a worker's memory when texts are long.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Give Python workers batches of at most BATCH_ROWS rows.

    Queries run after they are built, so the setting stays; all operators share one bound, and a smaller one is left.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it unlike all columns of df."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def field_sql(df: DataFrame, *names: str) -> str:
    """The schema of columns of df, as text."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema if f.name in names)


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tailloom-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root}/tailloom-{uuid.uuid4().hex}"


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df, computed once into a table of the shared folder: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # nothing reads the shuffles again
    before = spark.conf.get(clean, None)
    spark.conf.set(clean, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(clean) if before is None else spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_rows(schema: pa.Schema, rows: Iterable[tuple], block: int = 4096, block_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size from tuples in the order of the schema's fields."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str, list)))
        if len(held) >= block or size >= block_bytes:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
