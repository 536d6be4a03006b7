"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` tables hashes a vector with ``hashes`` functions
floor((a.x + b) / w), a drawn from a normal (2-stable) distribution.  A query
visits buckets in the order of their estimated chance to hold a near vector: the
perturbations of its own bucket by the sum of the squared distances to the
boundaries crossed.  Candidates of all tables are merged and ranked by exact
distance.

A bounded sample (``SAMPLE`` vectors) sets w and the number of probes, which is
the least that reaches ``TARGET`` recall within the sample; every vector is
indexed.  Equal vectors are one entry with their k + 1 smallest ids, which is all
that a top k can use.  Buckets over ``BUCKET`` entries are dealt to several
parts, and queries visit all of a bucket's parts.  A task holds one part of the
index and one block of at most about ``ASKING`` queries, however many visit the
part.  Queries that find fewer than k candidates are searched exactly, in blocks.

Defined results: vectors that are null, zero, of another length than most, or
that hold null or non-finite components take no part, nor do null ids; fewer than
k candidates are all returned; ties go to the smaller id; an id that occurs with
several vectors counts at its nearest one; wholly repeated rows count once; no
rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

TABLES, HASHES, SAMPLE, SAMPLE_QUERIES, TARGET = 4, 8, 4000, 100, 0.96
#: Entries of a bucket part, and of a part of the index that one task searches; past so many parts they are larger, up to LARGE, so that
#: queries are copied to fewer of them; queries of a block.
BUCKET, PART, PARTS, LARGE, ASKING = 4_000, 4_000, 200, 32_768, 32_768
_PROBES = (10, 20, 40, 80, 120, 160, 240, 320, 480, 640, 960, 1280, 1920, 2560, 3840, 6561)


@dataclass
class Hashing:
    """Projections (dimensions x tables*hashes), offsets, width and number of probes."""

    project: np.ndarray
    offset: np.ndarray
    width: float
    probes: int

    def place(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.project + self.offset) / self.width

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bucket code of each vector in each table."""
        return _code(np.floor(self.place(x)).astype(np.int64).reshape(len(x), TABLES, HASHES))

    def visits(self, x: np.ndarray, probes: int | None = None) -> np.ndarray:
        """Bucket codes that each query visits in each table, likeliest first."""
        place = self.place(x).reshape(len(x), TABLES, HASHES)
        low = np.floor(place)
        part = place - low
        cost = np.stack([part**2, np.zeros_like(part), (1 - part) ** 2], -1)  # for a step of -1, 0, 1
        steps = np.array(list(itertools.product((-1, 0, 1), repeat=HASHES)))
        total = sum(cost[:, :, i, steps[:, i] + 1] for i in range(HASHES))
        n = min(probes or self.probes, len(steps))
        best = np.argsort(total, axis=2, kind="stable")[:, :, :n]
        return _code(low[:, :, None, :].astype(np.int64) + steps[best])


def _code(cells: np.ndarray) -> np.ndarray:
    """A 64-bit code of cell coordinates (the last axis)."""
    code = np.zeros(cells.shape[:-1], np.uint64)
    for i in range(cells.shape[-1]):
        code = (code ^ cells[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(31)
    return code.view(np.int64)


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (q * q).sum(1)[:, None] - 2 * q @ x.T + (x * x).sum(1)[None]))


def fit(sample: np.ndarray, k: int, seed: int = 11) -> Hashing:
    """Width and number of probes for a sample of distinct vectors."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    project = rng.normal(size=(dims, TABLES * HASHES))
    queries = sample[:: max(1, len(sample) // SAMPLE_QUERIES)]
    far = np.sort(_distances(queries, sample), axis=1)[:, : k + 1]
    width = 1.8 * float(np.median(far[:, -1])) or 1.0
    hashing = Hashing(project, rng.uniform(0, width, TABLES * HASHES), width, _PROBES[-1])
    codes = hashing.codes(sample)
    for probes in _PROBES:
        hits = n = 0
        for q, limit in zip(queries, far[:, -1]):
            seen = np.zeros(len(sample), bool)
            for t, visit in enumerate(hashing.visits(q[None], probes)[0]):
                seen |= np.isin(codes[:, t], visit)
            near = _distances(q[None], sample)[0] <= limit
            hits, n = hits + (near & seen).sum(), n + near.sum()
        if hits >= TARGET * n:
            hashing.probes = probes
            break
    return hashing


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (doubles) of the vectors that take part."""
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = kept.where(finite & F.exists("v", lambda x: x != 0))
    most = kept.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return kept.where(F.size("v") == (most["dims"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


_FOUND = "cid long, near long, ids array<long>, score double"


def _best(query_ids: np.ndarray, q: np.ndarray, index: pd.DataFrame, x: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, entry, ids, distance) of the k + 1 nearest entries by exact distance, and of ties with the last."""
    for begin in range(0, len(q), 64):
        rough = _distances(q[begin : begin + 64], x)
        n = min(k + 1, len(x))
        limit = np.partition(rough, n - 1, axis=1)[:, n - 1] * (1 + 1e-9) + 1e-6
        for row, most, cid, vector in zip(rough, limit, query_ids[begin : begin + 64], q[begin : begin + 64]):
            at = np.flatnonzero(row <= most)
            exact = np.sqrt(((x[at] - vector) ** 2).sum(1))
            yield from ((int(cid), int(index[0][i]), index[1][i], float(d)) for i, d in zip(at, exact))


def _search(index: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The nearest entries of one part of the index to the queries that visit it."""
    rows: list[tuple] = []
    if index.num_rows and queries.num_rows:
        x, q = _matrix(index["v"].combine_chunks()), _matrix(queries["v"].combine_chunks())
        entry = (index["near"].to_numpy(), index["ids"].to_pylist())
        bucket = index["bucket"].to_numpy()
        visits = queries["buckets"].combine_chunks()
        owner = np.repeat(np.arange(len(q)), visits.value_lengths().to_numpy())
        visited = visits.flatten().to_numpy()
        order, by = np.argsort(bucket, kind="stable"), np.argsort(visited, kind="stable")
        found: dict[int, dict[int, tuple]] = {}  # an entry that several tables give counts once
        for b in np.intersect1d(bucket, visited):
            members = order[slice(*np.searchsorted(bucket[order], [b, b + 1]))]
            asking = owner[by[slice(*np.searchsorted(visited[by], [b, b + 1]))]]
            part = (entry[0][members], [entry[1][i] for i in members])
            for row in _best(queries["cid"].to_numpy()[asking], q[asking], part, x[members], k):
                found.setdefault(row[0], {})[row[1]] = row
        for near in found.values():
            rows += sorted(near.values(), key=lambda r: (r[3], r[1]))[: k + 1]
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.table({"cid": pa.array(columns[0], pa.int64()), "near": pa.array(columns[1], pa.int64()), "ids": pa.array(columns[2], pa.list_(pa.int64())), "score": pa.array(columns[3], pa.float64())})


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: each query's k nearest other vectors by Euclidean distance."""
    spark = vectors.sparkSession
    small_batches(spark)
    valid = written(clean(vectors, id_col, vector_col))
    total = valid.count()
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, total // 100_000 + 1)))
    smallest = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    part_ids = valid.groupBy("v", salt.alias("s")).agg(smallest(F.collect_list("vec_id")).alias("ids"))
    entries = part_ids.groupBy("v").agg(smallest(F.flatten(F.collect_list("ids"))).alias("ids"))
    entries = written(entries.select(F.element_at("ids", 1).alias("near"), "ids", "v"))
    sample = entries.orderBy(F.xxhash64("near")).select("v").limit(SAMPLE).collect()
    asked = written(valid.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct().join(entries.select(F.col("near").alias("cid"), "v"), "v").select("query_id", "cid"))
    queries = written(entries.join(asked.select(F.col("cid").alias("near")).distinct(), "near").select(F.col("near").alias("cid"), "v"))
    if not sample:
        empty = "query_id long, rank int, vec_id long, score double"
        return spark.createDataFrame([], empty)
    hashing = spark.sparkContext.broadcast(fit(np.array([r["v"] for r in sample]), k))
    found = written(_probe(entries, queries, hashing, k))
    top = _top(found, asked, k)
    # how many candidates there are for any query; only few-vector tables and far-off queries come short
    few = asked.join(top.groupBy("query_id", "cid").agg(F.count("*").alias("n")), ["query_id", "cid"], "left")
    few = written(few.where(F.coalesce("n", F.lit(0)) < min(k, max(0, total - 1))).select("cid").distinct())
    if few.isEmpty():
        return top.drop("cid")
    rest = _all(entries, queries.join(few, "cid", "left_semi"), k)
    return _top(found.join(few, "cid", "left_anti").union(rest), asked, k).drop("cid")


def _parts(rows: int) -> int:
    return max(1, min(rows // PART, max(PARTS, rows // LARGE)))


def _paired(left: DataFrame, right: DataFrame, queries: int, k: int) -> DataFrame:
    """What the rows of each part find: index rows (left) meet each block of the queries (right) of their part in a task of its own."""
    blocks = max(1, -(-queries // ASKING))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = right.withColumn("block", F.pmod(F.xxhash64("cid", F.lit(7)), F.lit(blocks)).cast("int"))
    keys = ["part", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: _search(a, b, k), _FOUND)


def _probe(entries: DataFrame, queries: DataFrame, hashing, k: int) -> DataFrame:
    """The k + 1 nearest entries to each query in each part of the index that it visits."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = hashing.value.codes(_matrix(batch.column("v")))
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(codes[:, t] + t), *batch.columns], ["bucket", "near", "ids", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 16):
                part = batch.slice(begin, 16)
                codes = hashing.value.visits(_matrix(part.column("v"))) + np.arange(TABLES)[:, None]
                cid = np.repeat(part.column("cid").to_numpy(), codes[0].size)
                yield pa.RecordBatch.from_arrays([pa.array(codes.ravel()), pa.array(cid)], ["bucket", "cid"])

    placed = entries.mapInArrow(index, "bucket long, near long, ids array<long>, v array<double>")
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    hot = written(sizes.where(F.col("n") > BUCKET).select("bucket", F.ceil(F.col("n") / BUCKET).cast("int").alias("parts")))
    parts = _parts(TABLES * entries.count())
    salted = placed.join(hot, "bucket", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("near"), F.col("parts")).cast("int"), F.lit(0)))
    where = F.pmod(F.xxhash64("bucket", "salt"), F.lit(parts)).alias("part")
    left = salted.select(where, "bucket", "near", "ids", "v")
    visits = queries.mapInArrow(visit, "bucket long, cid long").join(hot, "bucket", "left")
    visits = visits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)))))
    right = visits.select(where, "cid", "bucket").groupBy("part", "cid").agg(F.collect_set("bucket").alias("buckets")).join(queries, "cid")
    return _paired(left, right, queries.count(), k)


def _all(entries: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest entries to each query in each block, over all blocks."""
    parts = _parts(entries.count())
    left = entries.select(F.pmod(F.xxhash64("near"), F.lit(parts)).alias("part"), F.lit(0).cast("long").alias("bucket"), "near", "ids", "v")
    right = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "cid", F.array(F.lit(0).cast("long")).alias("buckets"), "v")
    return _paired(left, right, queries.count(), k)


def _top(found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, cid, rank, vec_id and score from what all parts found."""
    near = found.select("cid", F.explode("ids").alias("vec_id"), "score").groupBy("cid", "vec_id").agg(F.min("score").alias("score"))
    order = lambda key: Window.partitionBy(*key).orderBy("score", "vec_id")
    near = near.withColumn("r", F.row_number().over(order(["cid"]))).where(F.col("r") <= k + 1).drop("r")
    per_query = asked.join(near, "cid").where("vec_id <> query_id")
    ranked = per_query.withColumn("rank", F.row_number().over(order(["query_id", "cid"])))
    return ranked.where(F.col("rank") <= k).select("query_id", "cid", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
