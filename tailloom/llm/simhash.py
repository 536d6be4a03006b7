"""Near duplicates by SimHash and a Gray-order hierarchical index.

A document's fingerprint has 64 bits, each the majority vote of its word
shingles' XXH64 values.  Fingerprints at most ``max_bits`` apart are linked; a
group is what links connect.  Equal fingerprints are one node from the start,
so copies never multiply.

Search: two fingerprints within ``max_bits`` agree on one of ``max_bits + 1``
blocks of bits.  For each block the fingerprints are rotated so that the block
leads and put in Gray order (by the rank of the rotated value in the reflected
binary code).  Quantiles of the ranks cut that order into ranges of equal size,
whatever the values' distribution; a fingerprint is stored in its own range and
visits later ranges that may hold partners with an equal leading block.  In a
range, windows of neighbours in Gray order are factored bottom-up: a node keeps
the bits that all below it share, and passes to its own parent what siblings
share.  A search goes down level by level with the differences summed up so
far, and drops a whole group once the sum is over the limit.  Only a spanning
forest of the links found leaves a range, never all pairs.

Defined results: null and empty text, and text without words, have fingerprint
zero, which links like any other; repeated rows share a fingerprint and thus a
group; a null doc_id has a fingerprint and takes part in no minimum; no rows
give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, shuffle_width, small_batches, written

#: Fingerprints in a range of the Gray order, about.
RANGE_ROWS = 100_000
#: Children of a node of the hierarchical index.
FANOUT = 16
#: Shingles voted on at once, and queries searched at once: bounds on memory.
VOTE_BLOCK, SEARCH_BLOCK = 1 << 16, 1 << 13


def fingerprint(text: str | None, words_each: int = 3, seed: int = 42) -> int:
    """SimHash of a whole text over shingles of lower-cased (A-Z only) words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words_each, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(starts), VOTE_BLOCK):
        spans = zip(starts[i : i + VOTE_BLOCK].tolist(), ends[i : i + VOTE_BLOCK].tolist())
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = 3) -> DataFrame:
    """doc_id and fp (64 bits as a signed long) of every document."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, words_each) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def blocks_of(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the max_bits + 1 blocks."""
    cuts = np.linspace(0, 64, max_bits + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:])]


def rotate(fp: np.ndarray, by: int) -> np.ndarray:
    """Rotate left, so that the block at that distance from the top leads."""
    return fp if by == 0 else (fp << np.uint64(by)) | (fp >> np.uint64(64 - by))


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected binary (Gray) order."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under nodes that hold the bits shared below them."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (mask, pattern), leaves first
        pattern, mask = codes[self.order], np.full(len(codes), ~np.uint64(0))
        while True:
            self.levels.append((mask, pattern))
            if len(pattern) <= FANOUT:
                break
            starts = np.arange(0, len(pattern), FANOUT)
            parent = np.repeat(starts, np.diff([*starts, len(pattern)]))
            differ = np.bitwise_or.reduceat(pattern ^ pattern[parent], starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~differ
            self.levels[-1] = (mask & ~np.repeat(shared, np.diff([*starts, len(pattern)])), pattern)
            mask, pattern = shared, pattern[starts]

    def pairs(self, queries: np.ndarray, max_bits: int, lead: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query numbers, code numbers) within max_bits and equal in the lead first bits."""
        top = ~np.uint64(0) << np.uint64(64 - lead) if lead else np.uint64(0)
        for begin in range(0, len(queries), SEARCH_BLOCK):
            block = queries[begin : begin + SEARCH_BLOCK]
            n = len(self.levels[-1][0])
            q, node = np.repeat(np.arange(len(block)), n), np.tile(np.arange(n), len(block))
            spent = np.zeros(len(q), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[depth]
                differ = (block[q] ^ pattern[node]) & mask[node]
                spent = spent + np.bitwise_count(differ)
                keep = (spent <= max_bits) & (differ & top == 0)
                q, node, spent = q[keep], node[keep], spent[keep]
                if depth:
                    width = np.minimum(FANOUT, len(self.levels[depth - 1][0]) - node * FANOUT)
                    q, spent = np.repeat(q, width), np.repeat(spent, width)
                    node = np.repeat(node * FANOUT - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
            yield q + begin, self.order[node]


class Forest:
    """Union-find over 0..n-1, whole arrays of links at once; a root is the smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            root = self.roots()
            x, y = root[a], root[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def _range_links(frame: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Spanning links among the rows of one range; visitors are compared with residents only."""
    blocks = blocks_of(max_bits)
    fp = frame["fp"].to_numpy().view(np.uint64)
    first, lead = blocks[int(frame["block"].iat[0])]
    code, home = rotate(fp, first), np.flatnonzero(frame["home"].to_numpy())
    forest = Forest(len(fp))
    if len(home):
        index = GrayIndex(code[home])
        for q, found in index.pairs(code, max_bits, lead):
            forest.link(q, home[found])
    root = forest.roots()
    out = np.flatnonzero(root != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[out].view(np.int64), "b": fp[root[out]].view(np.int64)})


def links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of nodes (a column fp) as all links do."""
    spark, blocks = nodes.sparkSession, blocks_of(max_bits)
    width = shuffle_width(spark)
    flip = np.uint64(1) << np.uint64(63)  # order of unsigned ranks in signed longs

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for k, (first, _) in enumerate(blocks):
                rank = gray_rank(rotate(fp, first)) ^ flip
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), batch.column(0), pa.array(rank.view(np.int64))], ["block", "fp", "rank"])

    ranked = nodes.select("fp").mapInArrow(spread, "block int, fp long, rank long")
    n = nodes.count()
    ranges = max(width, -(-len(blocks) * n // RANGE_ROWS)) // len(blocks) + 1
    cuts = [i / ranges for i in range(1, ranges)]
    found = ranked.groupBy("block").agg(F.percentile_approx("rank", cuts, 20 * ranges).alias("cuts")).collect() if n and cuts else []
    bounds = spark.sparkContext.broadcast({r["block"]: np.unique(np.array(r["cuts"], np.int64)) for r in found})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("range", pa.int64()), ("block", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])
        for batch in batches:
            blocks_in = batch.column(0).to_numpy()
            for k in np.unique(blocks_in).tolist():
                pick = blocks_in == k
                fp, rank = batch.column(1).to_numpy()[pick], batch.column(2).to_numpy()[pick]
                cut = bounds.value.get(k, np.zeros(0, np.int64))
                lead = blocks[k][1]
                own = np.searchsorted(cut, rank, "right")
                # ranks with the same leading block are one stretch; its last value bounds the ranges to visit
                last = (rank.view(np.uint64) | (~np.uint64(0) >> np.uint64(lead))).view(np.int64)
                more = np.searchsorted(cut, last, "right") - own
                yield from _dealt(schema, k, fp, own, np.ones(len(fp), bool))
                while more.any():
                    go = more > 0
                    fp, own, rank, last, more = fp[go], own[go] + 1, rank[go], last[go], more[go] - 1
                    near = _may_hold(fp, own, cut, blocks[k][0], last, max_bits)
                    yield from _dealt(schema, k, fp[near], own[near], np.zeros(int(near.sum()), bool))

    def _dealt(schema, k, fp, own, home):
        if len(fp):
            yield pa.RecordBatch.from_arrays([pa.array(own * len(blocks) + k), pa.array(np.full(len(fp), k, np.int32)), pa.array(fp), pa.array(home)], schema=schema)

    dealt = ranked.mapInArrow(deal, "range long, block int, fp long, home boolean")
    return dealt.groupBy("range").applyInPandas(lambda frame: _range_links(frame, max_bits), "a long, b long")


def _may_hold(fp: np.ndarray, own: np.ndarray, cut: np.ndarray, first: int, last: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether the range may hold a partner, by the bits that all ranks of its stretch share."""
    flip = np.uint64(1) << np.uint64(63)
    low = cut[own - 1].view(np.uint64) ^ flip
    high = np.minimum(np.where(own < len(cut), cut[np.minimum(own, len(cut) - 1)], np.int64(2**63 - 1)), last).view(np.uint64) ^ flip
    free = low ^ high
    for shift in (1, 2, 4, 8, 16, 32):
        free |= free >> np.uint64(shift)
    code = low ^ (low >> np.uint64(1))  # the Gray code of that rank
    return np.bitwise_count((rotate(fp.view(np.uint64), first) ^ code) & ~free) <= max_bits


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of edges (a, b): alternating large and small stars.

    Each step is written to the shared folder.  Minima are taken by aggregation and joined back, so a
    node with very many neighbours is never gathered in one place.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.union(now.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        now = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        now = now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = now.groupBy("a").agg(F.min("b").alias("m"))
        small = now.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", "m")).toDF("a", "b").where("a <> b")
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == state:
            break
        state = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def near_duplicates(docs: DataFrame, words_each: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp and component_id (the group's smallest doc_id) of every document."""
    prints = written(fingerprints(docs, words_each))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    groups = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    of_node = nodes.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = of_node.groupBy("component").agg(F.min("low").alias("component_id"))
    member = of_node.select("fp", "component").join(lowest, "component").select("fp", "component_id")
    return prints.join(member, "fp").select("doc_id", "fp", "component_id")
