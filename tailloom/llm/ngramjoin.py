"""Exact similarity self-join of word n-gram sets, by signature trees over shared rare shingles.

A text's set are the 64-bit hashes of its shingles of ``words`` lower-cased (A-Z
only) words.  Two texts link when 100 * intersection >= share * union.  Classes are
what links connect, and a class's links are found without listing all of them.

1. Equal sets are one set from here on.
2. Sets are ordered by one order of all shingles, those frequent in the corpus
   last.  Linked sets share one of the first n - ceil(share * n / 100) + 1 of
   their n shingles, so a bucket for each shingle that several sets have there
   holds every link.  Of buckets with the same members one stays.
3. In each bucket a signature tree finds the pairs that may link, and the bucket
   gives a forest of what these connect.  Over all buckets they connect clusters;
   every link is inside one.
4. Each set goes whole to its cluster, where a signature tree finds the pairs that
   may link by all of their shingles.  Those whose ends aren't connected yet are compared, and the
   cluster gives a forest of links.

So no step gives more rows than it has members of buckets or clusters, however many
pairs these hold.  Large buckets and clusters are searched in blocks, each pair of blocks in a
group of its own.

A signature tree's leaves are sets by size; each holds a bitmap of the shingles at
the front of its order.  A node holds the OR of the bitmaps below it, the range of
their sizes and the most shingles that any of them lost to shared bits.  Of linked
sets, the one whose front ends first has at most ceil(share * n / 100) - 1 shingles
behind it, so common bits, plus such losses, plus these bound the overlap of any two
sets below two nodes; a pair of nodes goes once the bound or the sizes rule a link
out.  Bits are in the order of the shingles, so that two leaves are also compared up to
where the first of their fronts ends: what one has there and the other lacks is
no part of the overlap.  Two trees of bitmaps of one width are searched at once,
from the roots down.
Only sets in clusters are needed whole; they are made again from their texts.

Defined results: null and empty texts, and texts without words, have an empty set
and link with nothing; a text of fewer words than a shingle is one shingle;
repeated rows share a set; a null doc_id takes part in no minimum; no rows give no
rows; other columns are ignored.  A link is missed or made up only where 64-bit
hashes of two shingles of the same two texts, or 128-bit hashes of two sets, are
equal by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, field_sql, small_batches, written
from .simhash import Forest, components

WORDS, SHARE = 5, 80
#: A shingle is frequent if it is in one of so many rows of some CHUNK of shingles; at most FREQUENT of them are told apart, which only sets their order.
ONE_IN, CHUNK, FREQUENT = 1000, 1 << 21, 1 << 16
#: Sets of a block in step 3, and shingles of a block in step 4, about.
BLOCK, WHOLE = 1024, 1 << 20
#: Bits of a bitmap for each shingle of a set (then up to a power of two), of which the front needs a part, children of a node, and 64-bit words compared at once.
BITS, FANOUT, AT_ONCE = 8, 8, 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(13).integers(0, 2**64, 1 << 16, dtype=np.uint64)
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.int64)
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each lower-cased word: the sum of a random number for each of its bytes and their places."""
    raw = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[raw]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # of each word, among the bytes of words
    lengths = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    values = _RANDOM[(place & 0xFF) << 8 | _LOWER[raw[at]]]
    if lengths.max() > 256:
        values = values * (2 * (place >> 8).astype(np.uint64) + np.uint64(1))
    return _mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    hashes = word_hashes(text or b"")
    if not len(hashes):
        return hashes
    k = min(words, len(hashes))
    n = len(hashes) - k + 1
    grams = np.full(n, k, np.uint64)
    for i in range(k):
        grams = _mixed(grams * _MIX + hashes[i : i + n])
    return np.unique(grams)


def needed(one: np.ndarray | int, other: np.ndarray | int, share: int) -> np.ndarray | int:
    """The least overlap of linked sets of those sizes."""
    return -(-share * (one + other) // (100 + share))


def needed_in_front(low: tuple, high: tuple, share: int) -> np.ndarray | int:
    """The least number of shingles that linked sets share in their fronts, of sizes from low to high."""
    behind = -(-share * np.maximum(*high) // 100) - 1
    return np.maximum(1, needed(*low, share) - behind)


def linked(one: np.ndarray, other: np.ndarray, share: int) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both >= needed(len(one), len(other), share) and both > 0


def prefix(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, share: int) -> tuple[np.ndarray, int]:
    """The first tokens of a set in the order of all tokens (its front), as many as hold one of every link, and how many of these aren't frequent."""
    n = len(tokens) + share * len(tokens) // -100 + 1
    at = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
    often = frequent[at] == tokens if len(frequent) else np.zeros(len(tokens), bool)
    rare = tokens[~often]
    if len(rare) >= n:
        return rare[:n], len(rare[:n])
    last = tokens[often][np.argsort(counts[at[often]], kind="stable")]
    return np.concatenate([rare, last])[:n], len(rare)


class Signature(NamedTuple):
    """size of a set, length of its front, width: bits for all tokens that aren't frequent, by their first bits, of which map has those of the front (in 64-bit words), and end: bits before it have all such tokens of the set."""

    size: int
    length: int
    width: int
    end: int
    map: np.ndarray


def signature(size: int, front: np.ndarray, rare: int) -> Signature:
    log = max(6, (BITS * size - 1).bit_length())
    at = (front[:rare] >> np.uint64(64 - log)).astype(np.int64)
    bits = np.zeros(-(-(int(at[-1]) + 1) // 64) * 64 if rare else 64, bool)
    bits[at] = True
    return Signature(size, len(front), 1 << log, int(at[-1]) if rare == len(front) else 1 << log, np.packbits(bits, bitorder="little").view(np.uint64))


def halved(of: Signature) -> Signature:
    """A signature of half the width: bits by twos."""
    bits = np.unpackbits(of.map.view(np.uint8), bitorder="little").reshape(-1, 2).any(1)
    whole = np.concatenate([bits, np.zeros(-len(bits) % 64, bool)])
    return of._replace(width=of.width // 2, end=of.end // 2, map=np.packbits(whole, bitorder="little").view(np.uint64))


class SignatureTree:
    """Signatures of one width by size, under nodes of OR-combined bitmaps."""

    def __init__(self, found: list[Signature], share: int):
        m = np.zeros((len(found), max(len(f.map) for f in found)), np.uint64)
        for row, f in zip(m, found):
            row[: len(f.map)] = f.map
        n, length, end = (np.array([getattr(f, c) for f in found]) for c in ("size", "length", "end"))
        self.order = np.lexsort((m[:, 0], n))
        m, n, self.end = m[self.order], n[self.order], end[self.order]
        self.share, self.levels = share, [(m, n, n, length[self.order] - np.bitwise_count(m).sum(1, dtype=np.int64))]
        while len(self.levels[-1][0]) > FANOUT:
            m, low, high, lost = self.levels[-1]
            starts = np.arange(0, len(m), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(m, starts, axis=0), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(lost, starts)))

    def beside(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether leaves may link by what one has and the other lacks, up to where the first of their fronts ends."""
        m, n, *_ = self.levels[0]
        end = np.minimum(self.end[x], self.end[y])[:, None] - 64 * np.arange(m.shape[1])
        inside = np.where(end >= 64, ~np.uint64(0), (np.uint64(1) << np.clip(end, 0, 63).astype(np.uint64)) - np.uint64(1))
        need = needed(n[x], n[y], self.share)
        lacks = lambda p, q: np.bitwise_count(m[p] & ~m[q] & inside).sum(1, dtype=np.int64)
        return (lacks(x, y) <= n[x] - need) & (lacks(y, x) <= n[y] - need)

    def spans(self, labels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The least and largest label below each node of each level."""
        found = [(labels[self.order],) * 2]
        for m, *_ in self.levels[1:]:
            starts = np.arange(0, len(found[-1][0]), FANOUT)
            found.append((np.minimum.reduceat(found[-1][0], starts), np.maximum.reduceat(found[-1][1], starts)))
        return found

    def pairs(self, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (numbers of sets) of different labels that may link; labels may be joined between steps."""
        top, spans, at = len(self.levels) - 1, self.spans(labels), labels.copy()
        todo = [(top, *np.triu_indices(len(self.levels[top][0])))]
        while todo:
            depth, x, y = todo.pop()
            step = max(16, AT_ONCE // self.levels[depth][0].shape[1])
            if len(x) > step:
                todo.append((depth, x[step:], y[step:]))
                x, y = x[:step], y[:step]
            if not np.array_equal(at, labels):
                spans, at = self.spans(labels), labels.copy()
            (first, last), (maps, low, high, lost) = spans[depth], self.levels[depth]
            keep = ~((first[x] == last[x]) & (first[y] == last[y]) & (first[x] == first[y]))
            keep &= (100 * high[x] >= self.share * low[y]) & (100 * high[y] >= self.share * low[x])
            x, y = x[keep], y[keep]
            most = np.bitwise_count(maps[x] & maps[y]).sum(1, dtype=np.int64) + np.minimum(lost[x], lost[y])
            keep = most >= needed_in_front((low[x], low[y]), (high[x], high[y]), self.share)
            x, y = x[keep], y[keep]
            if not len(x):
                continue
            if depth == 0:
                keep = self.beside(x, y)
                if keep.any():
                    yield self.order[x[keep]], self.order[y[keep]]
                continue
            below = len(self.levels[depth - 1][0])
            i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
            x, y = (x[:, None] * FANOUT + i).ravel(), (y[:, None] * FANOUT + j).ravel()
            keep = (x <= y) & (x < below) & (y < below) if depth > 1 else (x < y) & (y < below)
            todo.append((depth - 1, x[keep], y[keep]))


def may_link(found: list[Signature], labels: np.ndarray, share: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (numbers of sets) of different labels that may link; labels may be joined between steps.

    There is a tree for each width of bitmaps, with those of twice the width halved: a width is a power of two, and
    linked sets' sizes differ by less than a factor of two.
    """
    widths = np.array([f.width for f in found])
    for width in np.unique(widths).tolist():
        own = widths == width
        held = np.flatnonzero(own | (widths == 2 * width))
        if len(held) < 2:
            continue
        here = labels[held]
        for x, y in SignatureTree([found[i] if own[i] else halved(found[i]) for i in held], share).pairs(here):
            x, y = held[x], held[y]
            keep = (own[x] | own[y]) & (labels[x] != labels[y])
            if keep.any():
                yield x[keep], y[keep]
                here[:] = labels[held]


def may_connect(found: list[Signature], share: int) -> np.ndarray:
    """For each set the first set that pairs that may link connect it with."""
    forest, labels = Forest(len(found)), np.arange(len(found))
    for x, y in may_link(found, labels, share):
        forest.link(x, y)
        labels[:] = forest.roots()
    return labels


def links(sets: list[np.ndarray], share: int) -> list[tuple[int, int]]:
    """Links (numbers of sets) that connect the sets as all their links do."""
    labels, kept = np.arange(len(sets)), []
    for x, y in may_link([signature(len(s), s, len(s)) for s in sets], labels, share):
        for i, j in zip(x.tolist(), y.tolist()):
            if labels[i] != labels[j] and linked(sets[i], sets[j], share):
                kept.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return kept


def in_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """The columns, as lists, of each run of rows equal in the first ones."""
    at, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:keys]]
        for i, key in enumerate(zip(*columns)):
            if key != at and held:
                yield list(zip(*held))
                held = []
            at = key
            held.append((*key, *(c[i].as_py() for c in batch.columns[keys:])))
    if held:
        yield list(zip(*held))


def _tokens(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def frequent_shingles(docs: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT shingles, those in most rows, with their counts; sorted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def often() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= max(4, len(held) // ONE_IN)
            return pa.RecordBatch.from_arrays([pa.array(found[keep].view(np.int64)), pa.array(n[keep])], names=["token", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.append(shingle_set(text.as_py(), words))
                size += len(held[-1])
                if size >= CHUNK:
                    yield often()
                    held, size = [], 0
        if held:
            yield often()

    found = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "token long, n long")
    top = found.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy(np.int64)[order]


class Classes(NamedTuple):
    """rows: the kept columns, text_key, n_shingles and set_key (null for empty sets); sets: set_key, set_id and class_id (a set_id)."""

    rows: DataFrame
    sets: DataFrame


def text_key() -> Column:
    return F.unhex(F.md5("text"))


def prepared(docs: DataFrame, keep: list[str], words: int, share: int, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The kept columns of docs, uid, text_key, n_shingles, set_key, and the front of the set (prefix, and rare of its tokens), written."""
    frequent = docs.sparkSession.sparkContext.broadcast(often)
    source = docs.select(*keep, F.monotonically_increasing_id().alias("uid"), text_key().alias("text_key"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, first, rare = [], [], [], []
            for text in batch.columns[-1]:
                tokens = shingle_set(text.as_py(), words)
                n.append(len(tokens))
                keys.append(hashlib.md5(tokens.tobytes()).digest() if len(tokens) else None)
                front, k = prefix(tokens, *frequent.value, share)
                first.append(front.view(np.int64))
                rare.append(k)
            columns = [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(rare, pa.int64()), pa.array(first, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "n_shingles", "set_key", "rare", "prefix"])

    schema = field_sql(source, *keep, "uid", "text_key") + ", n_shingles long, set_key binary, rare long, prefix array<long>"
    return written(source.mapInArrow(run, schema))


def buckets(sets: DataFrame, frequent: np.ndarray) -> DataFrame:
    """token, k (hash of a set's key) and n (members) of shingles that several sets have in their prefixes, each set of members once.

    A shingle that isn't frequent is in few rows, so those of one come together in a task; frequent ones are dealt out by both columns.
    """
    often = sets.sparkSession.createDataFrame([(int(t),) for t in frequent.view(np.int64)], "token long")
    rows = sets.select(F.explode("prefix").alias("token"), "k").join(F.broadcast(often.withColumn("often", F.lit(True))), "token", "left")
    by = Window.partitionBy("token")
    several = rows.where("often is null").withColumn("low", F.min("k").over(by)).withColumn("high", F.max("k").over(by)).where("low < high").select("token", "k").distinct()
    members = written(several.union(rows.where("often").select("token", "k").distinct()))
    same = members.groupBy("token").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), F.bit_xor("k").alias("one"), F.bit_xor(F.xxhash64("k")).alias("two"))
    kept = same.where("n > 1").groupBy("n", "low", "high", "one", "two").agg(F.min("token").alias("token")).select("token", "n")
    return members.join(kept, "token")


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """set_id, size and tokens (binary) of the wanted (set_id, text_key), written."""
    # one row of each text, so that copies are merged before they are dealt
    texts = docs.select(text_key().alias("text_key"), F.col("text").cast("binary").alias("text")).dropDuplicates(["text_key"])
    found = wanted.select("set_id", "text_key").join(texts, "text_key").select("set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("set_id", pa.int64()), ("size", pa.int64()), ("tokens", pa.binary())])
        for batch in batches:
            sets = ((i, shingle_set(text.as_py(), words)) for i, text in zip(batch.column(0).to_pylist(), batch.column(1)))
            yield from arrow_rows(schema, ((i, len(tokens), tokens.tobytes()) for i, tokens in sets))

    return written(found.mapInArrow(run, "set_id long, size long, tokens binary"))


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _signatures(*columns: list) -> list[Signature]:
    return [Signature(*row[:-1], _tokens(row[-1])) for row in zip(*columns)]


SIGNATURE = "size long, length long, width long, end long, map binary"


def in_blocks(rows: DataFrame, by: str, parts: Column) -> DataFrame:
    """rows with first and second: the pairs of blocks of their group (a long) that each row is in; parts says how many blocks that has."""
    dealt = rows.withColumn("_parts", parts.cast("int")).withColumn("_part", F.pmod(F.xxhash64("set_id"), "_parts").cast("int"))
    other = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return other.withColumns({"first": F.least("_part", "_other"), "second": F.greatest("_part", "_other")}).drop("_parts", "_part", "_other").repartition(by, "first", "second").sortWithinPartitions(by, "first", "second")


def connected(members: DataFrame, fronts: DataFrame, share: int) -> DataFrame:
    """Edges (a, b) that connect the sets as the pairs that may link do, from members (token, n, set_id) of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for _, _, _, ids, *columns in in_groups(batches, 3):
                for i, root in enumerate(may_connect(_signatures(*columns), share).tolist() if len(ids) > 1 else []):
                    if i != root:
                        yield ids[root], ids[i]

        return arrow_rows(PAIRS, found())

    rows = members.join(fronts, "set_id").select("token", "n", "set_id", "size", "length", "width", "end", "map")
    dealt = in_blocks(rows, "token", F.ceil(F.col("n") / BLOCK))
    return dealt.select("token", "first", "second", "set_id", "size", "length", "width", "end", "map").mapInArrow(run, "a long, b long").distinct()


def links_within(clusters: DataFrame, docs: DataFrame, sets: DataFrame, words: int, share: int) -> DataFrame:
    """Links (a, b) that connect the sets of each cluster (set_id, cluster) as all their links do."""
    held = whole_sets(docs, clusters.join(sets, "set_id"), words)
    sizes = clusters.join(held.select("set_id", "size"), "set_id").groupBy("cluster").agg(F.sum("size").alias("whole"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for _, _, _, ids, tokens in in_groups(batches, 3):
                if len(ids) > 1:
                    yield from ((ids[i], ids[j]) for i, j in links([_tokens(t) for t in tokens], share))

        return arrow_rows(PAIRS, found())

    rows = clusters.join(sizes, "cluster").join(held, "set_id").select("cluster", "set_id", "tokens", "whole")
    dealt = in_blocks(rows, "cluster", F.ceil(F.col("whole") / WHOLE))
    return dealt.select("cluster", "first", "second", "set_id", "tokens").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, sets: DataFrame, words: int, share: int) -> DataFrame:
    """The pairs (a, b) of set_ids whose whole sets link, written."""
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct().join(sets, "set_id")
    held = whole_sets(docs, wanted, words)
    left, right = held.select(F.col("set_id").alias("a"), F.col("tokens").alias("one")), held.select(F.col("set_id").alias("b"), F.col("tokens").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(_tokens(x.as_py()), _tokens(y.as_py()), share) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return written(pairs.join(left, "a").join(right, "b").select("a", "b", "one", "other").mapInArrow(run, "a long, b long"))


def classes(docs: DataFrame, keep: list[str], words: int = WORDS, share: int = SHARE, known: DataFrame | None = None) -> Classes:
    """The classes of docs by links; known may give pairs (a, b) of text_key, which are compared too."""
    if not 70 <= share <= 100:
        raise ValueError("share is a per cent from 70")
    small_batches(docs.sparkSession)
    often = frequent_shingles(docs, words)
    rows = prepared(docs, keep, words, share, often)
    k = F.xxhash64("set_key").alias("k")
    by_set = rows.where("set_key is not null").groupBy("set_key")
    near = written(buckets(by_set.agg(F.first("prefix").alias("prefix")).select(k, "prefix"), often[0]))
    sets = written(by_set.agg(F.min("uid").alias("set_id"), F.min("text_key").alias("text_key")))
    members = written(near.join(sets.select(k, "set_id"), "k").select("token", "n", "set_id"))
    fronts = rows.select(F.col("uid").alias("set_id"), F.col("n_shingles").alias("size"), "rare", "prefix").join(members.select("set_id").distinct(), "set_id")
    fronts = written(fronts.mapInArrow(_signed, f"set_id long, {SIGNATURE}"))
    clusters = written(components(connected(members, fronts, share)).toDF("set_id", "cluster"))
    found = written(links_within(clusters, docs, sets, words, share))
    if known is not None:
        of_text = rows.where("set_key is not null").select("text_key", "set_key").distinct().join(sets.select("set_key", "set_id"), "set_key").select("text_key", "set_id")
        known = known.join(of_text.toDF("a", "x"), "a").join(of_text.toDF("b", "y"), "b").where("x <> y")
        known = written(known.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        found = found.union(confirmed(known, docs, sets, words, share))
    groups = components(found).toDF("set_id", "class_id")
    found = sets.join(groups, "set_id", "left").select("set_key", "set_id", F.coalesce("class_id", "set_id").alias("class_id"))
    return Classes(rows.select(*keep, "text_key", "n_shingles", "set_key"), written(found))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, rare = (c.to_pylist() for c in batch.columns[:3])
        found = [signature(n, np.asarray(x.values).view(np.uint64), r) for n, r, x in zip(sizes, rare, batch.column(3))]
        columns = [*(pa.array([getattr(f, c) for f in found], pa.int64()) for c in ("size", "length", "width", "end")), pa.array([f.map.tobytes() for f in found], pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], names=["set_id", "size", "length", "width", "end", "map"])


def near_duplicates(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles and component_id (the class's smallest doc_id; of empty sets the own) of every document."""
    rows, sets = classes(docs, ["doc_id"], words, share)
    low = rows.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("low"))
    of_class = sets.join(low, "set_key").groupBy("class_id").agg(F.min("low").alias("component_id"))
    of_set = sets.join(of_class, "class_id").select("set_key", "component_id")
    found = rows.join(of_set, "set_key", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
