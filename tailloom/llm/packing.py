"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

``cut_pieces`` tokenises documents and cuts the long ones; ``pack`` assigns any
rows that have a length to sequences.  Since lengths are integers up to the
capacity, an instance of any size is its histogram.  ``plan_bins`` works on
that histogram: Martello and Toth's dominance criterion first fixes sets of
items that dominate every other set holding their largest item, for all equal
items at once; best-fit decreasing packs what is left.  The plan has a number
of patterns that depends on the capacity alone, so it may be broadcast; rows
find their place by their rank among the rows of their length.

Defined results: null text counts as empty; an empty document is one piece
holding the end id only; no rows give no rows; repeated rows are packed each;
a null doc_id is kept; columns of the input other than those named are dropped
by ``cut_pieces`` and kept by ``pack``, where columns sequence_id and offset of the
input give way to the result's.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, field_sql, shuffle_width, small_batches, unused, written

CAPACITY = 1024

Pattern = tuple[int, list[tuple[int, int]]]


class ByteBpe:
    """Byte-level BPE of a ``tokenizers`` file, run by tiktoken, which gives equal ids several times faster.

    Texts with a special token's string, or with so long a run of white space that the pattern
    may exhaust tiktoken's stack, are left to the ``tokenizers`` library.
    """

    LONG_RUN = re.compile(r"(?<!\s)\s{2048}")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self._added = [x["content"] for x in spec.get("added_tokens", [])]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self._added}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self._encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._library = Tokenizer.from_file(path)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not (any(x in text for x in self._added) or self.LONG_RUN.search(text)):
            try:
                return np.array(self._encode(text), "<u4").tobytes()
            except BaseException as error:  # a panic of its regular expressions is no Exception
                if type(error).__name__ != "PanicException":
                    raise
        return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece of every document.

    ``tokenizer`` is the path of a ``tokenizers`` file.  Only documents over the
    capacity are cut; their first piece takes what doesn't fill a whole one.
    """
    small_batches(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = ByteBpe(tokenizer), np.array([end_id], "<u4").tobytes()

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = bpe.encode(text or "") + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        yield doc_id, i, a, b - a, ids[4 * a : 4 * b]

        yield from arrow_rows(PIECES, rows())

    return docs.select("doc_id", "text").mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids binary")


def dominating_sets(count: np.ndarray, capacity: int) -> list[Pattern]:
    """Take out of count (items by length) the sets that Martello and Toth's criterion fixes.

    Only sets of up to three items are tried, as in their procedure.  All bins
    that hold equal sets are fixed in one step: taking items away keeps a set
    dominating as long as its own items last.
    """
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while count[j]:
                count[j] -= 1
                found = _dominating(count, j, capacity - j)
                count[j] += 1
                if found is None:
                    break
                need = defaultdict(int)
                for x in (j, *found):
                    need[x] += 1
                bins = int(min(count[x] // n for x, n in need.items()))
                for x, n in need.items():
                    count[x] -= n * bins
                fixed.append((bins, list(need.items())))
                changed = True
    return fixed


def _dominating(count: np.ndarray, j: int, room: int) -> list[int] | None:
    """What to put with j, all other items being in count; None if no set is known to dominate."""
    fits = np.flatnonzero(count[: room + 1])
    if not len(fits):
        return []
    smallest = [int(x) for x in fits[:3] for _ in range(min(3, int(count[x])))][:3]
    largest = int(fits[-1])
    if largest == room or len(smallest) < 2 or sum(smallest[:2]) > room:
        return [largest]
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    best, a, b = 0, 0, 0  # the fullest pair
    lo, hi = 0, len(fits) - 1
    while lo <= hi:
        s = int(fits[lo] + fits[hi])
        if s > room or lo == hi and count[fits[lo]] < 2:
            hi -= 1
            continue
        if s > best:
            best, a, b = s, int(fits[hi]), int(fits[lo])
        lo += 1
    if largest >= best:
        return [largest]
    between = [int(x) for x in fits if b < x <= a for _ in range(min(2, int(count[x]) - (x == a)))][:2]
    return [a, b] if largest == a and (len(between) < 2 or sum(between) > room) else None


def best_fit(count: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing of items counted by length, equal items and equal bins at once."""
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        n = int(count[length])
        for room in range(length, capacity):
            if not n:
                break
            bins, by_room[room] = by_room[room], []
            while bins and n:
                m, items = bins.pop()
                each = room // length
                full = min(m, n // each)
                if full:
                    by_room[room - each * length].append((full, [*items, (length, each)]))
                    n, m = n - full * each, m - full
                if m and n:
                    by_room[room - n * length].append((1, [*items, (length, n)]))
                    n, m = 0, m - 1
                if m:
                    bins.append((m, items))
            by_room[room] += bins
        each = capacity // length
        if n >= each:
            by_room[capacity - each * length].append((n // each, [(length, each)]))
        if n % each:
            by_room[capacity - n % each * length].append((1, [(length, n % each)]))
    return [x for bins in by_room.values() for x in bins]


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """(bins, [(length, items of it in each bin), ...]) for items counted by length."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        count[length] = n
    return dominating_sets(count, capacity) + best_fit(count, capacity)


def _places(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """The plan by length and first rank: items in a bin, number of the first bin, offset of the first item."""
    rows, filled, base = [], defaultdict(int), 0
    for bins, items in plan:
        offset = 0
        for length, each in items:
            rows.append((length, filled[length], each, base, offset))
            filled[length] += bins * each
            offset += length * each
        base += bins
    rows.sort()
    at = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "each", "bin", "offset"), at))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (with a column length from 1 to the capacity) with sequence_id and offset.

    Rows are numbered within their length in hashed parts, so that a length that
    most rows share is not one task; only the histogram, of at most as many rows
    as the capacity, reaches the driver.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    part, rank, first, n = unused(pieces, "part", "rank", "first", "n")
    parts = 4 * shuffle_width(spark)
    pieces = pieces.select(*names).withColumn(part, F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int"))
    by_part = pieces.groupBy("length", part).agg(F.count("*").alias(n))
    counts = {int(r[0]): int(r[1]) for r in by_part.groupBy("length").agg(F.sum(n)).collect()}
    places = spark.sparkContext.broadcast(_places(plan_bins(counts, capacity)))
    before = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_part.select("length", part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    within = Window.partitionBy("length", part).orderBy(*names)
    ranked = pieces.withColumn(rank, F.row_number().over(within) - 1).join(firsts, ["length", part])
    ranked = ranked.select(*names, F.col("length").cast("long").alias(n), (F.col(first) + F.col(rank)).cast("long").alias(rank))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, high = places.value, np.int64(1) << 40
        starts = at["length"] * high + at["rank"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (-2, -1))
            i = np.searchsorted(starts, length * high + rank, "right") - 1
            k = rank - at["rank"][i]
            new = [at["bin"][i] + k // at["each"][i], at["offset"][i] + k % at["each"][i] * length]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *map(pa.array, new)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{field_sql(pieces, *names)}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of docs.

    Tokenising is the costly part: its result, without the ids, is written once.
    """
    pieces = cut_pieces(docs, tokenizer, capacity, end_id)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(written(digests), capacity)
