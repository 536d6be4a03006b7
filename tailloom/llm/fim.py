"""Fill-in-middle transformation, with cuts located through content-defined chunks.

A text's UTF-8 bytes are cut where a rolling hash of the last ``WINDOW`` bytes
meets a pattern, so a passage gets the same chunks wherever it stands.  A chunk's
summary (code points that begin in it, two bytes of either end, whether it holds a
sentinel) is kept in a bounded cache of each task; a hash finds it and the chunk's
content, compared byte for byte, confirms it.  Summaries combine from left to
right: running counts say which chunk holds a cut, whose bytes alone are then
looked at, and the ends show sentinels across chunk borders.

A document is cut at two code points, drawn from a digest of its id, into prefix,
middle and suffix; they are put together as prefix-suffix-middle or
suffix-prefix-middle behind the sentinels.  ``restore`` rebuilds the text.

Defined results: null and empty texts, texts that hold a sentinel, and the rest by
the draw, stay plain; a null doc_id draws from the seed alone; repeated rows fare
alike; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
#: Bytes the rolling hash sees (a power of two), least and most bytes of a chunk, and the bits that make a cut: 512 bytes on average.
WINDOW, LEAST, MOST = 16, 64, 4096
CUT_BITS = np.uint32(0x1FF << 20)
#: Bytes of chunks that a task's cache holds.
CACHE_BYTES = 32 << 20
_GEAR = np.random.default_rng(5).integers(0, 2**32, 256, dtype=np.uint32)


class Summary(NamedTuple):
    points: int
    head: bytes
    tail: bytes
    marked: bool


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of data end; the last end is its length."""
    seen = _GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:  # hash of 2 * step bytes from those of step bytes
        seen[step:] += seen[:-step] << np.uint32(step)
        step *= 2
    found = (np.flatnonzero(seen & CUT_BITS == 0) + 1).tolist()
    ends, at = [], 0
    while at < len(data):
        i = bisect_left(found, at + LEAST)
        at = min(found[i] if i < len(found) else len(data), at + MOST, len(data))
        ends.append(at)
    return ends


def point_starts(data: bytes) -> np.ndarray:
    """Where code points begin: the bytes that don't continue one."""
    return np.frombuffer(data, np.uint8) & 0xC0 != 0x80


def holds_sentinel(data: bytes) -> bool:
    return any(x in data for x in SENTINELS)


class ChunkCache:
    """Summaries of chunks by content, up to a number of bytes; the oldest go first."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.bytes, self.held = limit, 0, {}

    def summary(self, chunk: bytes) -> Summary:
        from xxhash import xxh64_intdigest

        key = xxh64_intdigest(chunk)
        content, found = self.held.get(key, (None, None))
        if content == chunk:
            return found
        found = Summary(int(np.count_nonzero(point_starts(chunk))), chunk[:2], chunk[-2:], holds_sentinel(chunk))
        if content is None:  # of chunks that share a hash, the first stays
            self.held[key] = chunk, found
            self.bytes += len(chunk)
            while self.bytes > self.limit:
                self.bytes -= len(self.held.pop(next(iter(self.held)))[0])
        return found


class Chunked:
    """A text by its chunks' summaries: code points, sentinels, and byte places of code points."""

    def __init__(self, data: bytes, cache: ChunkCache):
        self.data, self.ends = data, chunk_ends(data)
        self.begins = [0, *self.ends[:-1]]
        found = [cache.summary(data[a:b]) for a, b in zip(self.begins, self.ends)]
        self.totals = list(accumulate(s.points for s in found))
        self.points = self.totals[-1] if found else 0
        self.marked, tail = False, b""
        for s in found:
            self.marked |= s.marked or holds_sentinel(tail + s.head)
            tail = (tail + s.tail)[-2:]

    def place(self, point: int) -> int:
        """The byte where that code point (from 0) begins; the length for the one after the last."""
        if point >= self.points:
            return len(self.data)
        i = bisect_right(self.totals, point)
        inside = point - (self.totals[i - 1] if i else 0)
        begin = self.begins[i]
        return begin + int(np.flatnonzero(point_starts(self.data[begin : self.ends[i]]))[inside])


def draw(doc_id: int | None, seed: str = "1") -> list[int]:
    """Four numbers of 32 bits from a digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id: int | None, data: bytes, cache: ChunkCache, moved: int = 90, suffix_first: int = 20) -> tuple:
    """(n, form, prefix code points, middle code points, output) of a text in UTF-8; the two per cents are of texts and of moved texts."""
    text, (a, b, c, d) = Chunked(data, cache), draw(doc_id)
    n = text.points
    if not data or text.marked or c % 100 >= moved:
        return n, "plain", None, None, data
    first, last = sorted((a % (n + 1), b % (n + 1)))
    x, y = text.place(first), text.place(last)
    prefix, middle, suffix = data[:x], data[x:y], data[y:]
    p, s, m = SENTINELS
    if d % 100 < suffix_first:
        return n, "spm", first, last - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, last - first, b"".join((p, prefix, s, suffix, m, middle))


def transform(docs: DataFrame, moved: int = 90, suffix_first: int = 20) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars and output of every document."""
    small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        rows = ((doc_id, *transformed(doc_id, data or b"", cache, moved, suffix_first)) for batch in batches for doc_id, data in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))))
        return arrow_rows(pa.schema(fields), rows)

    coded = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    found = coded.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return found.withColumn("output", F.col("output").cast("string"))


def restore(rows: DataFrame, output: str = "output", form: str = "form", to: str = "restored") -> DataFrame:
    """The rows with the text rebuilt from an output and its form: parts hold no sentinel, so splitting at them is exact."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm, spm = (F.concat(*(parts[i] for i in order)) for order in ((1, 3, 2), (2, 3, 1)))
    return rows.withColumn(to, F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output)))
