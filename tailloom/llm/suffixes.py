"""Removal of byte strings that occur earlier in the corpus, by a distributed sparse suffix sort.

Every byte covered by a ``length``-byte string that also starts earlier (in a
smaller document, or earlier in the same one) is removed.

A full suffix array of a large corpus doesn't fit its cluster's disks, so the
suffixes sorted are sampled by content.  In each window of ``length`` bytes the
``GRAM``-byte gram with the smallest hash is the window's anchor; equal windows
have equal anchors at equal offsets.  Neighbouring windows with a common anchor
are one record: (gram, two hashes of its whole span, document, position).

Strings count as equal if two hashes of 64 bits each, made by different rules (a tree of
mixes and a polynomial), are equal; carrying the bytes instead would take over 5 x the
input.  Two different strings of 10^13 agree in both with a probability of about 10^-12.

1. Records are dealt by gram and sorted by (gram, span, document, position) with
   a multikey sort.  All but the first of a span's records are repeats in whole;
   first records of a gram with several spans go on, since parts may be equal.
2. For those the windows themselves are the suffixes: sampled splitters
   (``repartitionByRange``) range-partition them by their leading token (the
   gram, for the spans of grams with few spans, which travel whole; the leading
   bytes and a hash of the rest, for single windows of the others), buckets sort
   locally by multikey sort, and equal neighbours are repeats.  Equal keys share
   a bucket, so runs never cross a boundary.
3. Repeated stretches are joined to their documents and merged.

Each task first combines its own records: repeats of a span, or of a window,
leave it at most once, and a gram's spans at most twice, the rest going straight
to step 2.  So a passage that a third of all documents share never gathers in
one task.

Defined results: null text counts as empty; texts shorter than ``length`` are
kept; a null doc_id comes before all others; rows that repeat a document wholly
count as one document, and each gets its result; documents that share a doc_id
but not a text are ordered by the texts' hash; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, field_sql, shuffle_width, small_batches, unused, written

LENGTH, GRAM = 100, 32
#: Window starts handled at once: bounds memory for very long texts, and positions fit 20 bits.
CHUNK = 1 << 19
#: Spans of a gram up to which they are compared as they are; those of others go window by window.
GROUP = 64
#: Records that a task combines at once, and rows of a bucket, about.
COMBINE, BUCKET = 1 << 18, 1 << 17
#: Bytes of short texts or spans that are hashed as one, about; at most CHUNK.
BLOCK = 1 << 16
_LOW = np.int64(-(2**63))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD1B54A32D192ED03))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _hashes(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams and of all windows of a text, by doubling."""
    h, size, found = _mix(data.astype(np.uint64), np.uint64(1)), 1, {}
    grown = {gram, 1 << (length.bit_length() - 1)}
    while True:
        if size in grown:
            found[size] = h
        if 2 * size > length:
            break
        h = _mix(h[: len(h) - size], h[size:])
        size *= 2
    whole = found[size]
    return found[gram], _mix(whole[: len(data) - length + 1], whole[length - size :])


#: An odd multiplier of the polynomial hash, and its inverse modulo 2^64.
_ROOT = 0x9E3779B97F4A7C15


def _powers_of(root: int, n: int) -> np.ndarray:
    """The first n powers modulo 2^64."""
    factors = np.full(n, root, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


_INVERSE = pow(_ROOT, -1, 2**64)
_POWERS, _INVERSES = (_powers_of(x, CHUNK + LENGTH) for x in (_ROOT, _INVERSE))


def _polynomials(data: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """A second hash, of size bytes from each start: sums of bytes by powers of an odd number, modulo 2^64."""
    longer = len(data) > len(_POWERS)
    powers, inverses = (_powers_of(_ROOT, len(data)), _powers_of(_INVERSE, len(data))) if longer else (_POWERS, _INVERSES)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return (sums[start + size] - sums[start]) * inverses[start]


class Records:
    """Columns of records or windows, sortable as a whole."""

    def __init__(self, **columns: np.ndarray):
        self.columns = columns

    def __getattr__(self, name: str) -> np.ndarray:
        try:
            return self.columns[name]
        except KeyError:
            raise AttributeError(name) from None

    def __len__(self) -> int:
        return len(next(iter(self.columns.values())))

    def take(self, at: np.ndarray) -> Records:
        return Records(**{k: v[at] for k, v in self.columns.items()})

    @staticmethod
    def join(parts: list[Records]) -> Records:
        return Records(**{k: np.concatenate([p.columns[k] for p in parts]) for k in parts[0].columns})


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order by the first key, equal stretches by the second, and so on: only ties meet a later key."""
    order = np.argsort(keys[0], kind="stable")
    run = np.zeros(len(order), np.int64)
    sorted_key = keys[0][order]
    run[1:] = np.cumsum(sorted_key[1:] != sorted_key[:-1])
    for key in keys[1:]:
        tied = np.flatnonzero(np.bincount(run, minlength=1)[run] > 1) if len(run) else run
        if not len(tied):
            break
        part = order[tied]
        part = part[np.lexsort((key[part], run[tied]))]
        order[tied] = part
        new = np.ones(len(order), bool)
        new[1:] = run[1:] != run[:-1]
        now = key[order]
        new[1:] |= now[1:] != now[:-1]
        run = np.cumsum(new) - 1
    return order


def _firsts(r: Records, *names: str) -> tuple[Records, np.ndarray, np.ndarray]:
    """r sorted by names and then by document and position; where a new run of names begins; which rows repeat an earlier one."""
    order = multikey_order(*(r.columns[n] for n in (*names, "doc", "tie", "pos")))
    r = r.take(order)
    new = np.ones(len(r), bool)
    if len(r):
        new[1:] = np.logical_or.reduce([r.columns[n][1:] != r.columns[n][:-1] for n in names])
    first = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    same_place = (r.doc == r.doc[first]) & (r.tie == r.tie[first]) & (r.pos == r.pos[first])
    return r, new, ~same_place


def _spans(part: np.ndarray, length: int, gram: int, valid: np.ndarray | None = None) -> Records:
    """Records of the windows of part, or of those that start at the valid places: gram, span and more, pos, n."""
    width = length - gram + 1
    grams, windows = _hashes(part, length, gram)
    key = (grams & ~np.uint64(0xFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        key = np.minimum(key[: len(key) - size], key[size:])
        size *= 2
    if size < width:
        key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
    anchor = (key & np.uint64(0xFFFFF)).astype(np.int64)
    at = np.arange(len(anchor)) if valid is None else valid
    anchor = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n, start, anchor = np.diff(np.append(first, len(anchor))), at[first], anchor[first]
    span = _mix(_mix(windows[start], windows[start + n - 1]), ((anchor - start) * 1024 + n).astype(np.uint64))
    return Records(gram=grams[anchor], span=span, more=_polynomials(part, start, n + length - 1), pos=start, n=n.astype(np.int64))


def windows_by_anchor(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[Records]:
    """Records of a text: gram, span and more (hashes), pos (first window), n (windows)."""
    data = np.frombuffer(text, np.uint8)
    for begin in range(0, len(data) - length + 1, CHUNK):
        r = _spans(data[begin : begin + CHUNK + length - 1], length, gram)
        r.columns["pos"] = r.pos + begin
        yield r


def windows_of_texts(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[Records]:
    """windows_by_anchor of each text, with the text's place in the list (of).

    Texts up to BLOCK are hashed many as one: a window's hashes and anchor come from its own bytes only, and windows that
    cross from one text into the next are left out.
    """
    held, total = [], 0

    def flush() -> Iterator[Records]:
        if held:
            size = np.array([len(texts[i]) for i in held])
            first = np.cumsum(size) - size
            n = size - length + 1
            of = np.repeat(np.arange(len(held)), n)
            valid = first[of] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            r = _spans(np.frombuffer(b"".join(texts[i] for i in held), np.uint8), length, gram, valid)
            which = np.searchsorted(first, r.pos, side="right") - 1
            r.columns |= {"pos": r.pos - first[which], "of": np.array(held)[which]}
            yield r

    for i, text in enumerate(texts):
        if len(text) > BLOCK:
            for r in windows_by_anchor(text, length, gram):
                yield Records(**r.columns, of=np.full(len(r), i))
        elif len(text) >= length:
            if total + len(text) > BLOCK:
                yield from flush()
                held, total = [], 0
            held.append(i)
            total += len(text)
    yield from flush()


RECORD = "kind int, gram long, span long, more long, doc long, tie long, pos long, n long"
#: What a row is: a stretch of repeats; windows to compare with few or with many other records; a
#: record to compare, of a gram that has more spans in its task or not.
REPEAT, FEW, MANY, OPEN, OPEN_MANY = range(5)
_RECORD = pa.schema([("kind", pa.int32()), ("gram", pa.int64()), ("span", pa.int64()), ("more", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())])


def _batch(schema: pa.Schema, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)


def _record_batch(kind: np.ndarray | int, r: Records) -> pa.RecordBatch:
    kinds = np.broadcast_to(np.int32(kind), len(r)).astype(np.int32)
    return _batch(_RECORD, kinds, r.gram.view(np.int64), r.span.view(np.int64), r.more.view(np.int64), r.doc, r.tie, r.pos, r.n)


def _combine(r: Records, last: bool) -> Iterator[pa.RecordBatch]:
    """What is known of a task's records; last: all records of their grams are here, but for those already told apart."""
    r, new, repeat = _firsts(r, "gram", "span", "more")
    yield _record_batch(REPEAT, r.take(repeat))
    r = r.take(new)
    if not len(r):
        return
    start = np.concatenate([[True], r.gram[1:] != r.gram[:-1]])
    group = np.cumsum(start) - 1
    size = np.bincount(group)[group]
    if last:
        many = (np.bincount(group, weights=r.many)[group] > 0) | (size > GROUP)
        shared = many | (size > 1)
        yield _record_batch(np.where(many, MANY, FEW)[shared], r.take(shared))
        return
    place = np.arange(len(r)) - np.flatnonzero(start)[group]
    yield _record_batch(np.where(place > 1, MANY, np.where(size > 2, OPEN_MANY, OPEN)), r)


def _ranked(docs: DataFrame) -> DataFrame:
    """doc (never null), tie and text (never null)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(int(_LOW))).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _records(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Step 1 in a task: records of its texts, combined."""
    held, count = [], 0
    for batch in batches:
        doc, tie = (batch.column(i).to_numpy() for i in (0, 1))
        for r in windows_of_texts([t.encode() for t in batch.column(2).to_pylist()], length, gram):
            of = r.columns.pop("of")
            r.columns |= {"doc": doc[of], "tie": tie[of]}
            held.append(r)
            count += len(r)
            if count >= COMBINE:
                yield from _combine(Records.join(held), last=False)
                held, count = [], 0
    if held:
        yield from _combine(Records.join(held), last=False)


def _compare_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 in a bucket, which has all open records of its grams."""
    held = []
    for batch in batches:
        kind = batch.column(0).to_numpy()
        yield batch.filter(pa.array(kind < OPEN))
        r = Records(**{n: c.to_numpy() for n, c in zip(_RECORD.names[1:], batch.columns[1:])}, many=kind == OPEN_MANY)
        held.append(r.take(kind >= OPEN))
    if held:
        yield from _combine(Records.join(held), last=True)


SUFFIX = "lead long, rest long, more long, doc long, tie long, pos long, n long, span binary"
_SUFFIX = pa.schema([("lead", pa.int64()), ("rest", pa.int64()), ("more", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("span", pa.binary())])
_STRETCH = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())])


def _windows(data: np.ndarray, pos: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading eight bytes, and two hashes, of the windows that start at pos."""
    lead = np.zeros(len(pos), np.uint64)
    for i in range(8):
        lead = (lead << np.uint64(8)) | data[pos + i].astype(np.uint64)
    return lead, _hashes(data, length, GRAM)[1][pos], _polynomials(data, pos, length)


def _span_windows(spans: list[bytes], doc: np.ndarray, tie: np.ndarray, pos: np.ndarray, n: np.ndarray, length: int) -> Records:
    """All windows of spans of n windows: the spans are hashed as one text, and only windows within a span are taken."""
    size = n + length - 1
    first = np.cumsum(size) - size
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    lead, rest, more = _windows(np.frombuffer(b"".join(spans), np.uint8), np.repeat(first, n) + k, length)
    return Records(lead=lead, rest=rest, more=more, doc=np.repeat(doc, n), tie=np.repeat(tie, n), pos=np.repeat(pos, n) + k)


def _stretches(r: Records) -> tuple[np.ndarray, ...]:
    """doc, tie, pos and n of the runs of consecutive windows."""
    order = np.lexsort((r.pos, r.tie, r.doc))
    doc, tie, pos = r.doc[order], r.tie[order], r.pos[order]
    new = np.ones(len(pos), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (pos[1:] > pos[:-1] + 1)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(pos)) - 1
    return doc[start], tie[start], pos[start], (pos[end] - pos[start] + 1 if len(pos) else pos)


def _suffixes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Step 2 in a task: spans of records with few partners, single windows of those with many (combined).

    A row with n = 0 is a single window, one with n > 0 and no span is a stretch of repeats.
    """
    held, count, spans = [], 0, []
    raws, size, of = [], 0, []  # spans whose windows are not hashed yet

    def hash_spans() -> None:
        if raws:
            doc, tie, pos, n = (np.array(c, np.int64) for c in zip(*of))
            held.append(_span_windows(raws, doc, tie, pos, n, length))

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            r, new, repeat = _firsts(Records.join(held), "lead", "rest", "more")
            x = r.take(new)
            yield _batch(_SUFFIX, x.lead.view(np.int64) ^ _LOW, x.rest.view(np.int64), x.more.view(np.int64), x.doc, x.tie, x.pos, np.zeros(len(x), np.int64), pa.nulls(len(x), pa.binary()))
            doc, tie, pos, n = _stretches(r.take(repeat))
            yield _batch(_SUFFIX, doc, pos, pos, doc, tie, pos, n, pa.nulls(len(doc), pa.binary()))

    for batch in batches:
        opened = batch.column(3)
        ends = opened.value_lengths().fill_null(0).to_numpy().cumsum().tolist()
        fields = opened.flatten()
        kinds, grams, places, ns = (fields.field(c).to_pylist() for c in ("kind", "gram", "pos", "n"))
        begin = 0
        for doc, tie, text, end in zip(*(batch.column(i).to_pylist() for i in range(3)), ends):
            raw = text.encode()
            for i in range(begin, end):
                pos, n = places[i], ns[i]
                span = raw[pos : pos + n + length - 1]
                if kinds[i] == FEW:
                    spans.append((grams[i], 0, 0, doc, tie, pos, n, span))
                    continue
                raws.append(span)
                of.append((doc, tie, pos, n))
                size += len(span)
                count += n
            begin = end
            if size >= BLOCK:
                hash_spans()
                raws, size, of = [], 0, []
            if count >= COMBINE:
                hash_spans()
                raws, size, of = [], 0, []
                yield from flush()
                held, count = [], 0
            if len(spans) > 8192:
                yield from arrow_rows(_SUFFIX, spans)
                spans = []
    hash_spans()
    yield from flush()
    yield from arrow_rows(_SUFFIX, spans)


def _neighbours(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Step 2 in a bucket: sort its windows, and tell those that follow an equal one."""
    held = []
    for batch in batches:
        single = batch.column("n").to_numpy() == 0
        r = Records(**{n: batch.column(n).to_numpy() for n in ("lead", "rest", "more", "doc", "tie", "pos")}).take(single)
        held.append(Records(**r.columns | {"lead": (r.lead ^ _LOW).view(np.uint64), "rest": r.rest.view(np.uint64), "more": r.more.view(np.uint64)}))
        whole = batch.filter(pa.array(~single))
        if not whole.num_rows:
            continue
        held.append(_span_windows(whole.column("span").to_pylist(), *(whole.column(c).to_numpy() for c in ("doc", "tie", "pos", "n")), length))
    if held:
        r, _, repeat = _firsts(Records.join(held), "lead", "rest", "more")
        yield _batch(_STRETCH, *_stretches(r.take(repeat)))


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc, tie, pos, n: stretches of n starts of windows that also start earlier."""
    small_batches(docs.sparkSession)
    ranked, width = _ranked(docs), shuffle_width(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(width, 2 * total // (length - gram) // BUCKET)
    opened = ranked.select("doc", "tie", "text").mapInArrow(lambda b: _records(b, length, gram), RECORD)
    route = F.when(F.col("kind") >= OPEN, F.col("gram")).otherwise(F.xxhash64("doc", "pos"))  # closed rows only pass through
    known = written(opened.repartition(buckets, route).mapInArrow(_compare_records, RECORD))
    of_doc = known.where(f"kind > {REPEAT}").groupBy("doc", "tie").agg(F.collect_list(F.struct("kind", "gram", "pos", "n")).alias("open"))
    shared = of_doc.join(ranked, ["doc", "tie"]).select("doc", "tie", "text", "open")
    suffixes = written(shared.mapInArrow(lambda b: _suffixes(b, length), SUFFIX))
    to_sort = suffixes.where("n = 0 or span is not null")
    windows = to_sort.agg(F.sum(F.greatest("n", F.lit(1)))).first()[0] or 0
    sorted_ = to_sort.repartitionByRange(max(width, windows // BUCKET), "lead", "rest").mapInArrow(lambda b: _neighbours(b, length), "doc long, tie long, pos long, n long")
    whole = known.where(f"kind = {REPEAT}").select("doc", "tie", "pos", "n")
    return whole.union(suffixes.where("n > 0 and span is null").select("doc", "tie", "pos", "n")).union(sorted_)


def kept_bytes(data: bytes, stretches: list[dict], length: int = LENGTH) -> tuple[bytes, int]:
    """What is left of a text, and how many stretches were removed."""
    if not stretches:
        return data, 0
    depth = np.zeros(len(data) + 1, np.int64)
    starts = np.fromiter((s["pos"] for s in stretches), np.int64, len(stretches))
    ends = starts + np.fromiter((s["n"] for s in stretches), np.int64, len(stretches)) + length - 1
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    gone = np.cumsum(depth[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), runs


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every document."""
    found = repeated(docs, length).groupBy("doc", "tie").agg(F.collect_list(F.struct("pos", "n")).alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text, gone in _texts(batches):
                data = text.encode()
                kept, spans = kept_bytes(data, gone or [], length)
                yield doc_id, len(data), len(data) - len(kept), spans, kept

        yield from arrow_rows(KEPT, rows())

    joined = _ranked(docs).join(found, ["doc", "tie"], "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def strip_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with repeats removed from text; a character that a removed stretch cuts goes with it."""
    found = repeated(docs, length).groupBy("doc", "tie").agg(F.collect_list(F.struct("pos", "n")).alias("gone"))
    names, at = docs.columns, docs.columns.index("text")
    doc, tie, gone = unused(docs, "doc", "tie", "gone")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(at).to_pylist(), batch.column(-1).to_pylist())
            texts = [t and (kept_bytes(t.encode(), gone, length)[0].decode("utf-8", "ignore") if gone else t) for t, gone in pairs]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn(doc, F.coalesce("doc_id", F.lit(int(_LOW)))).withColumn(tie, F.xxhash64(text))
    return keyed.join(found.toDF(doc, tie, gone), [doc, tie], "left").select(*names, gone).mapInArrow(cut, field_sql(docs, *names))


def kept_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """As remove_repeats, with the SHA-256 of the remaining bytes in their place."""
    return remove_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
