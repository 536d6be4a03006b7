"""Interleaved sequences of text and media references, and a media column resolved by digest.

``interleave`` parses HTML into an ordered list of structs, each a text or a
reference to media with its caption.  ``store`` writes payloads in a media
format, one row for each, and ``read`` gets them back from what was stored.
``resolve`` joins references to stored media by digest; positions and captions
stay with their references, and copies of a payload are one row of the media
side.

The format is a binary grey map (PGM): 8-bit samples, 64 to a row, after a short
header.  A payload is padded with bytes 0 up to a positive multiple of 64.

Defined results: null html or text counts as empty; a page without content has
an empty list; a reference that no payload has keeps its position with null
media columns; repeated rows repeat in the result, each resolved once; a null
digest resolves to nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, small_batches, written

WIDTH = 64
SCHEME = "sha256:"
_BREAKS = frozenset("address article aside blockquote body br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_MEDIA = frozenset("img audio video source embed".split())
_HIDDEN = frozenset("script style template noscript head title".split())
_IN_HEAD = frozenset("base link meta title style script noscript template".split())


class _Sequence(HTMLParser):
    """Texts and media references of a page in order; a figure's caption goes to the references in the figure.

    A caption before or after the references counts; a figcaption outside any figure is text.  A head
    without an end tag ends where the body's content begins.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self._text: list[str] = []
        self._hidden: list[str] = []
        self._figures: list[dict] = []  # open figures, the innermost last: their first item and caption
        self._caption: list[str] | None = None
        self._captioned: set[int] = set()  # items that have their figure's caption

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "digest": None, "caption": None})
        self._text = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._hidden and self._hidden[-1] == "head" and tag not in _IN_HEAD:
            self._hidden.pop()
        if tag in _HIDDEN:
            self._hidden.append(tag)
        if self._hidden:
            return
        if tag in _BREAKS:
            self._flush()
        if tag == "figure":
            self._end_caption()
            self._figures.append({"first": len(self.items), "caption": None})
        elif tag == "figcaption" and self._figures:
            self._flush()
            self._caption = []
        elif tag in _MEDIA:
            of = dict(attrs)
            source = of.get("src") or ""
            self._flush()
            digest = source[len(SCHEME) :] if source.startswith(SCHEME) else None
            self.items.append({"position": len(self.items), "kind": "media", "text": None if digest else source, "digest": digest, "caption": of.get("alt")})

    def handle_endtag(self, tag: str) -> None:
        if tag in self._hidden:
            while self._hidden.pop() != tag:
                pass
            return
        if self._hidden:
            return
        if tag == "figcaption":
            self._end_caption()
        if tag in _BREAKS:
            self._flush()
        if tag == "figure" and self._figures:
            self._end_figure()

    def _end_caption(self) -> None:
        if self._caption is not None:
            self._figures[-1]["caption"], self._caption = " ".join("".join(self._caption).split()), None

    def _end_figure(self) -> None:
        """Give a figure's caption to its references, but for those of a figure inside that has its own."""
        self._end_caption()
        figure = self._figures.pop()
        if figure["caption"] is not None:
            for item in self.items[figure["first"] :]:
                if item["kind"] == "media" and id(item) not in self._captioned:
                    item["caption"] = figure["caption"]
                    self._captioned.add(id(item))

    def handle_data(self, data: str) -> None:
        if self._hidden:
            return
        (self._text if self._caption is None else self._caption).append(data)

    def close(self) -> None:
        super().close()
        while self._figures:
            self._end_figure()
        self._flush()


def sequence(html: str | None) -> list[dict]:
    """position, kind (text or media), text, digest and caption of each item of a page."""
    parser = _Sequence()
    parser.feed(html or "")
    parser.close()
    return parser.items


ITEM = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())])
ITEM_SQL = "struct<position:int,kind:string,text:string,digest:string,caption:string>"


def interleave(pages: DataFrame) -> DataFrame:
    """page_id and items, the ordered texts and media references of every page (columns page_id and html)."""
    small_batches(pages.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("items", pa.list_(ITEM))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(sequence, batch.column(1).to_pylist()), pa.list_(ITEM))], schema=schema)

    return pages.select("page_id", "html").mapInArrow(run, f"page_id long, items array<{ITEM_SQL}>")


def encode_pgm(data: bytes) -> bytes:
    """A payload, padded to whole rows, as a grey map."""
    rows = max(1, -(-len(data) // WIDTH))
    return b"P5\n%d %d\n255\n" % (WIDTH, rows) + data.ljust(rows * WIDTH, b"\0")


def decode_pgm(media: bytes) -> np.ndarray:
    """Samples of a grey map, by rows."""
    kind, size, depth, samples = media.split(b"\n", 3)
    width, rows = map(int, size.split())
    if kind != b"P5" or depth != b"255" or len(samples) != width * rows:
        raise ValueError("not a whole 8-bit grey map")
    return np.frombuffer(samples, np.uint8).reshape(rows, width)


def store(payloads: DataFrame) -> DataFrame:
    """digest, n_bytes and media of payloads (columns digest and data), written in the media format and read back.

    Payloads aren't shuffled to find copies; ``features`` leaves one row of each digest.
    """
    small_batches(payloads.sparkSession)
    schema = pa.schema([("digest", pa.string()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for digest, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield digest, len(data or b""), encode_pgm(data or b"")

        yield from arrow_rows(schema, rows())

    return written(payloads.select("digest", "data").mapInArrow(run, "digest string, n_bytes long, media binary"))


FEATURES = pa.schema([("digest", pa.string()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
FEATURES_SQL = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(samples: np.ndarray) -> str:
    """Rows, mean, deviation, and share of samples by the high two bits, of a grey map."""
    counts = np.bincount(samples.ravel(), minlength=256).astype(np.float64)
    n, values = counts.sum(), np.arange(256)
    mean = counts @ values / n
    deviation = np.sqrt(max(0.0, counts @ (values - mean) ** 2 / n))
    shares = ",".join(f"{x:.4f}" for x in counts.reshape(4, 64).sum(1) / n)
    return f"rows={samples.shape[0]};mean={mean:.4f};dev={deviation:.4f};shares={shares}"


def features(stored: DataFrame) -> DataFrame:
    """Features of stored media, one row for each digest."""
    small_batches(stored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for digest, n_bytes, media in zip(*(c.to_pylist() for c in batch.columns)):
                    samples = decode_pgm(media)
                    payload = samples.tobytes()
                    yield digest, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)

        yield from arrow_rows(FEATURES, rows())

    found = stored.select("digest", "n_bytes", "media").mapInArrow(run, FEATURES_SQL)
    return found.groupBy("digest").agg(*(F.first(c).alias(c) for c in found.columns[1:]))


def resolve(sequences: DataFrame, media: DataFrame) -> DataFrame:
    """A row for each media reference of sequences: page_id, position, caption, digest and the media's columns."""
    refs = sequences.select("page_id", F.explode("items").alias("item")).where("item.kind = 'media'")
    refs = refs.select("page_id", "item.position", "item.caption", "item.digest")
    return refs.join(media, "digest", "left")


def document_media(docs: DataFrame) -> DataFrame:
    """Features of every document's text as media, by way of a page that refers to it."""
    text = F.coalesce("text", F.lit(""))
    data = docs.select("doc_id", F.sha2(text, 256).alias("digest"), text.cast("binary").alias("data"))
    html = F.concat(F.lit("<article><p>Document</p><figure><img src='" + SCHEME), "digest", F.lit("'><figcaption>text of the document</figcaption></figure></article>"))
    pages = data.select(F.col("doc_id").alias("page_id"), html.alias("html"))
    found = resolve(interleave(pages), features(store(data)))
    return found.select(F.col("page_id").alias("doc_id"), *(c for c in found.columns if c not in ("page_id", "position", "caption", "digest")))
