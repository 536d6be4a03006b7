"""SentencePiece encoding and decoding with a table of distinct chunks.

The library turns each space into a marker and puts one marker before the text.
If no piece has a marker after another character, no piece crosses from a
character into a marker, so the text falls into chunks (markers and what follows
them up to the next marker) that are segmented apart.  Each distinct chunk of a
batch is segmented once; ids and decoded text are joined back by position.  A
model whose pieces do cross, or whose normalizer isn't the identity on a text,
is left to the library.

Defined results: null text counts as empty; an empty text has the end id only
and decodes to an empty text; repeated rows give equal results; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, small_batches

MARK = "▁"
#: Distinct chunks that a worker keeps before it starts anew: a bound on memory.
CHUNKS = 200_000
CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


class ChunkTable:
    """Ids and decoded text of each distinct chunk, with the library's results."""

    def __init__(self, model: str, chunks: int = CHUNKS):
        import re

        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self._crosses = any(MARK in p.lstrip(MARK) for p in pieces)
        self._split = re.compile(f"{MARK}+[^{MARK}]*").findall
        self._mark = self.library.piece_to_id(MARK)
        self._ids: dict[str, np.ndarray] = {}
        self._limit = chunks

    def _add(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self._ids and c != MARK]
        # the library puts one marker back before each
        for chunk, ids in zip(new, self.library.encode([c[1:] for c in new], num_threads=1)):
            self._ids[chunk] = np.array(ids, np.int32)
        self._ids[MARK] = np.array([self._mark], np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without the end id."""
        if len(self._ids) > self._limit:
            self._ids.clear()
        split: list[list[str] | None] = []
        for text in texts:
            marked = (MARK + text.replace(" ", MARK)) if text else ""
            known = not self._crosses and self.library.normalize(text) == marked
            split.append(self._split(marked) if known else None)
        self._add({c for s in split if s for c in s})
        none = np.zeros(0, np.int32)
        return [np.array(self.library.encode(t, num_threads=1), np.int32) if s is None else np.concatenate([none, *map(self._ids.__getitem__, s)]) for t, s in zip(texts, split)]


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (an end id last) and decoded (the library's decode of the ids) of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        end = table.library.eos_id()

        def rows():
            for batch in batches:
                texts = [x or "" for x in batch.column(1).to_pylist()]
                for doc_id, ids in zip(batch.column(0).to_pylist(), table.encode(texts)):
                    all_ids = [*ids.tolist(), end]
                    yield doc_id, all_ids, table.library.decode(all_ids)

        yield from arrow_rows(CODED, rows(), block=256)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
