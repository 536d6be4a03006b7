"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed-length windows,
each filter's largest response is kept, and a softmax layer gives languages.  The
network is trained in numpy on a bounded sample of labelled rows (``SAMPLE_DOCS``
documents, whose whole texts are cut into windows, and ``SAMPLE_WINDOWS`` of those
windows, both by hash); part of the windows are shortened in training, so that short
texts are learned too.  A text is cut into windows from end to end, and its windows'
probabilities are averaged by the number of bytes that belong to words.

Defined results: null text and text without letters are ``und`` with score 0;
without labelled texts every prediction is ``und``; rows with a null label are
predicted but not learned from; a null doc_id is predicted, never learned from;
repeated rows give equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import field_sql, small_batches

#: Bytes of a window, filter widths, filters of each width, embedding size.
WINDOW, WIDTHS, FILTERS, EMBED = 128, (2, 3, 4), 16, 8
#: Bounds of the training sample; steps of training at least and at most; share of windows that are shortened.
SAMPLE_DOCS, SAMPLE_WINDOWS, STEPS, SHORTENED = 3000, 16000, (400, 1000), 0.25
#: Windows in one matrix product.
BLOCK = 256
UNKNOWN = "und"


@dataclass
class Network:
    """Parameters; ``filters`` has the filters of all widths, those of small widths padded with zeros."""

    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows(text: str) -> np.ndarray:
    """A text's bytes in windows from end to end, the last one filled with zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    return np.pad(data, (0, -len(data) % WINDOW)).reshape(-1, WINDOW)


def _unfold(net: Network, block: np.ndarray) -> np.ndarray:
    width = max(WIDTHS)
    embedded = net.embed[np.pad(block, ((0, 0), (0, width - 1)))]
    return np.concatenate([embedded[:, i : i + WINDOW] for i in range(width)], axis=2)


def probabilities(net: Network, block: np.ndarray) -> np.ndarray:
    """Softmax over the languages for each window."""
    response = _unfold(net, block) @ net.filters
    pooled = np.maximum(response.max(1) + net.bias, 0)
    logits = pooled @ net.out + net.out_bias
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def shortened(rng: np.random.Generator, block: np.ndarray) -> np.ndarray:
    """Windows of which a share keep only a short run of their bytes."""
    block = block.copy()
    for i in np.flatnonzero(rng.random(len(block)) < SHORTENED):
        n = int((block[i] > 0).sum())
        size = int(rng.integers(6, 49))
        if size < n:
            begin = int(rng.integers(0, n - size + 1))
            run = block[i, begin : begin + size].copy()
            block[i] = 0
            block[i, :size] = run
    return block


def train(x: np.ndarray, labels: list[str], seed: int = 7) -> Network:
    """A network for labelled windows, by Adam on cross entropy; classes weigh equally."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    width, total = max(WIDTHS), FILTERS * len(WIDTHS)
    allowed = np.zeros((width * EMBED, total), np.float32)
    for k, w in enumerate(WIDTHS):
        allowed[: w * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    scale = np.float32(0.3)
    net = Network(languages, rng.normal(size=(256, EMBED)).astype(np.float32) * scale, rng.normal(size=allowed.shape).astype(np.float32) * scale * allowed, np.zeros(total, np.float32), rng.normal(size=(total, len(languages))).astype(np.float32) * scale, np.zeros(len(languages), np.float32))
    y = np.array([languages.index(a) for a in labels], np.int64)
    keep = np.arange(len(y))
    if not len(keep):
        return net
    share = np.bincount(y[keep], minlength=len(languages))
    chance = np.minimum(1, (x > 0).sum(1) / 32) / share[y]  # the short ends of texts count less
    params = [net.embed, net.filters, net.bias, net.out, net.out_bias]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = min(STEPS[1], max(STEPS[0], len(keep) // 16))
    for step in range(1, steps + 1):
        pick = rng.choice(keep, 64, p=chance / chance.sum())
        grads = _gradients(net, shortened(rng, x[pick]), y[pick], allowed)
        rate = 0.01 * (1 - step / (steps + 1))
        for p, g, m, v in zip(params, grads, mean, var):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _gradients(net: Network, block: np.ndarray, target: np.ndarray, allowed: np.ndarray) -> list[np.ndarray]:
    n, unfolded = len(block), _unfold(net, block)
    response = unfolded @ net.filters
    at = response.argmax(1)
    best = np.take_along_axis(response, at[:, None], 1)[:, 0] + net.bias
    pooled = np.maximum(best, 0)
    logits = pooled @ net.out + net.out_bias
    e = np.exp(logits - logits.max(1, keepdims=True))
    d_logits = e / e.sum(1, keepdims=True)
    d_logits[np.arange(n), target] -= 1
    d_logits /= n
    d_best = (d_logits @ net.out.T) * (best > 0)
    picked = unfolded[np.arange(n)[:, None], at]  # each filter's best position: windows x filters x inputs
    d_filters = np.einsum("nf,nfi->if", d_best, picked) * allowed
    d_inputs = (d_best[:, :, None] * net.filters.T[None]).reshape(n, at.shape[1], max(WIDTHS), EMBED)
    padded = np.pad(block, ((0, 0), (0, max(WIDTHS) - 1)))
    d_embed = np.zeros_like(net.embed)
    for i in range(max(WIDTHS)):
        np.add.at(d_embed, padded[np.arange(n)[:, None], at + i], d_inputs[:, :, i])
    return [d_embed, d_filters, d_best.sum(0), pooled.T @ d_logits, d_logits.sum(0)]


def fit(docs: DataFrame, learn: Column, docs_bound: int = SAMPLE_DOCS) -> Network:
    """A network from a hash sample of at most so many of the labelled documents that learn admits."""
    small_batches(docs.sparkSession)
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    order = F.xxhash64("doc_id")
    bound = labelled.select(order.alias("h")).orderBy("h").limit(docs_bound).agg(F.max("h")).first()[0]
    if bound is None:
        return train(np.zeros((0, WINDOW), np.uint8), [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang, h in zip(*(c.to_pylist() for c in batch.columns)):
                data = windows(text)
                data = data[((data >= 128) | (data | 32 >= 97) & (data | 32 <= 122)).any(1)]  # with a letter
                for begin in range(0, len(data), 4096):
                    part = [w.tobytes() for w in data[begin : begin + 4096]]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([lang] * n, pa.string()), pa.array([h] * n, pa.int64()), pa.array(range(begin, begin + n), pa.int64())], ["window", "lang", "h", "k"])

    cuts = labelled.where(order <= bound).select("text", "lang", order.alias("h")).mapInArrow(cut, "window binary, lang string, h long, k long")
    rows = cuts.orderBy(F.xxhash64("h", "k", "window"), "lang").limit(SAMPLE_WINDOWS).select("window", "lang").collect()
    x = np.frombuffer(b"".join(bytes(r["window"]) for r in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, [r["lang"] for r in rows])


PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict_texts(net: Network, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    known = [bool(t) and bool(net.languages) and any(map(str.isalpha, t)) for t in texts]
    total = np.zeros((len(texts), len(net.languages)))
    held, owner = [], []

    def flush():
        if held:
            block = np.concatenate(held)
            of = np.repeat(owner, [len(h) for h in held])
            for i in range(0, len(block), BLOCK):
                part = block[i : i + BLOCK]
                in_words = ((part >= 128) | (part | 32 >= 97) & (part | 32 <= 122)).sum(1)
                np.add.at(total, of[i : i + BLOCK], probabilities(net, part) * in_words[:, None])

    for k, text in enumerate(texts):
        if known[k]:
            held.append(windows(text))
            owner.append(k)
            if sum(map(len, held)) >= 4 * BLOCK:
                flush()
                held.clear()
                owner.clear()
    flush()
    weight = total.sum(1)
    best = total.argmax(1) if net.languages else None
    return [(net.languages[best[k]], float(min(1.0, total[k, best[k]] / weight[k]))) if known[k] and weight[k] else (UNKNOWN, 0.0) for k in range(len(texts))]


def predict(docs: DataFrame, net: Network, into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of docs with two more, named by into: the language and its score, from the text alone.

    Columns of docs that have these names give way.
    """
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in {x.lower() for x in into}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = predict_texts(net, batch.column(names.index("text")).to_pylist())
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*names, *into])

    return docs.select(*names).mapInArrow(run, f"{field_sql(docs, *names)}, `{into[0]}` string, `{into[1]}` double")


def held_out() -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from those not held out."""
    net = fit(docs, ~held_out())
    return predict(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
