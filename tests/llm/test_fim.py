"""Fill-in-middle against plain slicing of Python strings."""

import random

import pytest

from tailloom.llm import fim


def naive(doc_id, text):
    text = text or ""
    a, b, c, d = fim.draw(doc_id)
    n = len(text)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    first, last = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = text[:first], text[first:last], text[last:]
    return (n, "spm", first, last - first, f"<S>{s}<P>{p}<M>{m}") if d % 100 < 20 else (n, "psm", first, last - first, f"<P>{p}<S>{s}<M>{m}")


def texts():
    rng = random.Random(2)
    passage = " ".join(f"shared{i}é" for i in range(400))
    words = ["alpha", "héllo", "日本語", "🙂", "<", "S", ">", "<P", "M>", " ", "x" * 70, passage]
    some = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(150)]
    return [None, "", "a", "🙂", "x" * 20000, "é" * 9000, " " * 5000, passage, passage + passage, "<P>", "a<M>b", "x" * 4094 + "<S>" + "y" * 99, "x" * 4095 + "<S>", *some]


def test_fim_equals_slicing(spark):
    rows = [(i if i % 7 else None, t, "c", 1) for i, t in enumerate(texts())]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(3)
    got = fim.restore(fim.transform(docs)).collect()
    want = [(d, *naive(d, t), t or "") for d, t, *_ in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.restore(fim.transform(docs.limit(0))).count() == 0


def test_chunks_follow_content():
    """A passage has the same chunks behind any text, but for those at its start; long runs of one byte are cut too."""
    rng = random.Random(4)
    passage = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(4000)).encode()

    def chunks(data):
        ends = fim.chunk_ends(data)
        return {data[a:b] for a, b in zip([0, *ends[:-1]], ends)}

    alone = chunks(passage)
    assert len(alone - chunks(b"other words before it " * 9 + passage)) <= 3
    for data in (b"", b"a", b"a" * 100_000, b" " * 63, passage):
        ends = fim.chunk_ends(data)
        assert (ends[-1] if ends else 0) == len(data) and all(0 < b - a <= fim.MOST for a, b in zip([0, *ends[:-1]], ends))


@pytest.mark.parametrize("limit", [0, 1000, 1 << 20])
def test_cache(monkeypatch, limit):
    """Results don't depend on the cache's size, nor on hashes that collide."""
    import xxhash

    for collide in (False, True):
        if collide:
            monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda data: len(data) % 3)
        cache = fim.ChunkCache(limit)
        for i, text in enumerate(texts()):
            n, form, first, middle, output = fim.transformed(i, (text or "").encode(), cache)
            assert (n, form, first, middle, output.decode()) == naive(i, text)
        assert cache.bytes <= limit and cache.bytes == sum(len(x) for x, _ in cache.held.values())


def test_invalid_bytes_and_places():
    """Code points are counted by their first bytes, over chunks that cut one in two as well."""
    data = ("日" * 5000).encode()
    text = fim.Chunked(data, fim.ChunkCache())
    assert text.points == 5000 and [text.place(i) for i in (0, 1, 1365, 1366, 4999, 5000)] == [0, 3, 4095, 4098, 14997, 15000]
