"""Each operator against a brute-force version on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tailloom.llm import extraction, langid, licences, media, neighbours, packing, pieces, simhash, suffixes, warc

SCHEMA = "doc_id long, text string, length int, doc string"
PASSAGE = " ".join(f"shared{i}" for i in range(40))
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30000))
ROWS = [
    (1, None, 1, "x"), (2, "", 2, None), (3, "one two", 3, "x"), (4, "Alpha beta gamma delta epsilon zeta eta theta", 4, "x"),
    (5, "alpha Beta gamma delta epsilon zeta eta theta", 5, "x"), (6, "before it " + PASSAGE + " after it", 6, "x"), (7, PASSAGE, 7, "x"),
    (8, "é ñ ü " * 40 + PASSAGE, 8, "x"), (9, LONG, 9, "x"), (10, "a" * 400, 10, "x"), (11, PASSAGE, 11, "x"), (11, PASSAGE, 11, "x"), (None, "no id at all", 12, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, 64).collect()
    want = []
    for doc_id, text, *_ in ROWS:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        want += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize("text", [" " * 1_000_000, "x" + "\n" * 600_000 + "y", " " * 2047 + "x" + "\t" * 2049])
def test_long_white_space(text):
    bpe = packing.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == bpe._library.encode(text, add_special_tokens=False).ids


def test_pack_clashing_names(spark):
    rows = [(i, 1 + i % 7, i, "a", 0.5, "b", 9) for i in range(40)]
    pieces = spark.createDataFrame(rows, "doc_id int, length int, sequence_id int, part string, rank double, first string, n int").withColumn("offset", F.lit("x"))
    packed = packing.pack(pieces, 10)
    assert packed.columns == ["doc_id", "length", "part", "rank", "first", "n", "sequence_id", "offset"]
    got = packed.collect()
    assert sorted((r.doc_id, r.length, r.part, r.rank, r.first, r.n) for r in got) == sorted((d, n, p, k, f, m) for d, n, _, p, k, f, m in rows)
    assert len({r.sequence_id for r in got}) == -(-sum(r[1] for r in rows) // 10)
    assert len({(r.sequence_id, o) for r in got for o in range(r.offset, r.offset + r.length)}) == sum(r[1] for r in rows)


def test_special_token_text():
    bpe = packing.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a<|endoftext|>b", " x  y\n\n z\t", "it's 3½ ² é"):
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == bpe._library.encode(text, add_special_tokens=False).ids


def test_plans_hold_everything():
    rng = random.Random(3)
    for _ in range(200):
        cap, counts = rng.choice([7, 20, 64]), {}
        for _ in range(rng.randint(0, 50)):
            length = rng.randint(1, cap)
            counts[length] = counts.get(length, 0) + rng.choice([1, 1, 5])
        held: dict[int, int] = {}
        for bins, items in packing.plan_bins(counts, cap):
            assert sum(a * b for a, b in items) <= cap
            for a, b in items:
                held[a] = held.get(a, 0) + bins * b
        assert held == counts


def naive_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split() if (text or "").isascii() else (text or "").split()
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(docs, empty):
    got = {(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [(d, naive_fingerprint(t)) for d, t, *_ in ROWS]
    group = list(range(len(ROWS)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints):
            if (a ^ b).bit_count() <= 3:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {g: min((d for (d, _), x in zip(prints, group) if x == g and d is not None), default=None) for g in group}
    assert got == {(d, f, low[g]) for (d, f), g in zip(prints, group)}
    assert simhash.near_duplicates(empty).count() == 0


def test_gray_links_find_all_groups(spark):
    rng = np.random.default_rng(1)
    codes = set()
    for base in rng.integers(0, 2**63, 60).tolist():
        for _ in range(12):
            code = base
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                code ^= 1 << bit
            codes.add(code)
    codes = sorted(codes)
    links = simhash.links(spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "fp long"))
    found = {r.node: r.component for r in simhash.components(links).collect()}
    forest = simhash.Forest(len(codes))
    a, b = np.nonzero(np.bitwise_count(np.array(codes, np.uint64)[:, None] ^ np.array(codes, np.uint64)[None]) <= 3)
    forest.link(a, b)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    mine = {}
    for c, root in zip(signed, forest.roots().tolist()):
        mine.setdefault(root, set()).add(c)
    theirs = {}
    for c in signed:
        theirs.setdefault(found.get(c, c), set()).add(c)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def naive_repeats(rows, length):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[doc_id, len(data)] = (len(data) - len(kept), len([x for x in bytes(gone).split(b"\0") if x]), kept)
    return out


def test_suffixes(docs, empty):
    want = naive_repeats([(d, t) for d, t, *_ in ROWS], 100)
    rows = suffixes.remove_repeats(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id, r.n_bytes]
    assert suffixes.remove_repeats(empty).count() == 0


def test_suffixes_with_colliding_hashes(monkeypatch):
    """One of the two hashes may collide everywhere: the result is the same, here in one process."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=60)) + (PASSAGE[: 120 + i] if i % 3 == 0 else "")) for i in range(60)]
    want = {d: v for (d, _), v in naive_repeats(rows, 100).items()}
    mix = suffixes._mix
    for weak in (lambda a, b: mix(a, b) & np.uint64(3), lambda a, b: np.zeros_like(b if isinstance(b, np.ndarray) else a)):
        monkeypatch.setattr(suffixes, "_mix", weak)
        known = []
        held = []
        for d, t in rows:
            for r in suffixes.windows_by_anchor(t.encode()):
                r.columns |= {"doc": np.full(len(r), d, np.int64), "tie": np.zeros(len(r), np.int64)}
                held.append(r)
        batch = pa.Table.from_batches(list(suffixes._combine(suffixes.Records.join(held), last=False)))
        compared = pa.Table.from_batches(list(suffixes._compare_records(iter(batch.to_batches())))).to_pylist()
        known = [(x["doc"], x["pos"], x["n"]) for x in compared if x["kind"] == suffixes.REPEAT]
        texts = [(d, 0, t, [x for x in compared if x["doc"] == d and x["kind"] != suffixes.REPEAT]) for d, t in rows]
        opened = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((d, 0, t, o) for d, _, t, o in texts))], ["doc", "tie", "text", "open"])
        found = pa.Table.from_batches(list(suffixes._suffixes(iter([opened]), 100))).to_pylist()
        known += [(x["doc"], x["pos"], x["n"]) for x in found if x["n"] > 0 and x["span"] is None]
        sort = pa.Table.from_pylist([x for x in found if x["n"] == 0 or x["span"] is not None], suffixes._SUFFIX)
        known += [(x["doc"], x["pos"], x["n"]) for b in suffixes._neighbours(iter(sort.to_batches()), 100) for x in b.to_pylist()]
        for d, t in rows:
            kept, runs = suffixes.kept_bytes(t.encode(), [{"pos": p, "n": n} for e, p, n in known if e == d])
            assert (len(t.encode()) - len(kept), runs, kept) == want[d]


def test_short_texts_and_spans_are_hashed_together(monkeypatch):
    """Texts hashed as one give each text's own records, and neither texts nor spans are hashed one by one."""
    rng = random.Random(12)
    texts = [bytes(rng.choices(b"abc ", k=rng.choice([0, 5, 99, 100, 101, 400]))) for _ in range(60)] + [b"a" * 300, bytes(rng.choices(b"ab", k=suffixes.BLOCK + 500)), PASSAGE.encode()]
    want = sorted((i, *row) for i, t in enumerate(texts) for r in suffixes.windows_by_anchor(t) for row in zip(*(r.columns[c].tolist() for c in ("gram", "span", "more", "pos", "n"))))
    hashes, calls = suffixes._hashes, []
    monkeypatch.setattr(suffixes, "_hashes", lambda *a: calls.append(a) or hashes(*a))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array([t.decode() for t in texts])], ["doc", "tie", "text"])
    found = pa.Table.from_batches(list(suffixes._records(iter([batch]), 100, 32)))
    assert len(calls) <= 4
    opened = [{"kind": suffixes.MANY, "gram": 1, "pos": 3 * i, "n": 3} for i in range(90)]
    calls.clear()
    spans = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([0]), pa.array([bytes(rng.choices(b"abcdefgh ", k=400)).decode()]), pa.array([opened])], ["doc", "tie", "text", "open"])
    assert sorted(x["pos"] for b in suffixes._suffixes(iter([spans]), 100) for x in b.to_pylist()) == list(range(270)) and len(calls) == 1
    got = sorted((int(r.of[j]), *(int(r.columns[c][j]) for c in ("gram", "span", "more", "pos", "n"))) for r in suffixes.windows_of_texts(texts) for j in range(len(r)))
    assert got == want and found.num_rows > 0


def test_strip_clashing_names(spark):
    rows = [(1, PASSAGE, "a", 7, [1]), (2, "x " + PASSAGE, "b", 8, [2]), (None, None, "c", 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string, tie int, gone array<int>")
    got = suffixes.strip_repeats(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, PASSAGE, "a", 7, [1]), (2, "x ", "b", 8, [2]), (None, None, "c", 9, None)], key=str)


def test_suffixes_of_many_spans(spark, monkeypatch):
    """A passage in many contexts goes window by window, and gives the same result."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=60)) + PASSAGE[rng.randint(0, 60) : rng.randint(200, 300)] + " ".join(rng.choices("abcdefgh", k=60))) for i in range(120)]
    want = naive_repeats(rows, 100)
    found = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert found == {d: v for (d, _), v in want.items()}


def test_sentencepiece(docs, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted(((r.doc_id, tuple(r.ids), r.decoded) for r in pieces.encode_decode(docs, path).collect()), key=str)
    coded = [(d, [*library.encode(t or ""), library.eos_id()]) for d, t, *_ in ROWS]
    assert got == sorted(((d, tuple(i), library.decode(i)) for d, i in coded), key=str)
    assert pieces.encode_decode(empty, path).count() == 0
    table = pieces.ChunkTable(path)
    for text in (" ", "  a  b ", "▁x ▁▁y", "\t\n", "<s> </s>", "日本 語 😀", "a\x00b"):
        assert table.encode([text])[0].tolist() == library.encode(text)


def test_media(docs, empty):
    rows = media.document_media(docs).collect()
    assert len(rows) == len(ROWS)
    want = sorted(str((d, len((t or "").encode()), hashlib.sha256((t or "").encode().ljust(max(1, -(-len((t or "").encode()) // 64)) * 64, b"\0")).hexdigest())) for d, t, *_ in ROWS)
    assert sorted(str((r.doc_id, r.n_bytes, r.payload_sha256)) for r in rows) == want
    assert media.document_media(empty).count() == 0
    items = media.sequence("<p>a <b>b</b></p><figure><img src='sha256:00' alt='x'><figcaption>cap</figcaption></figure>tail<img src=u.png>")
    assert [(i["position"], i["kind"], i["text"], i["digest"], i["caption"]) for i in items] == [(0, "text", "a b", None, None), (1, "media", None, "00", "cap"), (2, "text", "tail", None, None), (3, "media", "u.png", None, None)]


def test_media_columns(docs):
    """Every output column against the bytes themselves."""
    def want(text):
        data = (text or "").encode()
        payload = data.ljust(max(1, -(-len(data) // 64)) * 64, b"\0")
        stored = b"P5\n64 %d\n255\n" % (len(payload) // 64) + payload
        mean = sum(payload) / len(payload)
        deviation = (sum((x - mean) ** 2 for x in payload) / len(payload)) ** 0.5
        shares = ",".join(f"{sum(x >> 6 == k for x in payload) / len(payload):.4f}" for k in range(4))
        feature = f"rows={len(payload) // 64};mean={mean:.4f};dev={deviation:.4f};shares={shares}"
        return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature

    rows = media.document_media(docs).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(str((d, *want(t))) for d, t, *_ in ROWS)


def test_media_captions():
    def of(html):
        return [(i["kind"][0], i["text"] or i["digest"], i["caption"]) for i in media.sequence(html)]

    assert of("<figure><figcaption>cap</figcaption><img src=sha256:1 alt=x><img src=sha256:2></figure><img src=sha256:3 alt=y>") == [("m", "1", "cap"), ("m", "2", "cap"), ("m", "3", "y")]
    assert of("<img src=sha256:1 alt=x><figcaption>loose</figcaption>t") == [("m", "1", "x"), ("t", "loose", None), ("t", "t", None)]
    assert of("<figure><img src=sha256:1><figure><img src=sha256:2><figcaption>in</figcaption></figure><figcaption>out</figcaption></figure>") == [("m", "1", "out"), ("m", "2", "in")]
    assert of("<html><head><title>no</title><meta charset=x><body><p>yes<img src=u>") == [("t", "yes", None), ("m", "u", None)]
    assert of("<head><style>x</style><p>yes</p><template><img src=u></template><script>z</script>tail") == [("t", "yes", None), ("t", "tail", None)]
    assert of("<figure><img src=u><figcaption>open") == [("m", "u", "open")]
    items = media.sequence("<p>a</p><img src=u><p>b</p>")
    assert [i["position"] for i in items] == [0, 1, 2]


def test_media_resolve(spark):
    """Positions and captions stay with their references, copies of a payload are one row, unknown digests give nulls."""
    stored = media.store(spark.createDataFrame([("aa", b"x"), ("aa", b"x"), ("bb", b"yy")], "digest string, data binary"))
    assert sorted((r.digest, r.n_bytes) for r in media.features(stored).collect()) == [("aa", 1), ("bb", 2)]
    pages = spark.createDataFrame([(1, "<img src=sha256:bb alt=p><p>t</p><img src=sha256:aa alt=q>"), (1, "<img src=sha256:cc>"), (2, None), (None, "<img src=sha256:aa>")], "page_id long, html string")
    rows = media.resolve(media.interleave(pages), media.features(stored)).collect()
    assert {(str(r.page_id), r.position, r.caption, r.digest, r.n_bytes) for r in rows} == {("1", 0, "p", "bb", 2), ("1", 2, "q", "aa", 1), ("1", 0, None, "cc", None), ("None", 0, None, "aa", 1)}
    assert media.interleave(pages.limit(0)).count() == 0


PAGES = [(1, "http://a", "x" * 120), (2, None, "x" * 120), (3, "u", None), (4, "u", ""), (5, "u", "y" * 99), (6, "u", "y" * 99), (7, "u", "é WARC/1.1\r\n " * 9000 + "WARC/1.1"), (None, "u", "x" * 120), (8, "u\r\nv", "é WARC/1.1\r\n " * 9000 + "WARC/1.1")]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.error) for r in warc.round_trip(pages).collect()}
    origin = {2: 1, 8: 7, None: 1}
    want = {p: (len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if p in origin else "response", origin.get(p), None) for p, _, h in PAGES}
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_of_others(spark, tmp_path):
    """WARC/1.0 is read; orphan continuations, other types, damaged and missing segments are rows with an error."""
    made = [r for i in range(3) for r in warc.records_of(i, "u", "z" * 9000, None, f"n{i}")]
    made = [r for r in made if not (b"<urn:page:n2>\r\nWARC-Date" in r and b"Type: response" in r)]
    made.remove(next(r for r in made if b"<urn:page:n1:2>" in r))
    made.append(warc._record({"WARC-Type": "warcinfo", "WARC-Record-ID": "<i>"}, b"software: x"))
    (tmp_path / "a.warc").write_bytes(b"".join(r + b"\n" for r in made).replace(b"WARC/1.1\r\n", b"WARC/1.0\r\n"))
    rows = warc.reassemble(warc.read(spark, str(tmp_path / "a.warc"), "WARC/1.0")).collect()
    assert sorted((r.type, str(r.page_id), r.error) for r in rows if r.error) == [("continuation", "None", "segments missing"), ("response", "1", "segments missing"), ("warcinfo", "None", "record type")]
    assert [(r.page_id, bytes(r.payload)) for r in rows if not r.error] == [(0, b"z" * 9000)]


def test_warc_segments_of_usual_pages():
    """A page of a few KB is cut into segments by default."""
    assert [r.split(b"\r\n")[1] for r in warc.records_of(1, "u", "z" * 6000, None, "n")] == [b"WARC-Type: response", b"WARC-Type: continuation"]


def test_warc_errors():
    block = warc.chunked(b"abc")
    assert warc.dechunked(block) == b"abc"
    assert warc._whole(5, [{"segment": 1, "block": b"ab"}, {"segment": 3, "block": b"abc"}])[1] == "segments missing"
    assert warc._whole(6, [{"segment": 1, "block": b"ab"}, {"segment": 2, "block": b"abc"}])[1] == "total length"
    assert warc.parse(b"WARC-Type: response\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")[-1] == "content length"


PAGE = """<html><body class="home ads"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div id=wrap><div id=content><h1>Headline here</h1>
<p>First long paragraph, with commas, and words. It goes on &amp; on.</p><script>var t="</p>";</script><ul><li>One item.<li>Two items.</ul>
<p>Second   paragraph, <a href=x>with a link</a> and more text; yes.</p></div><div class="sidebar"><p>Popular posts, and many others.</p></div>
<div id=comments><p>Nice post, I liked it, thank you.</p></div></div><div class="cookie-notice">We use cookies.</div><footer>&copy; 2020</footer></body></html>"""


def test_extraction(spark):
    want = "Headline here\n\nFirst long paragraph, with commas, and words. It goes on & on.\n\nOne item.\n\nTwo items.\n\nSecond paragraph, with a link and more text; yes."
    assert extraction.main_text(PAGE) == want
    assert extraction.main_text("<nav>x</nav><article><h1>T</h1><p>a<br>b<p><b>c</article><footer>long footer text, here.</footer>") == "T\n\na b\n\nc"
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", "<p"), (None, "u", "<p>a &lt; b")], "page_id long, url string, html string")
    rows = {(r.page_id, r.text, r.n_chars) for r in extraction.extract(pages).collect()}
    assert rows == {(1, want, len(want)), (2, "", 0), (3, "", 0), (3, "<p", 2), (None, "a < b", 5)}
    assert extraction.extract(pages.limit(0)).count() == 0


def test_extraction_whole_pages():
    """Headings beside the body, all of an article in two sections, and short articles beside a long one stay."""
    long = "A sentence of the text, with commas, and more of it; so it goes on. "
    body = "".join(f"<p>{long * 3}</p>" for _ in range(4))
    assert extraction.main_text(f"<div id=post><h1>T</h1><div class=body>{body}</div></div>").startswith("T\n\nA sentence")
    two = extraction.main_text(f"<body><div id=post><section>{body}</section><section><p>Second part, {long * 3}</p><p>{long * 3}</p></section></div></body>")
    assert "Second part" in two and two.count("\n\n") == 5
    articles = extraction.main_text(f"<article>{body}</article><article><p>Short note.</p></article>")
    assert articles.endswith("Short note.")


def test_scores_decide(monkeypatch):
    """Link lists in an article stay, those beside it go; on pages without article, or without any mark, other scores give another text."""
    sentence = "A sentence of the text, with commas, and more of it; so it goes on. "
    body = "".join(f"<p>{sentence * n}</p>" for n in (3, 1, 4, 2))
    short = "<h2>Part</h2><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><div class=legal>Held for all.</div><div class=search-history>No finds.</div>"
    menu = "<div class=x><ul>" + "".join(f"<li><a href=/{w}>{w}</a>" for w in ("home", "news", "about")) + "</ul></div>"
    links = "<ul>" + "<li><a href=/>More of it</a>" * 4 + "</ul>"
    inside = ["T", *(" ".join((sentence * n).split()) for n in (3, 1, 4, 2)), "Part", "one", "two", "a", "b", "Held for all.", "No finds."]
    bare = inside[:-2]  # such classes are marks outside article and main
    pages = {
        f"<body>{menu}<article><h1>T</h1>{body}{short}{links}</article><div class=changed>Last changed today.</div></body>": inside + ["More of it"] * 4,
        f"<body>{menu}<div><h1>T</h1>{body}{short}{links}</div><div class=changed>Last changed today.</div></body>": bare,
        f"<body>{menu}<div id=post><h1>T</h1><div class=body>{body}{short}</div></div><div class=changed>Last changed today.</div></body>": bare,
    }
    for page, want in pages.items():
        assert extraction.main_text(page).split("\n\n") == want
    monkeypatch.setattr(extraction, "path_scores", lambda path, *_: np.ones(len(path)))
    unmarked = [(page, want) for page, want in pages.items() if "<article" not in page]
    for page, want in unmarked:
        assert extraction.main_text(page).split("\n\n") != want
    monkeypatch.undo()
    rng = np.random.default_rng(1)
    monkeypatch.setattr(extraction, "path_scores", lambda path, *_: rng.random(max(path) + 1)[path] ** 4)
    for page, want in unmarked:
        assert extraction.main_text(page).split("\n\n") != want


def test_marks_only_remove(monkeypatch):
    """Whatever is marked, the text is some of what the page has without marks, in its order."""
    monkeypatch.setattr(extraction, "_marked", lambda *_: extraction.NOT)
    monkeypatch.setattr(extraction, "RAW", frozenset({"script", "title"}))
    bare = extraction.main_text(PAGE).split("\n\n")
    monkeypatch.undo()
    marked = extraction.main_text(PAGE).split("\n\n")
    assert [t for t in bare if t in marked] == marked


def test_words_in_classes_dont_drop_sections():
    """A class that holds more than such words, or a weak one outside article, drops a section only if its ratios are low."""
    sentence = "A sentence of the text, with commas, and more of it; so it goes on. "
    body = "".join(f"<p>{sentence * n}</p>" for n in (3, 1, 4))
    for name in ("menu-design", "ad-block", "comment-syntax", "respond-time", "footer-note", "notice-board"):
        section = f"<section class='{name}'><h2>Part</h2><p>Its own text, which is long enough; and goes on, as such texts do.</p></section>"
        assert "Part\n\nIts own text" in extraction.main_text(f"<article><h1>T</h1>{body}{section}</article>"), name
        assert "Buy" not in extraction.main_text(f"<article><h1>T</h1>{body}<div class='{name}'><p>Buy<p>Now</div></article>"), name
    for name in ("ad", "comment-list", "sidebar right", "site-footer", "cookieNotice"):
        assert "Its own" not in extraction.main_text(f"<article>{body}<div class='{name}'><p>Its own text, which is long enough; and goes on, as such texts do.</p></div></article>"), name
    weak = f"<body><div class=post>{body}<div class='share-price'><p>Its own text, which is long enough; and goes on, as such texts do.</p></div></div></body>"
    assert "Its own" in extraction.main_text(weak)


def test_scores_find_the_text_without_marks(spark):
    """On pages whose articles, menus and footers are plain div elements without classes, the ratios find the same text, with little else."""
    lost = more = size = 0
    for page in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120).collect():
        want = extraction.main_text(page.html).split("\n\n")
        plain = re.sub(r'\sclass="[^"]*"', "", re.sub(r"<(/?)(article|main|nav|footer|header|aside)\b", r"<\1div", page.html or ""))
        one, other = Counter(want), Counter(extraction.main_text(plain).split("\n\n"))
        lost, more, size = lost + sum(map(len, (one - other).elements())), more + sum(map(len, (other - one).elements())), size + sum(map(len, want))
    assert lost <= 0.02 * size and more <= 0.03 * size


@pytest.mark.parametrize("page", ["<a " * 340_000, "<div>" * 200_000 + "x", '<a ">"' * 20_000, "<li>" + "<div>" * 4000 + "<li>x" * 50_000, "<!--" * 250_000, "<p " + "a" * 10**6 + ">x", "<div>" * 90_000 + "</x>" * 90_000, "<" * 10**6, "<div><h2>a</h2>" * 30_000])
def test_extraction_of_bad_pages(page):
    """Pages of up to 1 MB that are badly formed or deeply nested take seconds."""
    began = time.process_time()
    extraction.main_text(page)
    assert time.process_time() - began < 10


def test_extraction_edges():
    of = extraction.main_text
    assert of("<article><p>x <a title='a > b' href=y>y</a> z</article>") == "x y z"
    assert of("<div><p>a<svg/>b <script>no</script>c<!-- d --> e &eacute;</div>") == "ab c e é"
    assert of("<table><tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"
    assert of("<article><p>Long text, of the article.</p><div class=sidebar>no</div><div class='comment-list'>no, never</div></article>") == "Long text, of the article."


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.93


def test_language_edges(docs, empty):
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    rows = {r.doc_id: r for r in langid.identify(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))).collect()}
    assert len(rows) == 12 and rows[1].lang_pred == rows[2].lang_pred == "und" and rows[9].lang_pred in ("a", "b") and not rows[None].held_out
    assert langid.identify(empty.withColumn("lang", F.lit("a"))).count() == 0


def test_language_short_texts(spark):
    """Two words each, fewer bytes than any window has: learned and told apart."""
    words = {"en": ["house water", "green tree", "little bird"], "de": ["haus wasser", "grüner baum", "kleiner vogel"]}
    rows = [(i * 100 + k, text, lang) for i, (lang, texts) in enumerate(words.items()) for k, text in enumerate(texts * 7)]
    net = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert np.mean([p[0] == r[2] for p, r in zip(langid.predict_texts(net, [r[1] for r in rows]), rows)]) > 0.9


def test_language_clashing_names(spark):
    rows = [(i, "the house and the water of the green tree", "en", "kept", 5) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, Lang_Pred string, score int")
    net = langid.fit(docs, F.lit(True))
    assert langid.predict(docs, net).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert {tuple(r)[3:5] + (r.p, round(r.s, 3)) for r in langid.predict(docs, net, ("p", "s")).collect()} == {("kept", 5, "en", 1.0)}


@pytest.fixture(scope="module")
def licence_model():
    return licences.fit()


def naive_notices(model, text):
    """(paragraph, family, probability, similarity) of a text's notices, from every paragraph."""
    at, found = {g: i for i, g in enumerate(model.features)}, []
    bodies = [b for b in re.split(r"\r?\n[ \t]*(?:\r?\n[ \t]*)+", (text or "").lower()) if b.strip(" \t\r\n")]
    for n, body in enumerate(bodies):
        grams = [g for g in licences.ngrams(body) if g in at]
        p = licences._softmax((model.bias + sum((model.weights[at[g]] for g in grams), np.zeros(len(model.classes))))[None] / model.temperature)[0]
        k = int(p.argmax())
        if model.classes[k] == licences.OTHER:
            continue
        shares = [len(set(t) & set(grams)) / len(t) for f, t in model.templates if f == model.classes[k]]
        sure = model.classes[k] != licences.UNKNOWN and p[k] >= model.threshold
        found.append((n, model.classes[k] if sure else licences.UNKNOWN, round(float(p[k]), 4), round(max(shares, default=0.0), 4)))
    return found


def test_licences(spark, docs, empty, licence_model):
    model, wrapped = licence_model, "Permission is hereby granted, free\nof charge, to any person obtaining\na copy of this software and associated documentation files"
    rows = [(1, "text\n\nReleased under the MIT License."), (2, "Licensed under the Apache License, Version 2.0.\nfoo"), (3, "All rights reserved."), (4, "You need a driving license to rent a car."), (5, None), (6, ""), (7, "Sie kommt mit uns."), (7, "a\n\n \t\nLicensed under CC BY-NC 4.0."), (8, "\n\nb\r\n\r\n" + wrapped), (9, "See MIT_LICENSE"), (10, "Released under GPLv3."), (None, "Licensed under the Frobnitz Public License."), (11, LONG + "\n" + wrapped)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("body", F.lit(1))
    found = licences.scan(df, model).collect()
    got = {(r.doc_id, r.paragraph, r.family, r.confirmed) for r in found}
    assert {(1, 1, "mit", True), (2, 0, "apache-2.0", True), (3, 0, "proprietary", True), (7, 1, "cc-by-nc", True), (8, 1, "mit", True), (9, 0, "mit", True), (10, 0, "gpl", True), (None, 0, "unknown", False), (11, 0, "mit", True)} == got
    assert licences.scan(docs, model).count() == 0 and licences.scan(empty, model).count() == 0


def test_licences_equal_brute_force(spark, licence_model):
    """Every paragraph of a table and many that are close to a notice: the gate loses none."""
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(4)
    words = [w for g in licence_model.features for w in g.split()]
    docs += [(10**6 + i, " ".join(rng.choice(words) + rng.choice(["", "", ",", "_", ".5"]) for _ in range(rng.randint(1, 5)))) for i in range(2000)]
    got = {}
    for r in licences.scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), licence_model).collect():
        got.setdefault(r.doc_id, []).append((r.paragraph, r.family, round(r.probability, 4), round(r.similarity, 4)))
    want = {d: n for d, t in docs if (n := naive_notices(licence_model, t))}
    assert got.keys() == want.keys() and sum(map(len, got.values())) > 100
    for d in want:
        assert [x[:2] for x in sorted(got[d])] == [x[:2] for x in sorted(want[d])]
        assert np.allclose([x[2:] for x in sorted(got[d])], [x[2:] for x in sorted(want[d])], atol=2e-4)


@pytest.mark.parametrize("family", ["isc", "epl", "zlib", "busl"])
def test_licence_of_no_known_family(family):
    """Notices of a family that was left out of the training are unknown."""
    model = licences.fit(families=[f for f in licences.NAMES if f != family])
    found = [naive_notices(model, t) for t, _ in licences.notices([family])]
    assert np.mean([bool(n) and n[0][1] == licences.UNKNOWN for n in found]) > 0.9


def test_neighbours_in_query_blocks(spark, monkeypatch):
    """Blocks of queries, parts of other sizes and columns of clashing names change nothing; equal vectors tie by id."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(rng.normal(size=(300, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, near int, block int")
    found = lambda: sorted(tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0).collect())
    want = found()
    for name, value in (("ASKING", 4), ("PART", 60), ("PARTS", 2), ("LARGE", 100)):
        monkeypatch.setattr(neighbours, name, value)
    assert found() == want and len(want) == 300
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(same, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in range(1, 11)]


def test_simhash_clashing_names(spark):
    rows = [(1, "one two three four", 1, 2, 3), (2, "one two three four", 4, 5, 6), (3, None, 7, 8, 9)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id int, low int")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3)]


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16))
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (800, [0.0] * 16), (900, [float("nan")] * 16), (1000, [1.0, None] + [0.0] * 14), (None, x[3].tolist()), (1100, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(0))
    got: dict[int, list] = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300, 400, 500]
    hits = 0
    for q, near in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(600), d))[:10]
        hits += len(set(want) & {v for v, _ in near})
        assert all(abs(d[v] - s) < 1e-12 for v, s in near) and [s for _, s in near] == sorted(s for _, s in near)
    assert hits >= 0.9 * 60 and [v for v, _ in got[100]] == list(range(101, 111))
    few = neighbours.nearest(df.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert len(few) == 3
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
