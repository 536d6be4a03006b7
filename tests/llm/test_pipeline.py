import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tailloom.llm import ngramjoin, queries, simhash


def test_stages(spark):
    """Each stage on a fixture: what it must drop goes, clean documents stay, columns hold."""
    clean = [(i, " ".join(f"{w}{i}x{k}" for k in range(3) for w in "the quick brown fox jumps over the lazy dog again".split()), "en", "s", 0) for i in range(10, 16)]
    passage = " ".join(f"word{i}" for i in range(60))
    # enough words of its own that the pair's similarity, 56 / 81, is under the stage's 0.8
    own = " second, and words of its own for this one, and with so many more of them that it is a text apart"
    rows = [*clean, (1, None, "en", "s", 0), (2, "12 34 !!", "en", "s", 0), (30, clean[0][1], "en", "s", 0), (40, "first " + passage, "en", "s", 0), (41, passage + own, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = lambda df: {r.doc_id for r in df.collect()}
    one = corpus_pipeline.language(spark, docs, "")
    assert ids(one) == ids(docs) - {1, 2} and one.columns == docs.columns
    two = corpus_pipeline.near_duplicates(spark, one, "")
    assert ids(two) == ids(one) - {30} and two.columns == docs.columns
    three = corpus_pipeline.repeated_passages(spark, two, "")
    assert three.columns == docs.columns
    texts = {r.doc_id: r.text for r in three.collect()}
    assert texts[40] == "first " + passage and "word30" not in texts[41] and texts[41].endswith(own)
    assert all(texts[d] == t for d, t, *_ in clean)
    assert ids(corpus_pipeline.pack(spark, three, "")) == set(texts)


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, len(queries.QUERIES) + 1)]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def _documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_edited_copies_go(spark):
    """Copies of a long text with a few words changed, over three bits of fingerprint away, are near duplicates; half-equal texts aren't."""
    words = [f"w{i * 7919 % 5003}" for i in range(300)]
    edited = [" ".join("new" if i % 100 == 50 + k else w for i, w in enumerate(words)) for k in range(6)]
    half = " ".join(words[:150] + [f"v{i}" for i in range(150)])
    prints = [simhash.fingerprint(t) for t in (" ".join(words), *edited)]
    assert any((prints[0] ^ p).bit_count() > 3 for p in prints)
    assert ngramjoin.linked(*(ngramjoin.shingle_set(t.encode()) for t in edited[:2]), corpus_pipeline.SHARE)
    docs = _documents(spark, [(1, " ".join(words)), *enumerate(edited, 2), (9, half)])
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 9}


def test_one_row_of_each_group_stays(spark):
    """Rows without a doc_id and different texts that share one stay; of copies, the one with the smallest doc_id does."""
    text = [" ".join(f"t{k}x{i}" for i in range(30)) for k in range(5)]
    docs = _documents(spark, [(None, text[0]), (None, text[1]), (None, text[1]), (5, text[2]), (5, text[3]), (7, text[4]), (6, text[4]), (None, text[4])])
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(None, text[0]), (None, text[1]), (5, text[2]), (5, text[3]), (6, text[4])], key=str)


CLASHES = ["score", "lang_pred", "doc", "tie", "gone", "_gone", "_row", "row", "key", "fp", "part", "component", "bands", "sequence_id", "offset", "length"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_edges(spark, name):
    """Clashing columns come through; null ids, shared ids, null, empty and very long texts, and empty tables don't crash."""
    stage = dict(corpus_pipeline.STAGES)[name]
    long = "The long text " + " " * 1_000_000 + " and its end, which is far away from the beginning of it."
    rows = [(1, "A plain text of the usual kind, with its words.", "en"), (None, "Another one without an id, and with other words.", "en"), (None, "A third that has none, but is unlike the others too.", "en"), (5, "Two texts under one id, of which this is the first.", "en"), (5, "And here is that other text, with nothing in common.", "en"), (6, None, None), (7, "", None), (8, long, "en"), (9, "!!! 12", None)]
    docs = spark.createDataFrame([(d, t, x, "s", 0) for d, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))
    got = stage(spark, docs, "")
    found = got.collect()
    worded = {(d, t) for d, t, x in rows if x}
    if name == "packing":
        assert {r.doc_id for r in found} == {d for d, *_ in rows}
    else:
        assert got.columns == docs.columns
        texts = {(r.doc_id, r.text) for r in found}
        if name == "repeated_passages":  # the run of spaces is a repeat within its text
            worded = {(d, t) if t != long else (d, " ".join(long.split())) for d, t in worded}
            assert texts == worded | {(9, "!!! 12")}
        else:
            assert worded <= texts <= {(d, t) for d, t, _ in rows}
        assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for r in found for c in CLASHES)
    assert stage(spark, docs.limit(0), "").count() == 0


def test_close_fingerprints_are_confirmed(spark):
    """Texts with equal fingerprints, but under the similarity, both stay; one of those over it goes."""
    one, two = (" ".join(["a"] * 200 + [f"{k}{i}" for i in range(10)]) for k in "vw")
    assert simhash.fingerprint(one, 5) == simhash.fingerprint(two, 5)
    docs = _documents(spark, [(1, one), (2, two), (3, one + " tail")])
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 2}


def test_crowded_family(spark):
    """In a family of texts 0.72 alike, one of each pair of 0.83 goes and no other."""
    rng = random.Random(7)
    word = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    template, rows = word(400), []
    for k in range(50):
        own = word(68)
        rows += [(2 * k, " ".join(template + own)), (2 * k + 1, " ".join(template + own[:50] + word(40)))]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, _documents(spark, rows), "").collect()}
    assert kept == {2 * k for k in range(50)}
