"""What the pipeline's stages run must have an effect on what follows."""

import random

import corpus_pipeline
from tailloom.llm import ngramjoin, simhash


def test_near_duplicates_run_one_join(spark, monkeypatch):
    """The n-gram join finds every link; no fingerprints are made whose links it would find anyway."""

    def unwanted(*_):
        raise AssertionError("fingerprints have no effect on the classes")

    monkeypatch.setattr(simhash, "links", unwanted)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " x"), (3, text), (4, " ".join(f"v{i}" for i in range(60)))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 4}


def test_near_duplicates_leave_out_no_link(spark, monkeypatch):
    """With few frequent shingles told apart, and small blocks, one row of each group of all pairs' links stays and no other."""
    for name, value in [("FREQUENT", 3), ("BLOCK", 4), ("WHOLE", 300)]:
        monkeypatch.setattr(ngramjoin, name, value)
    rng = random.Random(4)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, template, texts = draw(25), draw(120), []
    for k in range(14):
        own = template[:90] + draw(30)
        texts += [own, own[: 28 + 6 * k] + ["new"] + own[29 + 6 * k :], draw(12) + passage + draw(k)]
    sets = [set(zip(*(t[i:] for i in range(5)))) for t in texts]
    first = list(range(len(texts)))
    for i, one in enumerate(sets):
        for j, other in enumerate(sets[:i]):
            if 100 * len(one & other) >= corpus_pipeline.SHARE * len(one | other):
                first = [min(first[i], first[j]) if x in (first[i], first[j]) else x for x in first]
    docs = spark.createDataFrame([(d, " ".join(t), "en", "s", 0) for d, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == set(first) and len(kept) < len(texts) - 5
