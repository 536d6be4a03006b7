"""The n-gram join against all pairs of shingle sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tailloom.llm import ngramjoin


def shingles(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return set(zip(*(words[i:] for i in range(k)))) if k else set()


def naive(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label = [label[i] if x == label[j] else x for x in label]
    low = {}
    for x, (d, _) in zip(label, rows):
        if d is not None:
            low[x] = min(low.get(x, d), d)
    return [(d, len(s), low.get(x) if s else d) for (d, _), s, x in zip(rows, sets, label)]


def words(rng, n, kinds=10**6):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def corpus(seed):
    """Copies, chains of edits, families under and over the limit, passages in a third of the texts, short texts."""
    rng = random.Random(seed)
    passage, found = words(rng, 60), []
    for _ in range(6):  # chains
        text = words(rng, rng.choice([6, 20, 80, 300]))
        for _ in range(rng.randrange(2, 8)):
            found.append(" ".join(text))
            text = list(text)
            text[rng.randrange(len(text))] = "new"
            if rng.random() < 0.4:
                del text[rng.randrange(len(text))]
    template = words(rng, 200)
    for k in range(12):  # a family that is alike, but not enough, and pairs in it that are
        own = template[:170] + words(rng, 30)
        found += [" ".join(own), " ".join(own[:-2] + ["x", str(k)])]
    found += [" ".join(words(rng, 40) + passage) for _ in range(25)] + [" ".join(passage)] * 3
    found += [" ".join(words(rng, 5, 2)) for _ in range(15)] + [" ".join(words(rng, rng.randrange(1, 5), 3)) for _ in range(15)]
    found += [None, "", " \t\n", "ÉA b", "éa B", "É b", "A\x0bB\x1cC", " ".join(words(rng, 4000)), "x " * 3000, "x " * 9]
    ids = rng.sample(range(1000), len(found))
    rows = [(i if k % 9 else None, t) for k, (i, t) in enumerate(zip(ids, found))]
    return rows + rows[:15]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "c", 0) for d, t in rows], "doc_id long, text string, set_id string, n int").repartition(5)


@pytest.mark.parametrize("seed,whole,block", [(1, 1 << 20, 1024), (2, 900, 6)])
def test_join_equals_all_pairs(spark, monkeypatch, seed, whole, block):
    monkeypatch.setattr(ngramjoin, "WHOLE", whole)
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    rows = corpus(seed)
    docs = frame(spark, rows)
    got = ngramjoin.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(naive(rows), key=str)
    if seed == 1:
        assert ngramjoin.near_duplicates(docs.limit(0)).count() == 0
        assert ngramjoin.near_duplicates(docs.where("text is null")).collect()[0].n_shingles == 0


def test_crowded_bucket(spark):
    """Pairs of 0.83 in a family that is 0.72 alike otherwise: every pair is found, and no more."""
    rng = random.Random(7)
    template = words(rng, 400)
    rows, pairs = [], 60
    for k in range(pairs):
        own = words(rng, 68)
        rows += [(2 * k, " ".join(template + own)), (2 * k + 1, " ".join(template + own[:50] + words(rng, 40)))]
    sets = [shingles(t) for _, t in rows]
    alike = lambda a, b: len(a & b) / len(a | b)
    assert 0.8 <= min(alike(sets[2 * k], sets[2 * k + 1]) for k in range(pairs)) and max(alike(sets[0], s) for s in sets[2:]) < 0.8
    got = {r.doc_id: r.component_id for r in ngramjoin.near_duplicates(frame(spark, rows)).collect()}
    assert got == {d: d // 2 * 2 for d in got} and len(got) == 2 * pairs


def test_known_pairs_are_compared(spark):
    """Pairs given by texts count only if they link."""
    rng = random.Random(5)
    one, other = words(rng, 100), words(rng, 100)
    texts = [" ".join(one), " ".join(one[:-1]), " ".join(other)]
    docs = frame(spark, list(enumerate(texts)))
    keys = {r.doc_id: r.key for r in docs.select("doc_id", ngramjoin.text_key().alias("key")).collect()}
    known = spark.createDataFrame([(keys[0], keys[1]), (keys[0], keys[2])], "a binary, b binary")
    rows, sets = ngramjoin.classes(docs, ["doc_id"], known=known)
    found = {r.doc_id: r.class_id for r in rows.join(sets, "set_key").collect()}
    assert found[0] == found[1] != found[2]


@pytest.mark.parametrize("fanout,at_once", [(2, 64), (3, 500), (8, 1 << 20)])
def test_trees_rule_out_no_link(monkeypatch, fanout, at_once):
    monkeypatch.setattr(ngramjoin, "FANOUT", fanout)
    monkeypatch.setattr(ngramjoin, "AT_ONCE", at_once)
    rng = np.random.default_rng(fanout)
    sets = []
    for _ in range(40):
        one = np.unique(rng.integers(0, 2**64, rng.choice([1, 2, 7, 33, 130, 500]), dtype=np.uint64))
        sets.append(one)
        for _ in range(3):
            other = one.copy()
            change = rng.integers(0, len(one), max(1, len(one) // rng.integers(5, 30)))
            other[change] = rng.integers(0, 2**64, len(change), dtype=np.uint64)
            sets.append(np.unique(other))
    none = np.zeros(0, np.uint64)
    found = [ngramjoin.signature(len(s), *ngramjoin.prefix(s, none, none, 80)) for s in sets]
    want = {(i, j) for i in range(len(sets)) for j in range(i) if ngramjoin.linked(sets[i], sets[j], 80)}
    pairs = set()
    for x, y in ngramjoin.may_link(found, np.arange(len(sets)), 80):
        pairs |= {(max(i, j), min(i, j)) for i, j in zip(x.tolist(), y.tolist())}
    assert want <= pairs and len(pairs) < len(sets) ** 2 / 20
    # pairs of one label are left out
    labels = np.arange(len(sets)) // 4
    for x, y in ngramjoin.may_link(found, labels, 80):
        assert (labels[x] != labels[y]).all()

    def classes(pairs):
        label = list(range(len(sets)))
        for i, j in pairs:
            label = [label[i] if x == label[j] else x for x in label]
        return [label.index(x) for x in label]

    assert classes(ngramjoin.links(sets, 80)) == classes(want)
    assert classes(enumerate(ngramjoin.may_connect(found, 80).tolist())) == classes(pairs)


def test_signatures_of_frequent_tokens():
    """Frequent tokens come last and have no bits; the rest of such a set is all in its front."""
    rng = np.random.default_rng(8)
    tokens = np.unique(rng.integers(0, 2**64, 100, dtype=np.uint64))
    frequent, counts = tokens[5:].copy(), np.arange(95)[::-1].copy()
    front, rare = ngramjoin.prefix(tokens, frequent, counts, 80)
    assert rare == 5 and len(front) == 21 and front[:5].tolist() == tokens[:5].tolist() and front[5:].tolist() == tokens[::-1][:16].tolist()
    of = ngramjoin.signature(100, front, rare)
    assert of.end == of.width == 1024 and np.bitwise_count(of.map).sum() <= 5
    half = ngramjoin.halved(of)
    bits = lambda s: set(np.flatnonzero(np.unpackbits(s.map.view(np.uint8), bitorder="little")).tolist())
    assert bits(half) == {b // 2 for b in bits(of)} and half.width == 512


def test_prefixes_share_a_shingle():
    rng = random.Random(1)
    tokens = np.array(sorted(rng.sample(range(10**6), 400)), np.uint64)
    frequent = tokens[::3]
    counts = np.arange(len(frequent))[::-1].copy()
    for _ in range(300):
        one = np.sort(np.array(rng.sample(tokens.tolist(), rng.randint(1, 60)), np.uint64))
        other = np.unique(np.concatenate([one[rng.randint(0, max(1, len(one) // 8)) :], np.array(rng.sample(tokens.tolist(), 3), np.uint64)]))
        if ngramjoin.linked(one, other, 80):
            assert set(ngramjoin.prefix(one, frequent, counts, 80)[0].tolist()) & set(ngramjoin.prefix(other, frequent, counts, 80)[0].tolist())


def test_word_hashes():
    """Words are as bytes.split and lower give them; equal words, and no others, have equal hashes."""
    rng = random.Random(9)
    long = "x" * 300
    texts = ["", " ", "a", "A b a", "ab ba a\tb\x0bc\x1cd", "é É \u00a0 \u2003", long + " " + long[:-1] + " " + long + "y", "".join(rng.choices("aAbB é\n\r", k=3000))]
    for text in texts:
        words = text.encode().lower().split()
        hashes = ngramjoin.word_hashes(text.encode()).tolist()
        assert len(hashes) == len(words)
        assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))
