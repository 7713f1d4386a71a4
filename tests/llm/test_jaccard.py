"""The Jaccard join against all pairs, and what its sketches promise."""

import random
from itertools import combinations

import numpy as np
import pytest

from tests.llm.cases import SF, clashing, collected, documents, empty, sentence
from tidemark.llm import jaccard
from tidemark.llm.common import written


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def by_hand(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    holders, root = {}, list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def varied(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        k = rng.randrange(len(words))
        rng.choice([lambda: words.__setitem__(k, f"w{rng.random()}"), lambda: words.insert(k, f"w{rng.random()}"), lambda: len(words) > 1 and words.pop(k)])()
    return " ".join(words)


def corpus(seed):
    """Families around a text, chains of edits, copies, shared passages, sizes near the edge of bands."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    texts = []
    for n in (1, 2, 4, 5, 6, 8, 9, 12, 20, 34, 36, 60, 68, 130, 300, 900):
        base = sentence(rng, n)
        texts += [base, base.upper(), base + " more"]
        texts += [varied(rng, base, rng.randint(1, max(1, n // 25))) for _ in range(8)]
        step = base
        for _ in range(6):
            step = varied(rng, step, max(1, n // 30))
            texts.append(step)
    texts += [passage + " " + sentence(rng, k) for k in (5, 10, 14, 15, 20, 40) for _ in range(6)]
    texts += [sentence(rng, 80) for _ in range(20)] + [None, "", " ", "a", "A", "the the the the the the", "the " * 40, "the " * 4]
    ids = rng.sample(range(10 ** 6), len(texts))
    return list(zip(ids, texts, strict=True)) + [(ids[0], texts[0]), (None, texts[3]), (None, None), (None, "nobody else has this text here today")]


def asked(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in jaccard.grouped(docs, **options).collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_groups_of_all_pairs(spark, seed):
    rows = corpus(seed)
    assert asked(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("percent", [60, 95])
def test_other_thresholds(spark, percent):
    rows = corpus(9)[::2]
    assert asked(spark, rows, percent=percent) == by_hand(rows, percent)


def test_no_centre_needed(spark, monkeypatch):
    """Without rounds of centres, tiles alone find every link, here tiles of few members."""
    rows = corpus(4)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard.tile_pairs, "__defaults__", (3,))
    assert asked(spark, rows) == by_hand(rows)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = asked(spark, rows)
    assert found == by_hand(rows)
    assert any(d != c for d, _, c in found)


def test_a_family_meets_its_centre(spark):
    """Variants that are near the base text but not one another: a row for each, not for each pair."""
    rng = random.Random(2)
    base = sentence(rng, 90)
    rows = [(0, base)] + [(k, varied(rng, base, 1)) for k in range(1, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = written(jaccard.sets_of(docs), "sets")
    keys = written(jaccard.buckets_of(jaccard.word_keys(docs, 40), sets), "keys")
    score = keys.groupBy("who").count().withColumnRenamed("count", "score")
    buckets = keys.join(score, "who").join(sets.groupBy("who", "node").agg({"size": "min"}).withColumnRenamed("min(size)", "size"), "who")
    pairs = jaccard.star_pairs(buckets.selectExpr("key", "node", "size", "score", "node label"), 80)
    assert pairs.count() <= 200
    assert asked(spark, rows) == by_hand(rows)


def test_sketches_and_words_bound_the_difference():
    rng = random.Random(5)
    bands = jaccard.Bands()
    for n in (6, 9, 30, 100, 700):
        base = sentence(rng, n + 4)
        texts = [base] + [varied(rng, base, rng.randint(1, max(1, n // 20))) for _ in range(20)]
        s = jaccard.Shingles([t.encode() for t in texts])
        sets = [shingles(t) for t in texts]
        assert s.size.tolist() == [len(x) for x in sets]
        flips = np.array([np.bincount((s.h[s.doc == d] & np.uint64(jaccard.BITS - 1)).astype(int), minlength=jaccard.BITS) & 1 for d in range(len(texts))])
        band, apart = bands.own(np.full(len(texts), n))
        doc, key, _ = jaccard.words_of(s, band, np.maximum(apart, 1), bands)
        parts = int(bands.parts(band)[0])
        for j in range(1, len(texts)):
            differ = len(sets[0] ^ sets[j])
            assert (flips[0] != flips[j]).sum() <= differ
            same = len(set(key[doc == 0].tolist()) & set(key[doc == j].tolist()))
            empty = parts - max((doc == 0).sum(), (doc == j).sum())
            assert same >= parts - differ - empty


def test_every_linked_size_is_met_in_one_band():
    """Linked sets agree in a word both would show: parts exceed the difference, in the band where they meet."""
    bands = jaccard.Bands()
    n = np.arange(1, 5000)
    band, own = bands.own(n)
    below, visited = bands.visited(n)
    for a in range(1, 5000, 7):
        b = np.arange(a, a * 100 // 80 + 1)
        b = b[(b < 5000) & (bands.apart(np.int64(a), b) > 0)]
        same = b[band[b - 1] == band[a - 1]]
        apart = bands.apart(np.int64(a), same)
        assert (own[same - 1] >= apart).all() and (own[a - 1] >= apart).all()
        next_ = b[band[b - 1] != band[a - 1]]
        apart = bands.apart(np.int64(a), next_)
        assert (below[next_ - 1] == band[a - 1]).all() and (visited[next_ - 1] >= apart).all() and (own[a - 1] >= apart).all()
        if len(b):
            assert bands.parts(band[a - 1:a])[0] > bands.apart(np.int64(a), b).max()


def test_edges(spark):
    docs = documents(spark)
    plain = collected(jaccard.digest(docs))
    assert len(plain) == docs.count()
    assert collected(jaccard.digest(clashing(docs))) == plain
    assert jaccard.digest(empty(spark)).collect() == []
    nulls = docs.selectExpr("doc_id", "cast(null as string) text")
    assert {(r.doc_id, r.component_id, r.n_shingles) for r in jaccard.digest(nulls).collect()} == {(r.doc_id, r.doc_id, 0) for r in docs.collect()}
