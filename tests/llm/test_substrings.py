import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import substrings
from tests.llm.cases import documents, rows, sentence


def expected(data, n=13):
    split = [(i, (t or "").encode().split()) for i, t in data]
    big = float("inf")
    least = {}
    for i, w in split:
        for a in range(len(w) - n + 1):
            k = tuple(w[a:a + n])
            least[k] = min(least.get(k, big), big if i is None else i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for a in range(len(w) - n + 1):
            if least[tuple(w[a:a + n])] < (big if i is None else i):
                gone[a:a + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((repr(i), len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_query_against_brute_force(spark):
    want = expected([(r[0], r[1]) for r in rows()])
    assert any(x[2] for x in want)
    assert got(substrings.digest(documents(spark))) == want


@pytest.mark.parametrize("seed,n,prefix,group", [(1, 13, 5, 50_000), (2, 13, 5, 1), (3, 6, 3, 4), (4, 13, 9, 2)])
def test_random_repeats(spark, seed, n, prefix, group):
    rng = random.Random(seed)
    shared = [sentence(rng, rng.randint(n, 50)) for _ in range(6)]
    data = []
    for i in range(80):
        parts = [sentence(rng, rng.randint(0, 30)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared))
        parts.insert(rng.randint(0, 3), rng.choice(shared)[rng.randint(0, 20):])
        # few word kinds: many common prefixes, also within one document
        parts.append(" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))))
        data.append((i, " ".join(parts)))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    out = substrings.without_repeats(df, n, prefix, group).selectExpr("row.doc_id", "n_words", "n_removed", "sha2(kept, 256) as kept_sha256", "spans")
    assert got(out) == expected(data, n)
    for r in out.collect():
        assert sum(s.end - s.first for s in r.spans) == r.n_removed
        assert all(s.end - s.first >= n for s in r.spans)


def test_small_batches_decide_the_same(spark, monkeypatch):
    want = expected([(r[0], r[1]) for r in rows()])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        assert got(substrings.digest(documents(spark).repartition(3))) == want
    finally:
        spark.conf.set(key, before)


def test_full_tables_of_bits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings.Bits, "holds", lambda self, h: np.ones(len(h), bool))
    want = expected([(r[0], r[1]) for r in rows()])
    data = documents(spark).where("length(text) < 50000 or text is null")
    small = expected([(r[0], r[1]) for r in rows() if r[1] is None or len(r[1]) < 50_000])
    docs = data.selectExpr("doc_id", "text")
    everything = substrings.Bits(substrings.SEGMENT_BITS, [(0, b"\xff" * (substrings.SEGMENT_BITS // 8))])
    monkeypatch.setattr(substrings, "bits_of", lambda hashes: everything)
    assert got(substrings.digest(docs)) == small and len(want) > len(small)


def test_bits_hold_what_they_were_given(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-2**63, 2**63 - 1, 9000)
    bits = substrings.bits_of(spark.createDataFrame([(int(x),) for x in h[:5000]], "h long"))
    assert bits.holds(h[:5000].view(np.uint64)).all()
    assert bits.holds(h[5000:].view(np.uint64)).mean() < 0.15
    assert not substrings.bits_of(spark.createDataFrame([], "h long")).holds(h.view(np.uint64)).any()


def test_tree_of_sorted_suffixes(spark):
    rng = random.Random(7)
    rows_ = [" ".join(rng.choice(["a", "b", "é"]) for _ in range(rng.randint(6, 12))) for _ in range(60)]
    words, begin = substrings.word_numbers(substrings.pa.array(rows_))
    group = np.repeat(np.arange(60) // 20, np.diff(begin) - 5)
    at = np.concatenate([np.arange(a, b - 5) for a, b in zip(begin, begin[1:], strict=False)])
    by, lcp = substrings.suffix_tree(group, words, at, 6)
    branch = [(int(group[i]), *words[at[i]:at[i] + 6].tolist()) for i in by]
    assert branch == sorted(branch)
    for x, a, b in zip(lcp[1:], branch, branch[1:], strict=False):
        assert x == (next((i for i in range(6) if a[i + 1] != b[i + 1]), 6) if a[0] == b[0] else 0)


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_nodes_branch_by_words(spark, chunk):
    # one group: rows that differ in the last word only are no repeat, whatever their hashes
    data = [(5, i, i, 0, 0, f"a b c d {x}") for i, x in enumerate("xyzxyxw")] + [(6, 9, 9, 4, 0, "a b c d x"), (7, 3, 3, 2, 1, "")]
    df = spark.createDataFrame(data, substrings._SUFFIXES)
    assert sorted(r.ord for r in substrings.repeats(df, 5, chunk).collect()) == [3, 3, 4, 5]


def test_prefixes_are_lengthened_by_suffixes(spark):
    # a prefix repeated very often inside two documents
    data = [(i, " ".join(f"p q r {j % 7} {j % 90} s" for j in range(600))) for i in (1, 2)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    counts = substrings.counted_prefixes(df, 13, 3).collect()
    assert max(r.n for r in counts) == 2 and sum(r.suffixes for r in counts) == 2 * (3600 - 12)
    large = substrings.bits_of(spark.createDataFrame([r for r in counts if r.suffixes > 40]).select("h"))
    more = substrings.counted_longer(df, large, 13, 3).where("suffixes > 40").select("h")
    both = substrings.bits_of(spark.createDataFrame([r for r in counts if r.suffixes > 40]).select("h").unionByName(more))
    docs = df.selectExpr("doc_id", "xxhash64(doc_id) as k1", "text")
    groups = substrings.suffixes(docs, large, both, 13, 3).where("words != ''").groupBy("key").agg(substrings.F.countDistinct("words").alias("w"), substrings.F.count("*").alias("n"))
    assert groups.where("n > 40 and w > 1").isEmpty() and not groups.where("w > 1").isEmpty()
    assert got(substrings.without_repeats(df, 13, 3, 40).selectExpr("row.doc_id", "n_words", "n_removed", "sha2(kept, 256) as kept_sha256")) == expected(data)
