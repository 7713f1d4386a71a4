"""Token alignment against whole-text encoding, byte by byte."""

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.cases import SF, clashing, collected, documents, empty, sentence
from tidemark.llm import tokenalign

ODD = [None, "", " ", "a", "  two  spaces ", "\n\nlines \n of\ttabs\r\n", "▁ piece space", "a ▁b", "<0x41> <s> </s> <unk> <|endoftext|>",
       "日本語 ﬁ ½ é é   x　y", "don't we'll 12345 6789 x=1;y=2", "​zero ﻿bom", "emoji 👩‍👩‍👧 🏳️‍🌈 end", "a\x00b", "\x85 \x1c \x1f q", "x" * 3000,
       "trailing ", "▁", "tab\t x", "…", "a" * 50 + " " * 40 + "b", "Ω≈ç√∫˜µ≤≥÷ åß∂ƒ©˙∆˚¬"]


def whole(texts):
    """Tokens and byte ends of whole texts, from the vocabulary files as they are given."""
    a = Tokenizer.from_file(f"{tokenalign.TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{tokenalign.TOKENIZERS}/piece_bpe_32k.model")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in printable)}
    out = []
    for t in texts:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        by_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        by_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not t or b"".join(by_a) != (" " + t).encode() or b"".join(by_b) != (" " + t).encode():
            ids_a = ids_b = by_a = by_b = []
        out.append((ids_a, np.cumsum([len(x) for x in by_a]).tolist(), ids_b, np.cumsum([len(x) for x in by_b]).tolist()))
    return out


def by_hand(texts):
    """The digest's columns: links from the bytes that tokens share."""
    docs = whole(texts)
    links = []
    for ids_a, ends_a, ids_b, ends_b in docs:
        owner_a = np.repeat(np.arange(len(ids_a)), np.diff([0, *ends_a]))
        owner_b = np.repeat(np.arange(len(ids_b)), np.diff([0, *ends_b]))
        links.append([(ids_a[i], ids_b[j]) for i, j in dict.fromkeys(zip(owner_a.tolist(), owner_b.tolist(), strict=True))])
    count = Counter(p for ps in links for p in ps)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (ids_a, ends_a, ids_b, ends_b), ps in zip(docs, links, strict=True):
        cuts = sorted(set(ends_a) & set(ends_b))
        text = ";".join(",".join(str(i) for i, e in zip(ids_a, ends_a, strict=True) if lo < e <= hi) + "|" + ",".join(str(i) for i, e in zip(ids_b, ends_b, strict=True) if lo < e <= hi)
                        for lo, hi in zip([0, *cuts], cuts, strict=False))
        out.append((len(ids_a), len(ids_b), len(cuts), len(ps), sum(count[p] == best[p[1]] for p in ps), sum(count[p] for p in ps),
                    sha256(text.encode()).hexdigest() if text else ""))
    return out


def asked(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r)[1:] for r in tokenalign.aligned(docs, **options).select("doc_id", *cols).orderBy("doc_id").collect()]


def test_odd_texts(spark):
    assert asked(spark, ODD) == by_hand(ODD)
    assert sum(r[0] == 0 for r in by_hand(ODD)) < len(ODD) // 2


def test_given_documents_with_both_ways_of_counting(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    texts = [t and t[:4000] for t in texts]
    want = by_hand(texts)
    assert asked(spark, texts) == want
    assert asked(spark, texts, most_pairs=0) == want


@pytest.mark.parametrize("seed", range(3))
def test_lanes_of_any_tokens(seed):
    """Lockstep against all pairs of ranges, with empty lanes among others."""
    rng = np.random.default_rng(seed)
    lanes = []
    for _ in range(40):
        total = int(rng.integers(0, 40))
        cut = lambda: np.diff([0, *sorted(rng.choice(np.arange(1, total), int(rng.integers(0, total)), replace=False)), total]) if total > 1 else np.array([total] * (total > 0), int)
        lanes.append((cut(), cut()))
    flat = lambda k: (np.concatenate([x[k] for x in lanes]).astype(np.int64), np.concatenate(([0], np.cumsum([len(x[k]) for x in lanes]))))
    (size_a, at_a), (size_b, at_b) = flat(0), flat(1)
    lane, i, j, cut = tokenalign.lockstep(size_a, at_a, size_b, at_b)
    want = []
    for n, (a, b) in enumerate(lanes):
        ea, eb = np.cumsum(a), np.cumsum(b)
        want += [(n, x + at_a[n], y + at_b[n], ea[x] == eb[y]) for x in range(len(a)) for y in range(len(b)) if max(ea[x] - a[x], eb[y] - b[y]) < min(ea[x], eb[y])]
    assert list(zip(lane.tolist(), i.tolist(), j.tolist(), cut.tolist(), strict=True)) == [tuple(map(int, w[:3])) + (bool(w[3]),) for w in want]


def test_a_worker_begins_anew(spark, monkeypatch):
    rng = __import__("random").Random(1)
    texts = [sentence(rng, 30) for _ in range(20)]
    monkeypatch.setattr(tokenalign, "CACHE", 100)
    batch = [tokenalign.Batch([t, None, ""], tokenalign.TOKENIZERS) for t in texts]
    one = tokenalign.Batch(texts, tokenalign.TOKENIZERS)
    assert [b.sums(b.pieces.shape[:, 3])[0] for b in batch] == one.sums(one.pieces.shape[:, 3]).tolist()


def test_groups_are_the_operators_own_output(spark):
    docs = documents(spark)
    found = {r.doc_id: r for r in tokenalign.groups(docs).where("doc_id is not null").collect()}
    digests = {r.doc_id: r for r in tokenalign.digest(docs).where("doc_id is not null").collect()}
    for i, r in found.items():
        assert digests[i].groups_sha256 == (sha256(r.groups.encode()).hexdigest() if r.groups else "")
        assert r.groups.count(";") + bool(r.groups) == r.n_groups
    assert found[100].groups == "" and found[101].groups == ""


def test_edges(spark):
    docs = documents(spark)
    plain = collected(tokenalign.digest(docs))
    assert len(plain) == docs.count()
    assert collected(tokenalign.digest(clashing(docs))) == plain
    assert tokenalign.digest(empty(spark)).collect() == []
    nulls = docs.withColumn("text", docs.text.substr(1, 0)).unionByName(docs.selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars"))
    assert tokenalign.digest(nulls).agg({"n_a": "sum", "count_sum": "sum"}).first()[0] == 0
