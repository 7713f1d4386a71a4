import random

import numpy as np
import pytest

from tidemark.llm import decontaminate as dc
from tests.llm.cases import SF, sentence


def distance(pattern, text):
    """Least edits that make some part of ``text`` the pattern."""
    row = np.zeros(len(text) + 1, np.int64)
    t = np.frombuffer(text, np.uint8)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (t != c), row[1:] + 1)
        steps = np.arange(len(row))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def edited(rng, text, n):
    out = bytearray(text)
    for _ in range(n):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = rng.choice(b"xyz")
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, rng.choice(b"xyz"))
    return bytes(out)


def best_of(seen, passages):
    """The least edits of any part of each item."""
    out = {}
    for p, edits in seen.items():
        out[passages.ids[p]] = min(edits, out.get(passages.ids[p], edits))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_found_equals_full_alignment(seed):
    """Brute force by the one rule: some part of the item, anywhere in the text."""
    rng = random.Random(seed)
    items = [dc.normalised(sentence(rng, rng.choice([3, 9, 20, 30, 60, 150])).encode()) for _ in range(12)]
    passages = dc.Passages(list(enumerate(items)))
    texts = []
    for i in range(40):
        text = sentence(rng, rng.randint(0, 60)).encode()
        if i % 2:
            item = rng.choice(items)
            # whole, or a piece of it
            a = rng.choice([0, rng.randrange(max(1, len(item) // 2))])
            item = item[a:a + rng.choice([len(item), dc.PART, dc.PART + dc.STEP, dc.PART // 2])] or item
            k = max(1, int(len(item) * dc.EDITS))
            text += b" " + edited(rng, item, rng.randint(0, 2 * k)) + b" " + sentence(rng, 20).encode()
        texts.append(text)
    found = passages.found(texts)
    for text, seen in zip(texts, found, strict=True):
        clean = dc.normalised(text)
        want = {}
        for p, part in enumerate(passages.texts):
            least = distance(part, clean)
            if least <= passages.k[p]:
                want[p] = least
        assert seen == want
    assert any(best_of(seen, passages) for seen in found)


def test_chunks_and_long_texts(monkeypatch):
    rng = random.Random(9)
    item = dc.normalised(sentence(rng, 30).encode())
    passages = dc.Passages([(1, item)])
    monkeypatch.setattr(dc, "CHUNK", 700)
    for at in (0, 95, 100, 103, 400):
        text = sentence(rng, at).encode() + b" " + item + b" " + sentence(rng, 500).encode()
        assert passages.found([b"x", text, b""]) == [{}, dict.fromkeys(range(len(passages.texts)), 0), {}]


@pytest.mark.parametrize("words", [59, 150, 900])
def test_items_of_any_size_are_found_by_a_part(words):
    """76 % of a short item is found like a part of a long one, and less than a part of neither."""
    rng = random.Random(words)
    item = dc.normalised(sentence(rng, words).encode())
    passages = dc.Passages([(7, item)])
    assert set(passages.ids) == {7} and all(len(t) == dc.PART for t in passages.texts)
    for a in range(0, len(item) - dc.PART - dc.STEP, 37):
        assert passages.found([b"before " + item[a:a + dc.PART + dc.STEP] + b" after"])[0]
    assert not passages.found([b"before " + item[10:10 + dc.PART // 2] + b" after"])[0]
    leaked = b" ".join(item.split()[:words * 76 // 100])
    assert passages.found([b"x " + leaked + b" y"])[0]


def test_items_shorter_than_a_gram_are_looked_for_as_they_are(spark):
    docs = spark.createDataFrame([(1, "here is Short\n x"), (2, "shorter"), (3, None), (4, "short"), (5, "a  b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, ""), (2, " \n "), (3, "short"), (4, "A b"), (None, None)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.edits) for r in dc.digest(docs, items).collect()) == [(1, 3, 0), (4, 3, 0), (5, 4, 0)]
    assert {r.doc_id for r in dc.clean(docs, items).collect()} == {2, 3}


def test_a_full_block_is_under_300_mb():
    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz     ", np.uint8)
    items = [(i, rng.choice(letters, 1 << 16).tobytes()) for i in range(32)]      # an eighth of a block
    passages = dc.Passages(items)
    full = dc.MOST_BYTES // (32 << 16)
    import pickle
    assert full * len(pickle.dumps(passages, protocol=5)) < 300 << 20
    assert full * passages.nbytes() < 300 << 20


def test_query_finds_whole_items_and_leaves_others(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    norm = [(r.item_id, dc.normalised(r.text.encode())) for r in items.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in norm if t in dc.normalised((r.text or "").encode())}
    got = dc.digest(docs, items).collect()
    assert want and {(r.doc_id, r.item_id) for r in got if r.edits == 0} == want
    dirty = {r.doc_id for r in got}
    kept = {r.doc_id for r in dc.clean(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} - dirty


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, dc.digest(docs, items).collect()))
    monkeypatch.setattr(dc.blocks, "__defaults__", (3000,))
    assert len(list(dc.blocks(items))) > 1
    assert sorted(map(tuple, dc.digest(docs, items).collect())) == want
