import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import lines
from tests.llm.cases import documents, rows

LOWER = {i: i + 32 for i in range(65, 91)}


def key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(LOWER)


def expected(texts, min_docs=10):
    split = [(t or "").split("\n") for t in texts]
    count = Counter(k for ls in split for k in {key(x) for x in ls} if k)
    out = []
    for ls in split:
        kept = [x for x in ls if count[key(x)] < min_docs or not key(x)]
        out.append((len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_against_brute_force(spark):
    want = sorted(expected([r[1] for r in rows()]))
    got = sorted((r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.digest(documents(spark)).collect())
    assert got == want
    assert any(n for _, n, _ in got)


def state_of(state):
    return sorted((r.hi, r.lo, r.n) for r in state.refs.collect())


def kept_of(state, docs):
    return sorted((r.row.doc_id is None, r.row.doc_id or 0, r.kept) for r in state.clean(docs).collect())


def test_insertions_and_deletions_are_reversible(spark):
    docs = documents(spark)
    a, b = docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 = 0")
    one = lines.LineState.empty(spark, min_docs=14, shards=4).insert(a)
    both = one.insert(b)
    back = both.delete(b)
    assert state_of(back) == state_of(one)
    assert kept_of(back, a) == kept_of(one, a)
    assert kept_of(both, a) != kept_of(one, a)  # the line is frequent with both only
    assert state_of(both) == state_of(lines.LineState.empty(spark, min_docs=14, shards=4).insert(docs.where("doc_id is not null")))
    assert state_of(both.delete(docs.where("doc_id is not null"))) == []


def test_deleting_an_unknown_document_fails(spark):
    docs = documents(spark)
    state = lines.LineState.empty(spark, shards=4).insert(docs.where("doc_id < 5"))
    with pytest.raises(Exception, match="never inserted"):
        state.delete(docs.where("doc_id = 7"))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), unique=True, max_size=200), st.data())
def test_cuckoo_filter_has_no_false_negatives(keys, data):
    rng = np.random.default_rng(1)
    lo = rng.integers(-2**62, 2**62, len(keys))
    hi = np.array(keys, np.int64)
    table = lines.built(hi, lo)
    assert not len(hi) or table.holds(hi, lo).all()
    gone = data.draw(st.sets(st.integers(0, len(keys) - 1))) if keys else set()
    for i in gone:
        assert table.delete(hi[i], lo[i])
    rest = [i for i in range(len(keys)) if i not in gone]
    assert not rest or table.holds(hi[rest], lo[rest]).all()
    again = lines.CuckooFilter.loaded(table.dumped())
    assert not rest or again.holds(hi[rest], lo[rest]).all()


def test_cuckoo_filter_rejects_most_others():
    rng = np.random.default_rng(2)
    hi, lo = rng.integers(-2**62, 2**62, (2, 5000))
    table = lines.built(hi[:2000], lo[:2000])
    assert table.holds(hi[2000:], lo[2000:]).mean() < 0.01
