import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash
from tidemark.llm.components import components
from tests.llm.cases import documents, rows

LOWER = {i: i + 32 for i in range(65, 91)}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, max_bits=3):
    """The group of each fingerprint, by all pairs."""
    fps = list(dict.fromkeys(fps))
    arr, group = np.array(fps, np.uint64), dict(zip(fps, range(len(fps)), strict=True))
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= max_bits):
            a, b = group[f], group[fps[j]]
            if a != b:
                group = {k: min(a, b) if v in (a, b) else v for k, v in group.items()}
    return group


def test_query_against_all_pairs(spark):
    data = rows()
    group = roots([fingerprint(r[1]) for r in data])
    least = {}
    for r in data:
        if r[0] is not None:
            g = group[fingerprint(r[1])]
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted((repr(r[0]), f"{fingerprint(r[1]):016x}", least.get(group[fingerprint(r[1])])) for r in data)
    got = sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in simhash.digest(documents(spark)).collect())
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB é\n", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == fingerprint(text)


def near_fingerprints(n, seed):
    """Chains and clouds of fingerprints, and fingerprints far from all."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 40])):
            out.add(at)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                at ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("parts,tile", [(2, 4096), (3, 4096), (3, 4), (4, 4096)])
def test_links_connect_what_all_pairs_connect(spark, parts, tile):
    fps = near_fingerprints(400, parts)
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long") if hasattr(simhash, "signed") else spark.createDataFrame(
        [(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.near_links(df, parts=parts, tile=tile)
    found = {r.node % (1 << 64): r.root for r in components(links).collect()}
    want = roots(fps)
    by_root = {}
    for f in fps:
        by_root.setdefault(found.get(f, ("alone", f)), set()).add(f)
    by_group = {}
    for f in fps:
        by_group.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_group.values()))


def test_a_group_of_copies_gives_no_quadratic_rows(spark):
    base = random.Random(1).getrandbits(63)
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(a)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    n = simhash.near_links(df).count()
    assert n <= 40 * len(fps)


def test_thresholds_keep_the_pigeonhole_sum():
    sample = np.random.default_rng(0).integers(0, 2**63, 500).astype(np.uint64)
    for parts in (2, 3, 4):
        groups = simhash.grouped_bits(sample, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        _, limits = simhash.thresholds(sample, groups, 10_000, 3)
        assert sum(x + 1 for x in limits) == 4 and min(limits) >= -1


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 2**63, 2000).astype(np.uint64) & ~np.uint64(0b111 << 10)
    same = rng.integers(0, 2, 2000).astype(np.uint64)
    sample |= (same << np.uint64(10)) | (same << np.uint64(11)) | (same << np.uint64(12))
    groups = simhash.grouped_bits(sample, 3)
    assert any({10, 11, 12} <= set(g) for g in groups)


def test_one_document_of_each_group_stays(spark):
    data = rows()
    group = roots([fingerprint(r[1]) for r in data])
    kept = simhash.one_of_each(documents(spark)).collect()
    assert len(kept) == len(set(group.values()))
    best = {}
    for r in data:
        g = group[fingerprint(r[1])]
        best[g] = min(best.get(g, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(best.values())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40))
def test_components(spark, pairs):
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    least = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in least:
        for u, v in pairs:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    assert got == least


def test_the_number_of_parts_has_the_least_estimated_work():
    rng = np.random.default_rng(4)
    sample = rng.integers(0, 1 << 63, 600, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 600, dtype=np.uint64)
    picked = []
    for n in (1_000, 200_000, 10 ** 10):
        groups, limits = simhash.planned(sample, n, 3)
        work = {p: simhash.thresholds(sample, simhash.grouped_bits(sample, p), n, 3)[0] for p in (2, 3, 4)}
        assert sum(e + 1 for e in limits) == 4 and sorted(b for g in groups for b in g) == list(range(64))
        assert work[len(groups)] == min(work.values())
        picked.append(len(groups))
    assert picked[0] > picked[-1]      # more fingerprints, fewer and longer parts
