import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import topk


def brute(rows, k=20, every=20):
    ok = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows
          if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = set()
    for q, a in ok:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(found, 1)}
    return out


def vectors(seed, n, dim=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[n // 3:n // 2] = x[0]  # many equal vectors, so ties
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(None, rows[1][1]), (1000, None), (1020, []), (1040, [float("nan")] * dim), (1060, [None] * dim), (1080, [float("inf")] + [0.0] * (dim - 1)),
             (1100, [0.5] * (dim + 1)), (1120, [0.0] * dim), (1140, [1.0])]
    return rows


@pytest.mark.parametrize("seed,qb,block", [(1, 1024, 8192), (2, 3, 16)])
def test_against_brute_force(spark, seed, qb, block):
    rows = vectors(seed, 150)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, query_block=qb, block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_repeated_rows_and_clashing_columns(spark):
    rows = vectors(3, 60)
    df = spark.createDataFrame(rows + [rows[20], rows[7]], "vec_id long, embedding array<float>")
    got = topk.digest(df.selectExpr("*", "1 as v", "2 as dim", "3 as rank", "4 as query_id")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, topk.digest(df).collect()))
    assert max(r.rank for r in got if r.query_id == 20) == 20


def test_copies_of_a_row_are_searched_once(spark):
    rows = vectors(4, 60)
    rows += [rows[7]] * 90 + [rows[9]] * 3 + [(7, rows[9][1])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    copies = [(r.vec_id, r.copies) for r in topk.counted(topk.quantised(df)).collect()]
    assert sorted(c for c in copies if c[0] in (7, 9)) == [(7, 2), (7, 20), (9, 4)] and len(copies) == 64
    got = [tuple(r) for r in topk.top_k(df, query_block=3, block=16).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.digest(df).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 9), st.integers(1, 40))
def test_bounds_never_lie_below_a_score(seed, dim, n):
    rng = np.random.default_rng(seed)
    x, q = rng.integers(-300, 300, (n, dim)), rng.integers(-300, 300, (3, dim))
    of_q, of_x = (topk.Segments(v, topk.RESOLUTIONS) for v in (q, x))
    last = None
    for level in range(len(topk.RESOLUTIONS)):
        bound = topk.score_bounds(of_q, of_x, level)
        assert (bound >= q @ x.T).all()
        last = bound
    assert last is not None
