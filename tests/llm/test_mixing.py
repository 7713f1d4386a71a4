import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tests.llm.cases import documents, rows


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by dealing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, active = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and active:
        total = sum(weight[s] for s in active)
        step = {s: left * weight[s] / total for s in active}
        left = 0.0
        for s, more in step.items():
            target[s] += more
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                active.discard(s)
    return target


def test_targets_and_taken_words(spark):
    sizes, by_source = {}, defaultdict(int)
    for _, text, _, source, _ in rows():
        by_source[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = filled(by_source)
    got = documents(spark)
    out = mixing.digest(got).collect()
    source_of = {(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))): r[3] for r in rows()}
    taken = Counter()
    for r in out:
        source = source_of[r.doc_id, r["size"]]
        assert r.source_size == by_source[source]
        assert math.isclose(r.target, want[source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1, s


def test_runs_agree_and_shards_hold_disjoint_blocks(spark):
    docs = documents(spark)
    places, parts = mixing.mix(docs, block_words=16, shards=8)
    _, again = mixing.mix(docs.repartition(5), block_words=16, shards=8)
    key = ["s", "bucket", "rn", "epoch", "from_word", "words", "shard", "position"]
    assert parts.select(*key).exceptAll(again.select(*key)).count() == 0
    blocks = parts.groupBy("s", "shard", "position").agg(F.sum("words").alias("n"))
    assert blocks.where("n > 16").count() == 0
    assert parts.groupBy("s", "position").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    size = [r.n for r in blocks.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(size) == 8 and max(size) - min(size) <= 3  # halves at each level
    # a document's parts of one epoch neither overlap nor leave a gap
    for r in parts.groupBy("s", "bucket", "rn", "epoch").agg(F.sum("words").alias("n"), F.min("from_word").alias("a"), F.max(F.col("from_word") + F.col("words")).alias("b")).collect():
        assert r.n == r.b - r.a and r.a == 0


def test_hypergeometric_draws_follow_the_distribution(spark):
    own, others, take = 30, 50, 40
    draw = mixing._draw(f"{own}L", f"{others}L", f"{take}L", "u")
    got = Counter(r.k for r in spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u")).select(F.expr(draw).alias("k")).collect())
    for k in range(take + 1):
        p = math.comb(own, k) * math.comb(others, take - k) / math.comb(own + others, take) if k <= own and take - k <= others else 0
        assert abs(got[k] / 4000 - p) < 1e-3, k


@pytest.mark.parametrize("own,others,take", [(0, 5, 3), (5, 0, 3), (5, 5, 0), (5, 5, 10), (0, 0, 0)])
def test_draws_at_the_edges(spark, own, others, take):
    draw = mixing._draw(f"{own}L", f"{others}L", f"{take}L", "0.5D")
    k = spark.range(1).select(F.expr(draw).alias("k")).first().k
    assert max(0, take - others) <= k <= min(own, take)


def test_quotas_are_exact(spark):
    sources = spark.createDataFrame([(0, 50_000.0), (1, 2_000.0), (2, 0.0)], "s int, target double")
    leaves = mixing.quotas(sources, 100, 16, 1).collect()
    assert len(leaves) == 16
    assert [sum(r.quota[s] for r in leaves) for s in range(3)] == [500, 20, 0]
    assert all(min(r.quota) >= 0 for r in leaves)
