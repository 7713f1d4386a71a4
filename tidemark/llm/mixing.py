"""Mixing sources to target weights by a splitting tree of block quotas.

Each source is a stream of its words: its documents in an order fixed by a
hash of their id, passed once or twice.  The mix takes the first ``target``
words of each stream, cut into blocks of ``block_words`` words.

Output shards get their blocks by a splitting tree.  The root holds the exact
number of blocks of every source; a node splits its blocks between its two
children by a multivariate hypergeometric draw, source by source, as a random
deal of all its blocks would; a leaf is a shard with exact quotas by source.
The shards draw disjoint ranges of each source's permuted blocks and order
what they drew by a hash.

Everything is DataFrame code: sums of document sizes within buckets of the
hash order (a hot source spreads over ``BUCKETS`` of them), a table of one row
per source, a table of tree nodes, and one equality join from document slices
to blocks, each block being one key.

Defined cases: a null text has no words and is never taken; a null source is
a source of its own, after all others; a null ``doc_id`` sorts as its hash;
equal rows are separate documents; a source without words has target 0; an
empty table gives an empty mix; other columns are not read.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Weights of the sources by code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 2048
SHARDS = 64
#: Buckets of the hash order within a source: 16 to the power 3.
BUCKET_DIGITS = 3
#: Primes of the block permutation; the first that doesn't divide the number
#: of blocks is used, and their product exceeds any number of blocks.
PRIMES = (1_000_000_007, 998_244_353)
SEED = 7
#: Nodes of the splitting tree from which on tasks share them.
SPREAD = 16

_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, h)``; ``h`` fixes the order in a source."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       n_words(F.col("text")).alias("size"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")).alias("h"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(s, source, source_size, target)``, ``s`` numbering the sources.

    ``share`` of all words is dealt by weight; a source stops at ``most`` times
    its size and what it leaves goes to the others by weight.  That ends where
    each source has ``min(cap, level * weight)``: in the order of
    ``cap / weight``, the level follows from the sums over the sources that
    are full.  One row a source is all that the windows see.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("full_at", "s")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.array(*[F.lit(float(x)) for x in weights])
    got = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("s", F.row_number().over(order).cast("int") - 1)
           .withColumn("w", F.get(w, F.col("s") % len(weights)))
           .withColumn("cap", most * F.col("source_size"))
           .withColumn("full_at", F.col("cap") / F.col("w"))
           .withColumn("left", F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("w_left"))
           .withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(whole)))
    target = F.least(F.col("cap"), F.coalesce(F.col("level"), F.col("full_at")) * F.col("w"))
    return got.select("s", "source", "source_size", target.alias("target"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document with its ``start`` in its source's stream and a number
    ``(s, bucket, rn)`` of its own.  Prefix sums run within buckets of the
    hash order, then over the bucket totals."""
    docs = (sizes.join(sources, sizes["source"].eqNullSafe(sources["source"]))
            .select("s", sizes["source"], "doc_id", "size", "h", "source_size", "target",
                    F.substring("h", 1, BUCKET_DIGITS).alias("bucket")))
    inside = Window.partitionBy("s", "bucket").orderBy("h", "doc_id", "size")
    docs = (docs.withColumn("rn", F.row_number().over(inside))
            .withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")))
    totals = docs.groupBy("s", "bucket").agg(F.sum("size").alias("total"))
    along = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("s", "bucket", F.coalesce(F.sum("total").over(along), F.lit(0)).alias("base"))
    return docs.join(bases, ["s", "bucket"]).withColumn("start", F.col("start") + F.col("base")).drop("base")


# -- hypergeometric draws in SQL ----------------------------------------------

def _log_factorial(x: str) -> str:
    """Stirling's series at x + 8, taken back by the product below it; exact
    to about 1e-12."""
    z = f"({x} + 8.0D)"
    below = " * ".join(f"({x} + {i}.0D)" for i in range(1, 8))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1 / (12 * {z}) - 1 / (360 * pow({z}, 3))"
            f" + 1 / (1260 * pow({z}, 5)) - ln({below}))")


def _log_choose(n: str, k: str) -> str:
    return f"({_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')})"


def _draw(own: str, others: str, take: str, u: str) -> str:
    """SQL: how many of ``take`` draws without replacement come from ``own``
    blocks rather than ``others``, by the inverse of the distribution at ``u``.

    Terms are summed within 12 deviations of the mean.  What lies outside has
    a probability below 1e-30, which a double can't add to the sum of 1.
    """
    all_ = f"double({own} + {others})"
    mean = f"({take} * {own} / greatest({all_}, 1D))"
    deviation = f"sqrt({mean} * (1 - {own} / greatest({all_}, 1D)) * (1 - {take} / greatest({all_}, 1D)) * {all_} / greatest({all_} - 1, 1D))"
    low = f"greatest(0L, {take} - {others}, bigint(floor({mean} - 12 * {deviation})) - 12)"
    high = f"least({own}, {take}, bigint(ceil({mean} + 12 * {deviation})) + 12)"
    log_p = f"{_log_choose(f'double({own})', 'double(k)')} + {_log_choose(f'double({others})', f'double({take} - k)')}"
    logs = f"transform(sequence({low}, {high}), k -> struct(k AS k, {log_p} AS p))"
    # shares of the largest term, then the first k whose running sum reaches u
    return (f"aggregate(array({logs}), 0L, (z, v) -> aggregate(array(array_max(transform(v, t -> t.p))), 0L, (z2, top) -> "
            f"aggregate(v, struct(0.0D AS run, {low} AS k, false AS over, {u} * aggregate(v, 0.0D, (a, t) -> a + exp(t.p - top)) AS goal), "
            f"(a, t) -> struct(a.run + exp(t.p - top) AS run, if(a.over, a.k, t.k) AS k, a.over OR a.run + exp(t.p - top) >= a.goal AS over, a.goal AS goal), "
            f"a -> a.k)))")


def quotas(sources: DataFrame, block_words: int, shards: int, seed: int) -> DataFrame:
    """The leaves of the splitting tree: ``(shard, quota)``, an array with the
    blocks of each source by ``s``.  ``shards`` is a power of two."""
    blocks = F.ceil(F.floor(F.col("target")) / F.lit(block_words)).cast("long")
    nodes = (sources.select(F.struct("s", blocks.alias("n")).alias("x")).agg(F.sort_array(F.collect_list("x")).alias("x"))
             .select(F.lit(0).cast("long").alias("shard"), F.col("x.n").alias("quota")))
    for level in range(int(log2(shards))):
        if 1 << level == SPREAD:
            nodes = nodes.repartition(SPREAD, "shard")
        uniform = f"(pmod(xxhash64({seed}, {level}, shard, s), 9007199254740992) + 0.5D) / 9007199254740992"
        # source by source: what is left of the node's blocks and of the left child's half
        split = (f"aggregate(sequence(0, size(quota) - 1), named_struct('rest', all, 'take', half, 'got', slice(quota, 1, 0)), (a, s) -> "
                 f"aggregate(array({_draw('quota[s]', '(a.rest - quota[s])', 'a.take', uniform)}), a, (b, n) -> "
                 f"named_struct('rest', a.rest - quota[s], 'take', a.take - n, 'got', concat(a.got, array(n)))), a -> a.got)")
        nodes = (nodes.withColumn("all", F.expr("aggregate(quota, 0L, (a, n) -> a + n)"))
                 .withColumn("half", F.expr("all div 2 + if(all % 2 = 1, pmod(shard, 2), 0L)"))
                 .withColumn("left", F.expr(f"if(size(quota) = 0, quota, {split})"))
                 .select("shard", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("quota")),
                                                    F.struct(F.lit(1).alias("side"),
                                                             F.zip_with("quota", "left", lambda a, b: a - b).alias("quota")))).alias("to"))
                 .select((F.col("shard") * 2 + F.col("to.side")).alias("shard"), "to.quota"))
    return nodes


def dealt(leaves: DataFrame) -> DataFrame:
    """``(s, at, shard)``: the permuted blocks of each source that each shard
    draws, by disjoint ranges."""
    each = leaves.select("shard", F.posexplode("quota").alias("s", "n"))
    along = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum("n").over(along)).where("n > 0")
    return each.select("s", "shard", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("at"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents and the mix.

    Documents: ``(s, bucket, rn, doc_id, source, size, source_size, target,
    start)``.  Mix: a row for each part of a document that a block holds,
    ``(s, bucket, rn, epoch, from_word, words, shard, position)``; ``position``
    orders the blocks of a shard.  ``shards`` is rounded up to a power of two.
    """
    sizes = written(sized(docs), "sizes")
    sources = written(targets(sizes, weights, share, most), "sources")
    places = placed(sizes, sources)
    leaves = quotas(sources, block_words, 2 ** ceil(log2(max(1, shards))), seed)
    return places, slices(places, dealt(leaves), block_words, most, seed)


def slices(places: DataFrame, deal: DataFrame, block_words: int, most: float, seed: int) -> DataFrame:
    limit = F.floor(F.col("target")).cast("long")
    blocks = F.ceil(limit / F.lit(block_words)).cast("long")
    prime = F.when(F.col("blocks") % PRIMES[0] != 0, F.lit(PRIMES[0])).otherwise(F.lit(PRIMES[1])).cast("long")
    whole = (places.where("size > 0").withColumn("limit", limit).withColumn("blocks", blocks)
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max(0, ceil(most) - 1)))))
             .withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size"))
             .withColumn("to", F.least(F.col("from") + F.col("size"), F.col("limit")))
             .where(F.col("from") < F.col("to"))
             .withColumn("block", F.explode(F.sequence(F.expr(f"from div {block_words}"), F.expr(f"(to - 1) div {block_words}"))))
             .withColumn("at", (F.col("block") * prime + F.lit(seed)) % F.col("blocks"))
             .withColumn("begin", F.greatest(F.col("from"), F.col("block") * block_words))
             .withColumn("words", F.least(F.col("to"), (F.col("block") + 1) * block_words) - F.col("begin")))
    # one row a block, which grows with the words: never broadcast
    out = whole.join(deal.hint("merge"), ["s", "at"])
    local = F.xxhash64(F.lit(seed), "shard", "s", "block")
    return out.select("s", "bucket", "rn", "epoch", (F.col("begin") - F.col("from")).alias("from_word"), "words", "shard",
                      local.alias("position"), (F.col("begin") - F.col("block") * block_words).alias("offset"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    places, parts = mix(docs)
    per = parts.groupBy("s", "bucket", "rn").agg(F.sum("words").alias("taken"))
    return (places.join(per, ["s", "bucket", "rn"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
g AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS s
  FROM d GROUP BY source),
f AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, CAST(2 * source_size AS DOUBLE) / CAST(w AS DOUBLE) AS full_at FROM g),
v AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(CAST(sum(2 * source_size) OVER (ORDER BY full_at, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
         / CAST(sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY full_at, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM f),
t AS (
  SELECT source, source_size,
         least(cap, (SELECT max(level) FROM v WHERE level <= full_at) * CAST(w AS DOUBLE)) AS target FROM v),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(start + size, floor(target)) - start)
            + greatest(0, least(start + source_size + size, floor(target)) - start - source_size) AS BIGINT) AS taken
FROM p
"""
