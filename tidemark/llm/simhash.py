"""SimHash near-dedup with the generalised pigeonhole principle.

A document's fingerprint has a bit for each majority among the hashes of its
word shingles.  Fingerprints within ``max_bits`` differing bits are linked,
and documents are grouped by what links can reach.

Search runs over distinct fingerprints.  Bits that correlate (over a bounded
sample of fingerprints) are grouped into partitions; each gets a threshold, the
sum of ``threshold + 1`` being ``max_bits + 1``, so that a pair within
``max_bits`` is within the threshold of some partition.  Dynamic programming
picks the thresholds of least estimated candidates, for each number of
partitions up to ``max_bits + 1``, and so also their number.  A fingerprint
goes to the bucket of its value in each partition and probes the larger values
within the threshold; every pair that meets in a bucket is verified on all
bits.  The sample steers cost only: any partition and thresholds find every
link.

A bucket emits the links of a spanning forest, no more than it has members,
so a group of near copies doesn't give a row for each pair.  A bucket over
``tile`` members is cut into tiles, each pair of tiles being one task's group.

Defined cases: a null or empty text has fingerprint zero and links like any
other; fewer words than a shingle are one shingle; a null ``doc_id`` counts
as the largest, and a group of such ids alone has a null component; equal
rows are grouped, and one stays; an empty table gives an empty result; other
columns are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, column_bytes, in_arrow, longs, packed, row_key, small_batches, unpacked, written
from tidemark.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
BITS = 64
#: Fingerprints that the driver samples to estimate correlations and counts.
SAMPLE = 4096
#: Members of a bucket that one group compares with one another.
TILE = 4096
HASH_SEED = 42
#: Hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1]))[:len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist(), strict=True)]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        block = np.array(hashes[i:i + BLOCK], "<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(k1, k2, doc_id, fp)``; ``fp`` is the long of the same bits."""
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(x, shingle) for x in column_bytes(batch, "text")], np.uint64)
        return {c: column(batch, c) for c in ("k1", "k2", "doc_id")} | {"fp": found.view(np.int64)}

    cols = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_arrow(cols, run, "k1 long, k2 long, doc_id long, fp long")


# -- partitions and thresholds -------------------------------------------------

def grouped_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size: a group starts with the
    free bit of the strongest ties and takes the bit most tied to it."""
    planes = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    planes -= planes.mean(axis=0) if len(planes) else 0
    norm = np.sqrt((planes ** 2).sum(axis=0))
    norm[norm == 0] = 1
    ties = np.abs((planes / norm).T @ (planes / norm))
    np.fill_diagonal(ties, 0)
    free, groups = list(range(BITS)), []
    for p in range(parts):
        group = [max(free, key=lambda b: (ties[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < BITS // parts + (p < BITS % parts):
            best = max(free, key=lambda b: (ties[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def part_values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The value of each fingerprint in one group of bits."""
    out = np.zeros(len(fps), np.uint64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def thresholds(sample: np.ndarray, groups: list[list[int]], n: int, max_bits: int) -> tuple[float, list[int]]:
    """The least estimated work for ``n`` fingerprints, probes made and
    candidates met, and the thresholds of at least -1 (unused) with it."""
    cost = []
    for bits in groups:
        values = part_values(sample, bits)
        apart = np.bitwise_count(values[:, None] ^ values[None, :])[np.triu_indices(len(values), 1)]
        row = [0.0]
        for e in range(max_bits + 1):
            ball = sum(comb(len(bits), j) for j in range(e + 1))
            share = max(float((apart <= e).mean()) if len(apart) else 0.0, ball / 2.0 ** len(bits))
            row.append(n * (1 + ball / 2) + n * n / 2 * share)
        cost.append(row)
    # best[t]: least cost of the groups so far whose (threshold + 1) sum to t
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for t, (c, picks) in best.items():
            for e, more in enumerate(row):
                if t + e <= max_bits + 1 and (t + e not in step or c + more < step[t + e][0]):
                    step[t + e] = (c + more, [*picks, e - 1])
        best = step
    return best[max_bits + 1]


def planned(sample: np.ndarray, n: int, max_bits: int, parts: int | None = None) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and their thresholds, for ``parts`` groups or the number
    of least estimated work."""
    plans = []
    for count in range(min(2, max_bits + 1), max_bits + 2) if parts is None else [parts]:
        groups = grouped_bits(sample, count)
        plans.append((*thresholds(sample, groups, n, max_bits), groups))
    _, limits, groups = min(plans, key=lambda p: p[0])
    return groups, limits


# -- search --------------------------------------------------------------------

def bucketed(distinct: DataFrame, groups: list[list[int]], limits: list[int]) -> DataFrame:
    """``(part, value, fp)``: each fingerprint in its own bucket and in those
    of the larger values within the threshold."""
    flips = [[np.uint64(sum(1 << b for b in at)) for e in range(1, limit + 1) for at in combinations(range(len(bits)), e)]
             for bits, limit in zip(groups, limits, strict=True)]

    def run(batch: pa.RecordBatch) -> dict:
        fps = longs(batch, "fp").view(np.uint64)
        part, value, who = [], [], []
        for p, (bits, limit) in enumerate(zip(groups, limits, strict=True)):
            if limit < 0:
                continue
            own = part_values(fps, bits)
            for mask in [np.uint64(0), *flips[p]]:
                there = own ^ mask
                take = there >= own
                part.append(np.full(int(take.sum()), p, np.int32))
                value.append(there[take])
                who.append(fps[take])
        return {"part": np.concatenate(part), "value": np.concatenate(value).view(np.int64),
                "fp": np.concatenate(who).view(np.int64)}

    return in_arrow(distinct, run, "part int, value long, fp long")


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of one group that connect what its pairs within ``max_bits``
    connect: a star on each component."""
    rest, out = fps, []
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        front = [seed]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                out += [(int(seed), int(x)) for x in found]
                front += list(found)
    return out


def bucket_links(rows: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """``(u, v)`` from buckets; rows of a bucket meet in order in one task."""
    large = (rows.groupBy("part", "value").count().where(F.col("count") > tile)
             .select("part", "value", F.ceil(F.col("count") / tile).cast("int").alias("tiles")))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    cut = rows.join(large, ["part", "value"], "left")
    cut = cut.select("part", "value", "fp", F.explode(F.when(F.col("tiles").isNull(), F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))))
                     .otherwise(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                                            lambda t: F.struct(F.least(t, own).alias("a"), F.greatest(t, own).alias("b"))))).alias("x"))
    keys = ["part", "value", "a", "b"]
    cut = cut.select("part", "value", "x.a", "x.b", "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1
            edges = np.concatenate(([0], edges, [len(fps)]))
            size = np.diff(edges)
            two = edges[:-1][size == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
            more = [x for a, n in zip(edges[:-1][size > 2], size[size > 2], strict=True) for x in spanning_links(fps[a:a + n], max_bits)]
            more = np.array(more, np.uint64).reshape(-1, 2)
            u, v = (np.concatenate((fps[two + i], more[:, i])).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        key, fps = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate((key, np.stack([longs(batch, c).astype(np.int64) for c in keys], axis=1)))
            fps = np.concatenate((fps, longs(batch, "fp").view(np.uint64)))
            if len(key):
                last = int(np.flatnonzero((key == key[-1]).all(axis=1))[0])  # this group may go on
                if last:
                    yield found(key[:last], fps[:last])
                    key, fps = key[last:], fps[last:]
        if len(key):
            yield found(key, fps)

    return cut.mapInArrow(links, "u long, v long")


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Links that connect the distinct fingerprints ``fp`` as all pairs within
    ``max_bits`` would."""
    n = distinct.count()
    some = [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    sample = np.array(some, np.int64).view(np.uint64)
    groups, limits = planned(sample, n, max_bits, parts)
    return bucket_links(bucketed(distinct, groups, limits), max_bits, tile)


def grouped(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(k1, k2, doc_id, fp, root, component_id)`` for each document."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(near_links(distinct.select("fp"), max_bits))
    by_print = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
                .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    by_root = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    members = written(by_print.join(by_root, "root").select("fp", "root", "component_id"), "members")
    return prints.join(members, "fp").select("k1", "k2", "doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the document of the smallest id of each group."""
    found = grouped(docs, shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("doc_id"), "k1", "k2")
    keys = found.groupBy("root", "k1", "k2", "doc_id").agg(F.count("*").alias("n"))
    first = (keys.groupBy("root").agg(F.min_by(F.struct("k1", "k2", "n"), order).alias("x"))
             .select("x.k1", "x.k2", "x.n"))
    kept = packed(docs).join(first, ["k1", "k2"])
    alone = kept.where("n = 1")
    again = kept.where("n > 1").groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("row").alias("row"))
    return unpacked(alone.select("row", "text").union(again.select("row", "text")), docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    return grouped(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
