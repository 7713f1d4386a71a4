"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles.  Two documents link where
``100 * |A and B| >= percent * |A or B|``, that is, where their symmetric
difference has at most ``(|A| + |B|) * (100 - percent) / (100 + percent)``
shingles, and documents are grouped by what links can reach.

Sketches: shingles are XORed.  A shingle flips one bit of a sketch of ``BITS``
bits, so the Hamming distance of two sketches is at most the symmetric
difference of their sets.  For the search a set is cut into parts by its
shingles' hashes, and each part has the XOR of its shingles' 64-bit codes as
its *word*: a shingle changes one word, so the words that differ are no more
than the symmetric difference either.

Pigeonhole, per size band (sizes from a power of two to the next): a band has
``parts`` parts, more than the largest difference ``d`` allowed in it.  Two
linked sets agree in ``parts - d`` words at least, and so share one of the
``d + 1`` rarest words of either.  Sets also visit the band below, where
partners of smaller size are.  Words are counted over all documents:

* a word that no other set has is one of the ``d + 1`` but finds nobody; most
  sets have more than ``d`` of them and are done;
* the others go to the buckets of their rarest repeated words, so a passage
  that very many documents share is no bucket of its own unless a document
  holds little else.

Verification: sets of a bucket are not paired with one another.  Each is first
compared with the bucket's member that has the fewest words of its own (the
text that the others vary), two rounds, between sets that no link connects yet.
What is still apart meets in tiles of ``TILE`` members, which send on only
pairs whose sizes and sketches allow a link.  Every such pair is verified on its
shingles, 64-bit hashes of words' 64-bit hashes.  Copies are one set from the
start, known by 128 bits.

A key is only as long as the number of words needs (``KEY_BITS`` beyond its
logarithm); words that share a key are counted together, which costs work and
loses no link.  A table of bits names the sets of buckets to the tasks that
read their shingles anew: 16 bits for each such set, ``MOST_BITS`` at most, and
a shared bit sends a set in vain.  A key has one row for each set at most, and a
set has a key for about every second shingle, so counting them is no skewed
group; buckets are joined, not collected.

Defined cases: a text without words, null or empty, has an empty set and links
with nothing; fewer words than a shingle are one shingle; a null ``doc_id``
counts as the largest, and a group of such ids alone has a null component; equal
rows link; an empty table gives an empty result; other columns are carried
unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, column_bytes, in_arrow, longs, row_key, small_batches, written
from tidemark.llm.components import components
from tidemark.llm.substrings import bits_of, mixed, rolling

SHINGLE_WORDS, PERCENT = 5, 80
#: Bits of a sketch, parts for each difference, parts at least, bits of a key beyond its need, members of a tile.
BITS, SLACK, LEAST_PARTS, KEY_BITS, TILE = 2048, 1.25, 16, 6, 512
#: Rounds in which sets meet their buckets' centres.
ROUNDS = 2

_ODD = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


class Shingles:
    """The sets of a batch of texts: ``doc`` and ``h`` of each distinct
    shingle, in the order of documents and hashes; ``size`` of each set."""

    def __init__(self, texts: list[bytes], shingle: int = SHINGLE_WORDS):
        split = [t.lower().split() for t in texts]
        count = np.array([len(w) for w in split], np.int64)
        begin = np.cumsum(count) - count
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, (w for ws in split for w in ws)), np.uint64, int(count.sum()))
        room = np.maximum(count - shingle + 1, 0)
        doc = np.repeat(np.arange(len(texts)), room)
        at = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room) + begin[doc]
        parts = [rolling(words, shingle)[at]]
        docs = [doc]
        for n in range(1, shingle):  # whole texts of fewer words
            short = np.flatnonzero(count == n)
            if len(short):
                parts.append(mixed(rolling(words, n)[begin[short]] + np.uint64(n) * _ODD[0]))
                docs.append(short)
        h, doc = np.concatenate(parts), np.concatenate(docs)
        by = np.argsort(h)
        by = by[np.argsort(doc[by].astype(np.uint16 if len(texts) < 1 << 16 else np.int64), kind="stable")]
        h, doc = h[by], doc[by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.h, self.doc = h[new], doc[new]
        self.size = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each set."""
        out = np.zeros((2, len(self.size)), np.uint64)
        full = np.flatnonzero(self.size)
        if len(full):
            out[0, full] = np.bitwise_xor.reduceat(mixed(self.h * _ODD[1]), self.start[full])
            out[1, full] = np.add.reduceat(mixed(self.h * _ODD[2]), self.start[full])
        n = self.size.astype(np.uint64)
        return mixed(out[0] + n * _ODD[0]), mixed(out[1] ^ n * _ODD[1])


class Bands:
    """Size bands: which differences, parts and bands a size has."""

    def __init__(self, percent: int = PERCENT):
        if not 50 < percent <= 100:
            raise ValueError("a set's partners must be in its own band or the next: percent over 50 and at most 100")
        self.percent = percent

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def largest(self, n: np.ndarray) -> np.ndarray:
        """The largest partner of a set of size ``n``."""
        return n * 100 // self.percent

    def parts(self, band: np.ndarray) -> np.ndarray:
        top = (np.int64(2) << band) - 1
        return np.maximum(LEAST_PARTS, np.ceil(SLACK * self.apart(top, self.largest(top))).astype(np.int64) + 1)

    def own(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band of a size, and the largest difference there (-1: no partner of another set)."""
        band = np.frexp(np.maximum(n, 1).astype(np.float64))[1].astype(np.int64) - 1
        apart = self.apart(n, self.largest(n))
        return band, np.where((n > 0) & (apart > 0), apart, -1)

    def visited(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The band below and the largest difference to its sizes (-1: too small)."""
        band, _ = self.own(n)
        top = (np.int64(1) << band) - 1
        apart = self.apart(n, top)
        return band - 1, np.where((band > 0) & (n <= self.largest(top)) & (apart > 0), apart, -1)


def words_of(s: Shingles, band: np.ndarray, apart: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and 64-bit key of the words of all documents with a
    difference, and how many of its words a document may need to be repeated."""
    parts = bands.parts(np.maximum(band, 0))
    take = (apart >= 0)[s.doc]
    h, doc = s.h[take], s.doc[take]
    part = ((h >> np.uint64(32)) * parts[doc].astype(np.uint64)) >> np.uint64(32)
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
    at = np.flatnonzero(first)
    word = np.bitwise_xor.reduceat(mixed(h * _ODD[0]), at) if len(at) else h
    doc, part = doc[at], part[at]
    there = np.bincount(doc, minlength=len(s.size))
    # A set of fewer words than it must show also shows its empty parts.
    for d in np.flatnonzero((apart >= 0) & (there <= apart)):
        empty = np.setdiff1d(np.arange(parts[d], dtype=np.uint64), part[doc == d])
        doc, part, word = np.append(doc, np.full(len(empty), d)), np.append(part, empty), np.append(word, np.zeros(len(empty), np.uint64))
        there[d] = parts[d]
    place = (band[doc].astype(np.uint64) << np.uint64(40)) + part
    return doc, mixed(mixed(place * _ODD[1] + _ODD[2]) ^ word), np.where(apart >= 0, there - apart, 0)


def _binary(c1: np.ndarray, c2: np.ndarray) -> list[bytes]:
    raw = np.stack([c1, c2], axis=1).astype(">u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _roles(c1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set's names in its own band and as a visitor."""
    own = (c1 & ~np.uint64(1)).view(np.int64)
    return own, own | 1


def sets_of(docs: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(k1, doc_id, node, who, size, need, visits)`` of each document: the
    set's 128-bit and short name, its shingles, and how many of its words must
    be repeated in its own band and in the one below (0: nobody to find there)."""
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        s, bands = Shingles(column_bytes(batch, "text"), shingle), Bands(percent)
        c1, c2 = s.nodes()
        need, visits = (words_of(s, *at(s.size), bands)[2] for at in (bands.own, bands.visited))
        return {"k1": column(batch, "k1"), "doc_id": column(batch, "doc_id"), "node": _binary(c1, c2), "who": _roles(c1)[0],
                "size": s.size, "need": need, "visits": visits}

    rows = docs.select(row_key()[0], F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_arrow(rows, run, "k1 long, doc_id long, node binary, who long, size long, need long, visits long")


def word_keys(docs: DataFrame, key_bits: int, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(key, who)``: the words of all documents."""
    small_batches(docs.sparkSession)
    shift = np.uint64(64 - key_bits)

    def run(batch: pa.RecordBatch) -> dict:
        s, bands = Shingles(column_bytes(batch, "text"), shingle), Bands(percent)
        keys, who = [], []
        for at, name in zip((bands.own, bands.visited), _roles(s.nodes()[0]), strict=True):
            doc, key, _ = words_of(s, *at(s.size), bands)
            keys.append((key >> shift).view(np.int64))
            who.append(name[doc])
        return {"key": np.concatenate(keys), "who": np.concatenate(who)}

    return in_arrow(docs.select("text"), run, "key long, who long")


def buckets_of(keys: DataFrame, sets: DataFrame) -> DataFrame:
    """``(key, who)``: each set in the buckets of its rarest repeated words,
    as many as the pigeonhole asks for."""
    by_key = Window.partitionBy("key")
    met = (keys.withColumn("before", F.lag("who").over(by_key.orderBy("who")))
           .where("before is null or before <> who")  # copies are one set
           .withColumn("n", F.count("*").over(by_key)).where("n > 1").select("key", "who", "n"))
    needs = (sets.where("need > 0").select("who", "need").union(sets.where("visits > 0").select(F.col("who").bitwiseOR(F.lit(1)), "visits"))
             .groupBy("who").agg(F.min("need").alias("need")))
    by_set = Window.partitionBy("who")
    met = (met.join(needs, "who").withColumn("repeated", F.count("*").over(by_set)).where("repeated >= need")
           .withColumn("rank", F.row_number().over(by_set.orderBy("n", "key"))).where("rank <= repeated - need + 1"))
    return met.select("key", F.col("who").bitwiseAND(F.lit(-2)).alias("who"))


def shingles_of(docs: DataFrame, names: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(node, who, size, tokens, sketch)`` of the documents ``k1`` (and of
    some others, where bits are shared): sorted hashes and the parity sketch."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(bits_of(names.select(F.xxhash64("k1").alias("h"))))

    def run(batch: pa.RecordBatch) -> dict | None:
        asked = shared.value.holds(longs(batch, "h").view(np.uint64))
        if not asked.any():
            return None
        texts = [t for t, a in zip(column_bytes(batch, "text"), asked.tolist(), strict=True) if a]
        s = Shingles(texts, shingle)
        c1, c2 = s.nodes()
        flips = np.bincount(s.doc * BITS + (s.h & np.uint64(BITS - 1)).astype(np.int64), minlength=len(texts) * BITS) & 1
        sketch = np.packbits(flips.astype(np.uint8).reshape(-1, BITS), axis=1)
        tokens = np.split(s.h, s.start[1:])
        return {"node": _binary(c1, c2), "who": _roles(c1)[0], "size": s.size,
                "tokens": [t.tobytes() for t in tokens], "sketch": [x.tobytes() for x in sketch]}

    rows = docs.select(row_key()[0], "text").select(F.xxhash64("k1").alias("h"), "text")
    found = in_arrow(rows, run, "node binary, who long, size long, tokens binary, sketch binary")
    return found.dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ``(u, v)`` among ``pairs`` whose sets are similar enough."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("tokens").alias(f"{name}_tokens"))

    def run(batch: pa.RecordBatch) -> dict:
        u, v = (column(batch, f"{x}_tokens").to_pylist() for x in "uv")
        keep = []
        for a, b in zip(u, v, strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        keep = pa.array(keep, pa.bool_())
        return {x: column(batch, x).filter(keep) for x in "uv"}

    return in_arrow(pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v"), run, "u binary, v binary")


def _may_link(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: each set with the best centre of its buckets among sets of
    another label: the one with the fewest words of its own."""
    member = F.struct("score", "node", "size", "label")
    centre = buckets.groupBy("key").agg(F.max(member).alias("a"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    rows = buckets.join(centre.select("key", "a"), "key")
    other = rows.where("label <> a.label").groupBy("key").agg(F.max(member).alias("b"))
    rows = rows.join(other, "key").withColumn("c", F.when(F.col("label") != F.col("a.label"), F.col("a")).otherwise(F.col("b")))
    rows = rows.where(_may_link("size", "c.size", percent)).groupBy("node").agg(F.max("c").alias("c"))
    return rows.select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v")).distinct()


def tile_pairs(buckets: DataFrame, sets: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """``(u, v)``: pairs of a bucket with different labels whose sizes and
    sketches allow a link.  Buckets over ``tile`` members are cut into tiles,
    each pair of tiles being one task's group."""
    spread = buckets.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    rows = buckets.join(spread.where("low <> high").select("key", "tiles"), "key")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    rows = rows.join(sets.select("node", "sketch"), "node").select(
        "key", "node", "size", "label", "sketch", own.alias("own"),
        F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, own).alias("a"), F.greatest(t, own).alias("b")))).alias("x"))
    keys = ["key", "a", "b"]
    rows = rows.select("key", "x.a", "x.b", "own", "node", "size", "label", "sketch").repartition(*keys).sortWithinPartitions(*keys)
    bands = Bands(percent)

    def near(own: np.ndarray, size: np.ndarray, label: list[bytes], node: list[bytes], sketch: list[bytes], two: bool) -> Iterator[tuple[bytes, bytes]]:
        mark = np.unique(np.array(label, object), return_inverse=True)[1]
        bits = np.frombuffer(b"".join(sketch), np.uint64).reshape(len(node), -1)
        for i in range(len(node) - 1):
            j = slice(i + 1, None)
            may = (mark[j] != mark[i]) & (np.minimum(size[j], size[i]) * 100 >= np.maximum(size[j], size[i]) * percent)
            if two:  # pairs inside a tile are another group's
                may &= own[j] != own[i]
            at = np.flatnonzero(may) + i + 1
            if len(at):
                at = at[np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1) <= bands.apart(size[at], size[i])]
                yield from ((min(node[i], node[k]), max(node[i], node[k])) for k in at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: pa.Table, key: np.ndarray) -> pa.RecordBatch:
            edges = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
            own, size = (rows.column(c).to_numpy() for c in ("own", "size"))
            label, node, sketch = (rows.column(c).to_pylist() for c in ("label", "node", "sketch"))
            found = {p for i, j in zip(edges[:-1], edges[1:], strict=True) if j - i > 1
                     for p in near(own[i:j], size[i:j], label[i:j], node[i:j], sketch[i:j], key[i][1] != key[i][2])}
            u, v = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])

        for batch in batches:
            rows = pa.Table.from_batches([*held, batch])
            key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            last = int(np.flatnonzero((key == key[-1]).all(axis=1))[0]) if len(key) else 0  # this group may go on
            held = rows.slice(last).to_batches()
            if last:
                yield done(rows.slice(0, last), key[:last])
        if held:
            rows = pa.Table.from_batches(held)
            yield done(rows, np.stack([rows.column(c).to_numpy().astype(np.int64) for c in keys], axis=1))

    return rows.mapInArrow(run, "u binary, v binary").distinct()


def links(docs: DataFrame, sets: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(u, v)`` links between different sets that connect what all links
    between them would; ``sets`` is the written result of ``sets_of``."""
    total = sets.agg(F.sum("size")).first()[0] or 0
    keys = word_keys(docs, min(62, int(total).bit_length() + KEY_BITS), shingle, percent)
    met = written(buckets_of(keys, sets), "buckets")
    scores = met.groupBy("who").agg(F.count("*").alias("score"))
    names = written(sets.join(scores.select("who"), "who", "left_semi").groupBy("node").agg(F.min("k1").alias("k1")).select("k1").distinct(), "names")
    full = written(shingles_of(docs, names, shingle), "shingles")
    buckets = written(met.join(full.select("who", "node", "size"), "who").join(scores, "who").select("key", "node", "size", "score"), "buckets")
    found: list[DataFrame] = []

    def labelled() -> DataFrame:
        if not found:
            return buckets.withColumn("label", F.col("node"))
        roots = components(reduce(DataFrame.union, found))
        return buckets.join(roots.select("node", "root"), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")

    for _ in range(ROUNDS):
        found.append(written(verified(star_pairs(written(labelled(), "labelled"), percent), full, percent), "links"))
    rest = tile_pairs(written(labelled(), "labelled"), full, percent)
    return reduce(DataFrame.union, [*found, written(verified(rest, full, percent), "links")])


def grouped(docs: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each document."""
    sets = written(sets_of(docs, shingle, percent), "sets")
    roots = components(links(docs, sets, shingle, percent))
    placed = (sets.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left")
              .select("node", "least", F.coalesce("root", "node").alias("root")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = written(placed.join(least, "root").select("node", "component_id"), "members")
    return sets.join(of_set, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def digest(docs: DataFrame) -> DataFrame:
    """The fixed columns of ``op11_jaccard_join``."""
    return grouped(docs)
