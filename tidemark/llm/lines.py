"""Line dedup with reversible state: exact reference counts and cuckoo filters.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at either end and with
A-Z lower-cased.  The state of a corpus is a pair of tables, split into shards
by key:

* ``refs``: for each key (128-bit hash) the exact number of documents that
  hold it.  Inserting documents adds to it, deleting documents subtracts, so a
  corpus that loses what it gained is back where it was.
* ``filters``: a cuckoo filter for each shard with the keys of at least
  ``min_docs`` documents.  A key is inserted when its count reaches the
  threshold and deleted when it falls below, which cuckoo filters support.

``clean`` probes the lines of documents against the filters and takes only
those that pass to the exact table, so that false positives never count.

Defined cases: null or empty text is one empty line; a key shorter than
``min_chars`` code points is never counted or dropped; a key twice in one
document counts once; equal rows are counted one by one; empty tables give
empty results; other columns of the documents are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (as_array, column, column_bytes, fields, in_arrow, longs, packed, row_key,
                                 small_batches, written)

SHARDS = 256
#: A shard's lines are spread over so many tasks, each with a copy of the
#: shard's filter, so that a frequent line is no task's whole work.
SALTS = 8

SLOTS = 4
KICKS = 500


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def code_points(key: bytes) -> int:
    return len(key) - sum(0x80 <= b < 0xC0 for b in key) if not key.isascii() else len(key)


def hashed(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


# -- cuckoo filter -----------------------------------------------------------

class CuckooFilter:
    """Partial-key cuckoo filter over pairs of 64-bit hashes: 16-bit
    fingerprints, ``SLOTS`` a bucket, a power of two of buckets."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.85 < n + 1:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def loaded(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dumped(self) -> bytes:
        return self.slots.tobytes()

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and the two buckets of each key."""
        mask = np.uint64(len(self.slots) - 1)
        mark = (lo.astype(np.uint64) >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = hi.astype(np.uint64) & mask
        return mark, first, first ^ (self.spread(mark) & mask)

    @staticmethod
    def spread(mark: np.ndarray) -> np.ndarray:
        return (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)

    def holds(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(hi, lo)
        return ((self.slots[a] == mark[:, None]) | (self.slots[b] == mark[:, None])).any(axis=1)

    def insert(self, hi: int, lo: int) -> bool:
        """False if no room was found; the filter must then be built anew."""
        (mark,), (a,), (b,) = self.places(np.array([hi]), np.array([lo]))
        mask = np.uint64(len(self.slots) - 1)
        for at in (a, b):
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = mark
                return True
        at = b
        for kick in range(KICKS):
            k = kick % SLOTS
            self.slots[at, k], mark = mark, self.slots[at, k]
            at = at ^ (self.spread(np.array([mark]))[0] & mask)
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = mark
                return True
        return False

    def delete(self, hi: int, lo: int) -> bool:
        (mark,), (a,), (b,) = self.places(np.array([hi]), np.array([lo]))
        for at in (a, b):
            held = np.flatnonzero(self.slots[at] == mark)
            if len(held):
                self.slots[at, held[0]] = 0
                return True
        return False


def built(hi: np.ndarray, lo: np.ndarray) -> CuckooFilter:
    room = len(hi)
    while True:
        out = CuckooFilter.sized(room)
        if all(out.insert(h, x) for h, x in zip(hi, lo, strict=True)):
            return out
        room = 2 * max(room, SLOTS)


# -- state -------------------------------------------------------------------

_REFS = "shard int, hi long, lo long, n long"
_FILTERS = "shard int, slots binary"


def document_keys(docs: DataFrame, min_chars: int = 1, shards: int = SHARDS) -> DataFrame:
    """A row ``(k1, k2, shard, hi, lo)`` for each document and distinct key."""
    small_batches(docs.sparkSession)

    def keys(batch: pa.RecordBatch) -> dict:
        rows, digests = [], []
        for i, text in enumerate(column_bytes(batch, "text")):
            found = {key for line in text.split(b"\n") if (key := line_key(line)) and code_points(key) >= min_chars}
            digests += map(hashed, found)
            rows += [i] * len(found)
        pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        rows = np.array(rows, np.int64)
        return {"k1": longs(batch, "k1")[rows], "k2": longs(batch, "k2")[rows],
                "shard": (pairs[:, 0].astype(np.uint64) % np.uint64(shards)).astype(np.int32),
                "hi": np.ascontiguousarray(pairs[:, 0]) >> np.int64(8), "lo": np.ascontiguousarray(pairs[:, 1])}

    return in_arrow(docs.select(*row_key(), "text"), keys, "k1 long, k2 long, shard int, hi long, lo long")


class LineState:
    """Reference counts and filters of a corpus; immutable, each change gives
    a new one.  Both tables are written in the shared folder."""

    def __init__(self, refs: DataFrame, filters: DataFrame, min_docs: int, min_chars: int, shards: int):
        self.refs, self.filters = refs, filters
        self.min_docs, self.min_chars, self.shards = min_docs, min_chars, shards

    @classmethod
    def empty(cls, spark: SparkSession, min_docs: int = 10, min_chars: int = 1, shards: int = SHARDS) -> LineState:
        return cls(spark.createDataFrame([], _REFS), spark.createDataFrame([], _FILTERS), min_docs, min_chars, shards)

    def insert(self, docs: DataFrame) -> LineState:
        return self.changed(document_keys(docs, self.min_chars, self.shards), 1)

    def delete(self, docs: DataFrame) -> LineState:
        """Take out documents that were inserted before; a count below zero
        (a document that never was) is an error."""
        return self.changed(document_keys(docs, self.min_chars, self.shards), -1)

    def changed(self, keys: DataFrame, sign: int) -> LineState:
        delta = keys.select("shard", "hi", "lo", F.lit(0).cast("long").alias("was"), F.lit(sign).cast("long").alias("more"))
        old = self.refs.select("shard", "hi", "lo", F.col("n").alias("was"), F.lit(0).cast("long").alias("more"))
        now = (old.union(delta).groupBy("shard", "hi", "lo")
               .agg(F.sum("was").alias("was"), F.sum("more").alias("more"))
               .withColumn("n", F.when(F.col("was") + F.col("more") >= 0, F.col("was") + F.col("more"))
                           .otherwise(F.raise_error(F.lit("a deleted document was never inserted")).cast("long"))))
        now = written(now, "line-refs")
        hot = now.where((F.col("n") >= self.min_docs) | (F.col("was") >= self.min_docs))
        filters = (self.filters.groupBy("shard").cogroup(hot.groupBy("shard"))
                   .applyInPandas(_updater(self.min_docs), _FILTERS))
        return LineState(now.where("n > 0").select("shard", "hi", "lo", "n"), written(filters, "line-filters"),
                         self.min_docs, self.min_chars, self.shards)

    def dropped(self, keys: DataFrame) -> DataFrame:
        """Of ``document_keys`` those of at least ``min_docs`` documents."""
        passed = probed(keys, self.filters)
        hot = self.refs.where(F.col("n") >= self.min_docs).select("hi", "lo")
        return passed.join(hot, ["hi", "lo"], "left_semi")

    def clean(self, docs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """``(row, n_lines, n_dropped, kept)`` for each document: ``row`` holds
        its columns but the text, ``kept`` the other lines joined by newlines."""
        keys = document_keys(docs, self.min_chars, self.shards) if keys is None else keys
        out = self.dropped(keys).groupBy("k1", "k2").agg(F.collect_set(F.struct("hi", "lo")).alias("out"))
        with_out = packed(docs).join(out, ["k1", "k2"], "left")
        return kept_lines(with_out.select("row", "text", "out.hi", "out.lo"))


def _updater(min_docs: int):
    def update(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        """One shard's filter after its counts changed."""
        shard = (old if len(old) else keys)["shard"].iloc[0]
        is_hot, was_hot = keys["n"] >= min_docs, keys["was"] >= min_docs
        stay = keys[is_hot]
        if not len(old):
            now = built(stay["hi"].to_numpy(), stay["lo"].to_numpy())
        else:
            now = CuckooFilter.loaded(old["slots"].iloc[0])
            gone, come = keys[was_hot & ~is_hot], keys[is_hot & ~was_hot]
            fine = all(now.delete(h, x) for h, x in zip(gone["hi"], gone["lo"], strict=True))
            if not (fine and all(now.insert(h, x) for h, x in zip(come["hi"], come["lo"], strict=True))):
                now = built(stay["hi"].to_numpy(), stay["lo"].to_numpy())
        return pd.DataFrame({"shard": [shard], "slots": [now.dumped()]})

    return update


def probed(keys: DataFrame, filters: DataFrame, salts: int = SALTS) -> DataFrame:
    """The keys that their shard's filter holds.  Filters and keys meet in
    tasks by shard and salt; a task sees a shard's filter before its keys."""
    none = F.lit(None)
    salted = keys.select("shard", F.pmod(F.col("k1"), F.lit(salts)).cast("int").alias("salt"), "hi", "lo", "k1", "k2",
                         none.cast("binary").alias("slots"))
    copies = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                            *[none.cast("long").alias(c) for c in ("hi", "lo", "k1", "k2")], "slots")
    both = (copies.union(salted).repartition("shard", "salt")
            .sortWithinPartitions("shard", "salt", F.col("slots").isNull()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table = None, None
        for batch in batches:
            shard, salt = longs(batch, "shard"), longs(batch, "salt")
            bits = column(batch, "slots")
            is_key = np.asarray(bits.is_null())
            spot = shard.astype(np.int64) * salts + salt
            edges = np.flatnonzero(np.diff(spot) | (np.diff(is_key.astype(np.int8)) != 0)) + 1
            hi, lo = (column(batch, c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("hi", "lo"))
            passed = np.zeros(len(spot), bool)
            for a, b in zip([0, *edges], [*edges, len(spot)], strict=True):
                if not is_key[a]:
                    at, table = spot[a], CuckooFilter.loaded(bits[int(a)].as_py())
                elif spot[a] == at:
                    passed[a:b] = table.holds(hi[a:b], lo[a:b])
            if passed.any():
                mask = pa.array(passed)
                yield pa.RecordBatch.from_arrays(
                    [as_array(column(batch, c).filter(mask), pa.int64()) for c in ("hi", "lo", "k1", "k2")],
                    names=["hi", "lo", "k1", "k2"])

    return both.mapInArrow(probe, "hi long, lo long, k1 long, k2 long")


def kept_lines(docs: DataFrame) -> DataFrame:
    """Apply the dropped keys ``hi``, ``lo`` (arrays, null: none)."""
    small_batches(docs.sparkSession)

    def keep(batch: pa.RecordBatch) -> dict:
        n_lines, n_dropped, kept = [], [], []
        his, los = column(batch, "hi").to_pylist(), column(batch, "lo").to_pylist()
        for text, hi, lo in zip(column_bytes(batch, "text"), his, los, strict=True):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if hi:
                out = set(zip(hi, lo, strict=True))
                lines = [x for x in lines if stored_hash(x) not in out]
            n_dropped.append(n_lines[-1] - len(lines))
            kept.append(b"\n".join(lines))
        return {"row": column(batch, "row"), "n_lines": n_lines, "n_dropped": n_dropped,
                "kept": pa.array(kept, pa.binary()).cast(pa.string())}

    return in_arrow(docs, keep, fields(docs.schema["row"].dataType, "n_lines long, n_dropped long, kept string"))


def stored_hash(line: bytes) -> tuple[int, int] | None:
    if not (key := line_key(line)):
        return None
    hi, lo = np.frombuffer(hashed(key), "<i8")
    return int(hi) >> 8, int(lo)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, shards: int = SHARDS) -> DataFrame:
    """Drop the lines that ``min_docs`` documents of ``docs`` itself share:
    all are inserted into an empty state, then cleaned against it."""
    keys = written(document_keys(docs, min_chars, shards), "line-keys")
    state = LineState.empty(docs.sparkSession, min_docs, min_chars, shards).changed(keys, 1)
    return state.clean(docs, keys)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    out = dedup_lines(docs)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
k AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
hot AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, hot.key IS NOT NULL AS out FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT out), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
