"""Benchmark decontamination by the q-gram lemma and banded alignment.

A document is contaminated by a benchmark passage if some part of it is within
``k`` edits of the passage, ``k`` being ``EDITS`` of its length.  Both are
compared as UTF-8 bytes with A-Z lower-cased and each run of
``[\\x20\\x09-\\x0D]`` made one blank.

Such a part shares at least ``m - q + 1 - k * q`` q-grams with a passage of
``m`` bytes, and all of them lie within ``k + 1`` neighbouring diagonals
(document position less passage position).  Shared q-grams are counted in
bands of ``2 * (k + 1)`` diagonals that overlap by half, so that one band holds
them all; bands that meet the bound are verified by an alignment that stays in
the band and stops once its cost exceeds ``k``.  Each passage's ``k`` is
lowered, if need be, until the bound is positive.

One rule holds at every size: an item is found by any of its parts of
``PART`` bytes, which begin every ``STEP`` bytes and with the last ``PART``
bytes; an item up to ``PART`` bytes is one part.  So ``PART + STEP`` consecutive
bytes of an item are always found, and a whole item within its edits has a part
within its own.

Documents stay where they are: items go to them, in blocks of at most
``MOST_BYTES`` of normalised text, one pass over the documents a block.  A block
holds about 14 bytes for each of its own in a worker (32-bit hashes of q-grams,
their places, a packed table of bits): hashes that are shared count q-grams too
often, which costs an alignment and finds nothing more.

Defined cases: items shorter than ``q`` bytes are looked for as they are,
between blanks or ends of the text; null and empty items take no part; a null
or empty text is clean; equal items and equal documents each count; an empty
table gives an empty result; other columns are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, column_bytes, fields, in_arrow, packed, small_batches, unpacked

Q = 8
EDITS = 0.08
PART, STEP = 128, 64
MOST_BYTES = 16 << 20
#: Bytes of documents whose q-grams are looked up at once.
CHUNK = 4 << 20


def normalised(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def qgrams(data: bytes) -> np.ndarray:
    """The eight bytes from each position as one number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for i in range(min(Q, n)):
        part = np.frombuffer(data, "<u8", (n - i + Q - 1) // Q, i)
        out[i::Q] = part
    return out


def cuts(size: int, part: int, step: int) -> list[int]:
    """Where the parts of a text begin."""
    return [0] if size <= part else [*range(0, size - part, step), size - part]


class Passages:
    """Items of a benchmark, their parts and the places of their q-grams."""

    def __init__(self, rows: list[tuple[int | None, bytes]], edits: float = EDITS, part: int = PART, step: int = STEP):
        self.ids: list[int | None] = []       # of each part
        self.texts: list[bytes] = []
        self.short: dict[bytes, list[int | None]] = {}
        whole, begin, first = [], [], []      # items, where their parts begin in all, their first parts
        size = 0
        for item, text in rows:
            text = normalised(text)
            if not text:
                continue
            if len(text) < Q:
                self.short.setdefault(text, []).append(item)
                continue
            first.append(len(self.texts))
            for a in cuts(len(text), part, step):
                self.ids.append(item)
                self.texts.append(text[a:a + part])
                begin.append(size + a)
            whole.append(text)
            size += len(text)
        self.size = np.array([len(t) for t in self.texts], np.int32)
        self.k = np.minimum((self.size * edits).astype(np.int32), (self.size - Q) // Q)
        self.least = self.size - Q + 1 - self.k * Q
        self.begin = np.array(begin, np.int64)
        # q-grams of all items in a row; a q-gram belongs to the parts that hold all of it
        grams = [qgrams(t) for t in whole]
        starts = np.cumsum([0, *map(len, whole)])[:-1]
        place = np.concatenate([np.arange(len(g), dtype=np.int64) + a for g, a in zip(grams, starts, strict=True)]) if grams else np.zeros(0, np.int64)
        codes = self.hashed(np.concatenate(grams)) if grams else np.zeros(0, np.uint32)
        order = np.argsort(codes, kind="stable")
        self.place = place[order].astype(np.uint32)
        self.codes, first_at = np.unique(codes[order], return_index=True)
        self.first = np.append(first_at, len(codes)).astype(np.uint32)
        bits = min(32, max(16, int(np.ceil(np.log2(max(1, len(self.codes)) * 16)))))
        self.shift = np.uint32(32 - bits)
        self.table = np.zeros(1 << (bits - 3), np.uint8)
        slot = self.codes >> self.shift
        np.bitwise_or.at(self.table, slot >> np.uint32(3), np.uint8(1) << (slot & np.uint32(7)).astype(np.uint8))
        #: Parts that a place may belong to, and bytes in which a region with all its diagonals lies.
        self.overlap = -(-part // step) + 1
        self.reach = int((self.size + 3 * (self.k + 1) + Q).max()) if self.texts else 0

    def nbytes(self) -> int:
        """What the tables hold; texts come to about three bytes a byte."""
        return sum(x.nbytes for x in (self.size, self.k, self.least, self.begin, self.place, self.codes, self.first, self.table)) + sum(map(len, self.texts))

    @staticmethod
    def hashed(grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)

    def shared(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shared q-grams: document position, part and the place in it."""
        codes = self.hashed(qgrams(data))
        slot = codes >> self.shift
        at = np.flatnonzero((self.table[slot >> np.uint32(3)] >> (slot & np.uint32(7)).astype(np.uint8)) & 1)
        i = np.searchsorted(self.codes, codes[at])
        i[i == len(self.codes)] = 0
        true = self.codes[i] == codes[at]
        at, i = at[true], i[true]
        first = self.first[i].astype(np.int64)
        n = self.first[i + 1].astype(np.int64) - first
        flat = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at, place = np.repeat(at, n), self.place[flat].astype(np.int64)
        # the last part that begins at or before a place, and those before it
        last = np.searchsorted(self.begin, place, "right") - 1
        out = []
        for back in range(self.overlap):
            who = last - back
            inside = place - self.begin[np.maximum(who, 0)]
            good = (who >= 0) & (inside >= 0) & (inside + Q <= self.size[np.maximum(who, 0)])
            out.append((at[good], who[good], inside[good]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def bands(self, data: bytes) -> list[tuple[int, int]]:
        """Passages and first diagonals of the bands that meet the bound."""
        if not self.texts or len(data) < Q:
            return []
        at, who, place = self.shared(data)
        width = self.k[who].astype(np.int64) + 1
        low = (at - place) // width
        most = (len(data) + self.reach) * 2
        keys = who * most + low + self.reach  # low is at least -reach
        keys, count = np.unique(np.concatenate((keys, keys - 1)), return_counts=True)
        who, low = keys // most, keys % most - self.reach
        good = count >= self.least[who]
        return list(zip(who[good].tolist(), (low[good] * (self.k[who[good]].astype(np.int64) + 1)).tolist(), strict=True))

    def aligned(self, data: np.ndarray, p: int, low: int, begin: int, end: int) -> int | None:
        """The least edits that make a part of ``data[begin:end]`` passage
        ``p`` on diagonals from ``low`` on, if at most ``k``."""
        k, passage = int(self.k[p]), np.frombuffer(self.texts[p], np.uint8)
        width = 2 * (k + 1)
        far = np.int64(1 << 30)
        column_at = low + np.arange(width)  # document position of each diagonal at this row
        slope = np.arange(width)
        # a document position may start the part, from begin to end
        cost = np.where((column_at >= begin) & (column_at <= end), 0, far)
        for c in passage:
            inside = (column_at >= begin) & (column_at < end)
            here = data[np.clip(column_at, 0, len(data) - 1)]
            step = np.where(inside, cost + (here != c), far)
            step[:-1] = np.minimum(step[:-1], cost[1:] + 1)  # the passage's byte is missing
            column_at = column_at + 1
            # extra bytes of the document, along the row
            cost = np.minimum.accumulate(np.where((column_at >= begin) & (column_at <= end), step, far) - slope) + slope
            cost[(column_at < begin) | (column_at > end)] = far
            if cost.min() > k:
                return None
        return int(cost.min())

    def found(self, texts: list[bytes]) -> list[dict[int, int]]:
        """For each text the passages in it and their least edits."""
        clean = [normalised(t) for t in texts]
        out: list[dict[int, int]] = [{} for _ in texts]
        if not self.texts:
            return out
        # texts side by side, a line end between them, in chunks of bounded size
        group: list[int] = []
        size = 0
        for i, t in enumerate(clean):
            if len(t) < Q:
                continue
            group.append(i)
            size += len(t) + 1
            if size >= CHUNK:
                self._search(clean, group, out)
                group, size = [], 0
        self._search(clean, group, out)
        return out

    def _search(self, clean: list[bytes], group: list[int], out: list[dict[int, int]]) -> None:
        if not group:
            return
        data = b"\n".join(clean[i] for i in group)
        view = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(clean[i]) + 1 for i in group]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        for a in range(0, len(data), CHUNK):
            begin = max(0, a - self.reach)
            for p, low in self.bands(data[begin:a + CHUNK]):
                low += begin
                last = low + 2 * (int(self.k[p]) + 1) + len(self.texts[p])
                for d in range(int(np.searchsorted(ends, max(0, low))), min(len(group), int(np.searchsorted(starts, last)))):
                    seen, begin_, end_ = out[group[d]], int(starts[d]), int(ends[d])
                    if seen.get(p) == 0:
                        continue
                    # the part as it is, on the band's diagonals, needs no alignment
                    same = data.find(self.texts[p], max(begin_, low), min(end_, last - 1)) >= 0
                    edits = 0 if same else self.aligned(view, p, low, begin_, end_)
                    if edits is not None:
                        seen[p] = min(edits, seen.get(p, edits))


    def found_short(self, text: bytes) -> list[int | None]:
        """Items under ``Q`` bytes that the text holds between blanks."""
        if not self.short:
            return []
        words, most = normalised(text).split(b" "), max(t.count(b" ") for t in self.short) + 1
        seen = {b" ".join(words[i:i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)}
        return [i for t, ids in self.short.items() if t in seen for i in ids]


def blocks(benchmark: DataFrame, most: int = MOST_BYTES) -> Iterator[Passages]:
    """The benchmark's passages in blocks of about ``most`` bytes."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, ceil(total / most))
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = part.collect()
        yield Passages(sorted(((r.item_id, r.text.encode()) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def checked(docs: DataFrame, passages: Passages, keep_text: bool) -> DataFrame:
    """``row`` [and ``text``] of ``packed`` documents with ``hits``, the
    passages found in each: item and least edits."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(passages)   # of bounded size: see blocks

    def run(batch: pa.RecordBatch) -> dict:
        hits, passages, texts = [], shared.value, column_bytes(batch, "text")
        for text, seen in zip(texts, passages.found(texts), strict=True):
            best: dict[int | None, tuple[int, float]] = {i: (0, 1.0) for i in passages.found_short(text)}
            for p, edits in seen.items():
                one = (edits, 1 - edits / int(passages.size[p]))
                best[passages.ids[p]] = min(best.get(passages.ids[p], one), one, key=lambda x: -x[1])
            hits.append([{"item_id": i, "edits": e, "similarity": s} for i, (e, s) in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or 0))])
        return {"row": column(batch, "row"), "hits": hits} | ({"text": column(batch, "text")} if keep_text else {})

    ddl = "text string, " * keep_text + "hits array<struct<item_id: long, edits: int, similarity: double>>"
    return in_arrow(docs.select("row", "text"), run, fields(docs.schema["row"].dataType, ddl))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, edits, similarity)`` for each document and item
    that it holds; clean documents have no row."""
    slim = packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    parts = [checked(slim, block, False) for block in blocks(benchmark)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select(F.col("row.doc_id").alias("doc_id"), F.explode("hits").alias("x")).select("doc_id", "x.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, in their own columns."""
    out = packed(docs)
    for block in blocks(benchmark):
        out = checked(out, block, True).where(F.size("hits") == 0)
    return unpacked(out, docs.columns)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item found in it."""
    return contaminations(docs, benchmark)
