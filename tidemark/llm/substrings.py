"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``words`` consecutive words of one document.  A word goes where a
window that covers it also starts in a document with a smaller ``doc_id``;
all windows are judged on the input.

Two suffixes that share a window share a sampled prefix of it: the window's
least ``PREFIX``-word hash, at the same place in both.  So

1. the sampled prefixes of all texts are counted, and those of a single
   document are leaves of their own, which hold no repeat;
2. suffixes with a repeated prefix go to the group of that prefix.  Where that
   has more than ``GROUP`` suffixes, they go by their own first words instead,
   ``STEP`` more of them until a group fits; at the length of a window a group
   is a single node, whatever its size;
3. in a group, the suffixes are sorted by their words and the common prefixes
   of neighbours (LCPs) give the tree.  An internal node of window depth or
   more with several documents below it is a repeat; its least document keeps
   the words.

A tree is cut at the depth of a window: what lies below has the same or a
greater least document and removes no other word.  So a repeat longer than a
window is a chain of windows, one for each of its suffixes, and ``spans`` are
the ranges that the chains of a document cover together: repeats that touch or
overlap, also of different documents, make one span.

Whether a prefix is repeated (or large) reaches the tasks as bits of a table
of at most ``MOST_BITS``, the only thing that is broadcast.  A bit may be set
by another prefix: that sends a suffix to a group in vain, or lengthens a
prefix without need, and changes no result.

Windows that an Arrow batch holds several times are decided there, by 64-bit
fingerprints, for all but the least document, so that a passage of a third of
all documents sends one row a batch.  Groups are read in order, ``CHUNK`` rows
at a time; of a group that goes on, the rows of each node's least document stay.

Defined cases: a null or empty text has no words; a null ``doc_id`` counts as
the largest; documents of the same id are no smaller than one another, so
equal rows keep what only they hold; texts shorter than a window keep all; an
empty table gives an empty result; other columns are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_array, column, column_bytes, fields, in_arrow, longs, packed, row_key, small_batches, written

WORDS = 13
PREFIX = 5
#: Suffixes of a group, words by which a prefix is lengthened, rows that are sorted at once.
GROUP, STEP, CHUNK = 50_000, 2, 20_000
#: Bits for each repeated prefix, and of the whole table at most (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
SEGMENT_BITS = 1 << 16
LAST = (1 << 63) - 1

_BASE = np.uint64(0x9E3779B97F4A7C15)


def order(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive words."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = out * _BASE + words[i:i + size]
    return mixed(out)


class Texts:
    """The words of a batch of texts side by side, and the sampled prefix of
    each window: ``start`` (place of the window), ``at`` (of its prefix),
    ``doc`` (the text's number)."""

    def __init__(self, texts: list[bytes], n: int, prefix: int):
        split = self.split = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in split], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64)
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, (w for ws in split for w in ws)), np.uint64, int(self.counts.sum()))
        self.words, self.windows = words, rolling(words, n)
        self.prefixes = rolling(words, prefix)
        room = np.maximum(self.counts - n + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), room)
        self.start = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room) + self.begin[self.doc]
        best, place = self.prefixes[self.start], np.zeros(len(self.start), np.int64)
        for i in range(1, n - prefix + 1):
            there = self.prefixes[self.start + i]
            less = there < best
            best[less], place[less] = there[less], i
        self.prefix, self.at = best, self.start + place


def counted_prefixes(docs: DataFrame, n: int = WORDS, prefix: int = PREFIX) -> DataFrame:
    """``(h, n, suffixes)``: sampled prefixes, the documents that hold them and
    the suffixes that sample them."""
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        t = Texts(column_bytes(batch, "text"), n, prefix)
        by = np.lexsort((t.doc, t.prefix))
        h, doc = t.prefix[by], t.doc[by]
        first = np.diff(h, prepend=h[:1] + np.uint64(1)) != 0
        edges = np.flatnonzero(first)
        count = np.add.reduceat((first | (np.diff(doc, prepend=-1) != 0)).astype(np.int64), edges) if len(h) else edges
        return {"h": h[edges].view(np.int64), "n": count, "suffixes": np.diff(np.append(edges, len(h)))}

    found = in_arrow(docs.select("text"), run, "h long, n long, suffixes long")
    return found.groupBy("h").agg(F.sum("n").alias("n"), F.sum("suffixes").alias("suffixes"))


def lengths(n: int, prefix: int) -> range:
    """The lengths between a sampled prefix and a whole window."""
    return range(prefix + STEP, n, STEP)


def longer(t: Texts, rows: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` words of the suffixes ``rows``, within the group
    of their sampled prefix."""
    return mixed((rolling(t.words, length)[t.start[rows]] + np.uint64(length)) * _BASE ^ t.prefix[rows])


def counted_longer(docs: DataFrame, large: Bits, n: int = WORDS, prefix: int = PREFIX) -> DataFrame:
    """``(h, suffixes)``: the longer prefixes of suffixes whose sampled prefix
    is large, and how many suffixes have them."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(large)

    def run(batch: pa.RecordBatch) -> dict | None:
        t = Texts(column_bytes(batch, "text"), n, prefix)
        rows = np.flatnonzero(shared.value.holds(t.prefix))
        if not len(rows):
            return None
        h, count = np.unique(np.concatenate([t.prefix[:0], *(longer(t, rows, p) for p in lengths(n, prefix))]), return_counts=True)
        return {"h": h.view(np.int64), "suffixes": count}

    return in_arrow(docs.select("text"), run, "h long, suffixes long").groupBy("h").agg(F.sum("suffixes").alias("suffixes"))


# -- bits ---------------------------------------------------------------------------

class Bits:
    """A table of bits for 64-bit hashes; set bits may be shared."""

    def __init__(self, bits: int, segments: list[tuple[int, bytes]]):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.data = np.zeros(max(1, bits // 8), np.uint8)
        for i, part in segments:
            self.data[i * SEGMENT_BITS // 8:i * SEGMENT_BITS // 8 + len(part)] = np.frombuffer(part, np.uint8)

    def holds(self, h: np.ndarray) -> np.ndarray:
        slot = h >> self.shift
        return (self.data[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits_of(hashes: DataFrame) -> Bits:
    """The bits of ``h``, made in segments by Spark; their number follows the
    count of hashes up to ``MOST_BITS``."""
    n = hashes.count()
    bits = SEGMENT_BITS
    while bits < min(MOST_BITS, n * BITS_EACH):
        bits *= 2
    slot = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1))
    bytes_ = (hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 3).alias("byte"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 7 as int))")).alias("v")))
    rows = (bytes_.groupBy(F.shiftright("byte", SEGMENT_BITS.bit_length() - 4).alias("segment"))
            .agg(F.collect_list(F.struct((F.col("byte") % (SEGMENT_BITS // 8)).cast("int").alias("byte"), F.col("v").cast("int").alias("v"))).alias("b")))

    def fill(batch: pa.RecordBatch) -> dict:
        out = []
        for cells in column(batch, "b").to_pylist():
            part = np.zeros(SEGMENT_BITS // 8, np.uint8)
            part[[c["byte"] for c in cells]] = [c["v"] for c in cells]
            out.append(part.tobytes())
        return {"segment": column(batch, "segment"), "part": out}

    got = in_arrow(rows, fill, "segment long, part binary").collect()
    return Bits(bits, [(r.segment, bytes(r.part)) for r in got])


# -- groups -------------------------------------------------------------------------

_SUFFIXES = "key long, ord long, k1 long, start int, sure int, words string"


def suffixes(docs: DataFrame, repeated: Bits, large: Bits, n: int = WORDS, prefix: int = PREFIX) -> DataFrame:
    """A row for the suffixes in a row that sample the same place and may
    repeat: their group ``key``, the document ``(ord, k1)``, the ``start`` of
    the first, their ``words`` up to the last one's window, and as bits those
    that are ``sure`` to repeat a smaller document of the same batch.
    ``large`` holds the prefixes, sampled and longer, of too many suffixes."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    shared_repeated, shared_large = spark.sparkContext.broadcast(repeated), spark.sparkContext.broadcast(large)

    def run(batch: pa.RecordBatch) -> dict | None:
        t = Texts(column_bytes(batch, "text"), n, prefix)
        rows = np.flatnonzero(shared_repeated.value.holds(t.prefix))
        if not len(rows):
            return None
        ords, k1 = longs(batch, "ord"), longs(batch, "k1")
        doc, start, at, h = t.doc[rows], t.start[rows], t.at[rows], t.prefix[rows]
        prints = t.windows[start]
        # the least document of each window in this batch
        by = np.lexsort((ords[doc], prints, h))
        first = np.concatenate(([True], (np.diff(h[by]) != 0) | (np.diff(prints[by]) != 0)))
        least = ords[doc[by]][np.flatnonzero(first)][np.cumsum(first) - 1]
        sure = np.empty(len(rows), bool)
        sure[by] = ords[doc[by]] > least
        # a suffix has the windows in a row that sample the same place; where its prefix is large, each stands alone
        alone = shared_large.value.holds(h)
        cut = np.concatenate(([True], (np.diff(at) != 0) | (np.diff(start) != 1) | (np.diff(doc) != 0) | alone[1:]))
        edges = np.flatnonzero(cut)
        nth = np.arange(len(rows)) - edges[np.cumsum(cut) - 1]
        mask = np.bitwise_or.reduceat(sure.astype(np.int32) << nth.astype(np.int32), edges)
        size = np.diff(np.append(edges, len(rows)))
        settled = mask == (1 << size) - 1
        key = h[edges]
        long = np.flatnonzero(alone[edges])
        for p in (*lengths(n, prefix), n):
            if not len(long):
                break
            key[long] = longer(t, rows[edges[long]], p)
            long = long[shared_large.value.holds(key[long])]
        # what is settled needs no group: it is dealt out by its place
        key = np.where(settled, mixed(start[edges].astype(np.uint64) * _BASE + k1[doc[edges]].view(np.uint64)), key)
        own, first = doc[edges], start[edges] - t.begin[doc[edges]]
        text = [b"" if s else b" ".join(t.split[d][a:a + w])
                for s, d, a, w in zip(settled.tolist(), own.tolist(), first.tolist(), (size + n - 1).tolist(), strict=True)]
        return {"key": key.view(np.int64), "ord": ords[own], "k1": k1[own], "start": first.astype(np.int32), "sure": mask.astype(np.int32),
                "words": pa.array(text, pa.binary()).cast(pa.string())}

    return in_arrow(docs.select(order().alias("ord"), F.col("k1"), "text"), run, _SUFFIXES)


def suffix_tree(group: np.ndarray, words: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The trees of groups of suffixes, which start ``at`` places of
    ``words``: the suffixes' order by group and words, and the LCP of each
    with the one before it, both to ``depth``."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    branch = words[at[:, None] + np.arange(depth)]
    bits = max(1, int(words.max()).bit_length())
    each = 63 // bits
    keys = []
    for a in range(0, depth, each):
        key = np.zeros(len(at), np.int64)
        for t in range(a, min(a + each, depth)):
            key = key << bits | branch[:, t]
        keys.append(key)
    by = np.lexsort((*reversed(keys), group))
    branch, group = branch[by], group[by]
    same = branch[1:] == branch[:-1]
    lcp = np.where(same.all(axis=1), depth, same.argmin(axis=1))
    return by, np.concatenate(([0], np.where(group[1:] == group[:-1], lcp, 0)))


def word_numbers(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of rows side by side, equal words by equal numbers, and
    where each row begins and the last ends."""
    lists = pc.split_pattern(rows, " ")
    return lists.values.dictionary_encode().indices.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) >= rows:
            yield pa.Table.from_batches(kept)
            kept = []
    if sum(b.num_rows for b in kept):
        yield pa.Table.from_batches(kept)


def repeats(rows: DataFrame, n: int = WORDS, chunk: int = CHUNK) -> DataFrame:
    """``(ord, k1, start, mask)``: bits of the windows from ``start`` on that a
    smaller document holds too.  Each task reads its groups in order."""
    dealt = rows.repartition("key").sortWithinPartitions("key", "ord")

    def deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of the group that may go on: its key, their least documents and words
        open_key, open_ord, open_words = None, np.zeros(0, np.int64), pa.array([], pa.string())
        for table in chunks(batches, chunk):
            key, ords, mask = (table[c].to_numpy() for c in ("key", "ord", "sure"))
            mask = mask.copy()
            skip = len(open_ord) if key[0] == open_key else 0
            key, ords = np.concatenate((np.full(skip, key[0]), key)), np.concatenate((open_ord[:skip], ords))
            text = pa.concat_arrays([open_words[:skip], *(as_array(c, pa.string()) for c in table["words"].chunks)])
            words, begin = word_numbers(text)
            size = np.maximum(np.diff(begin) - n + 1, 0)
            owner = np.repeat(np.arange(len(key)), size)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            by, lcp = suffix_tree(np.cumsum(np.diff(key, prepend=key[0]) != 0)[owner], words, begin[owner] + nth, n)
            # the nodes of window depth are runs of suffixes with an LCP of a window; each has its least document
            edges = np.flatnonzero(lcp < n)
            least = np.empty(len(by), np.int64)
            if len(by):
                least[by] = np.repeat(np.minimum.reduceat(ords[owner[by]], edges), np.diff(np.append(edges, len(by))))
            hit = np.flatnonzero((ords[owner] > least) & (owner >= skip))
            np.bitwise_or.at(mask, owner[hit] - skip, (1 << nth[hit]).astype(mask.dtype))
            # the sort is stable and documents come in order: the first suffix of a node is of its least document
            keeps = np.unique(owner[by[edges]]) if len(by) else np.zeros(0, np.int64)
            keeps = keeps[key[keeps] == key[-1]]
            open_key, open_ord, open_words = key[-1], ords[keeps], text.take(pa.array(keeps))
            found = table.set_column(table.schema.get_field_index("sure"), "mask", pa.array(mask, pa.int32())).filter(pa.array(mask != 0))
            yield from found.select(["ord", "k1", "start", "mask"]).combine_chunks().to_batches()

    return dealt.mapInArrow(deep, "ord long, k1 long, start int, mask int")


def covered(n_words: int, starts: list[int], masks: list[int], n: int) -> np.ndarray:
    """The words that the windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.array(starts, np.int64)[:, None] + np.arange(31)
    at = at[(np.array(masks, np.int64)[:, None] >> np.arange(31)) & 1 == 1]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge)[:n_words] > 0


def without_repeats(docs: DataFrame, n: int = WORDS, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """``(row, n_words, n_removed, spans, kept)`` for each document: ``row``
    has its columns but the text, ``spans`` the removed ranges of words (its
    repeats, merged where they touch), ``kept`` the other words joined by blanks."""
    if n - prefix + 1 > 30:
        raise ValueError("a suffix's windows must fit in the bits of an int: take a longer prefix")
    prefixes = written(counted_prefixes(docs, n, prefix).where("n > 1"), "prefixes")
    texts = docs.select(row_key()[0], "doc_id", "text")
    large = prefixes.where(F.col("suffixes") > group).select("h")
    if not large.isEmpty():
        more = counted_longer(docs, bits_of(large), n, prefix).where(F.col("suffixes") > group).select("h")
        large = large.unionByName(written(more, "longer-prefixes"))
    rows = suffixes(texts, bits_of(prefixes.select("h")), bits_of(large), n, prefix)
    out = repeats(rows, n).groupBy("ord", "k1").agg(F.collect_list("start").alias("start"), F.collect_list("mask").alias("mask"))
    whole = packed(docs).withColumn("ord", order("row.doc_id")).join(out, ["ord", "k1"], "left")
    small_batches(docs.sparkSession)

    def cut(batch: pa.RecordBatch) -> dict:
        cols: dict[str, list] = {"n_words": [], "n_removed": [], "spans": [], "kept": []}
        starts, masks = column(batch, "start").to_pylist(), column(batch, "mask").to_pylist()
        for text, start, mask in zip(column_bytes(batch, "text"), starts, masks, strict=True):
            words = text.split()
            cols["n_words"].append(len(words))
            gone = covered(len(words), start, mask, n) if start else np.zeros(len(words), bool)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            cols["spans"].append([{"first": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            cols["n_removed"].append(int(gone.sum()))
            if start:
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            cols["kept"].append(b" ".join(words))
        return {"row": column(batch, "row")} | cols | {"kept": pa.array(cols["kept"], pa.binary()).cast(pa.string())}

    return in_arrow(whole.select("row", "text", "start", "mask"), cut, fields(
        whole.schema["row"].dataType, "n_words long, n_removed long, spans array<struct<first: int, end: int>>, kept string"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    out = without_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k FROM s),
m AS (SELECT k, min(doc_id) AS first FROM h GROUP BY k),
c AS (SELECT h.doc_id, h.i FROM h JOIN m ON h.k = m.k WHERE m.first < h.doc_id),
r AS (SELECT DISTINCT doc_id, i + j AS i FROM c, generate_series(0, 12) AS g(j)),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (
  SELECT p.doc_id, count(*) FILTER (WHERE r.i IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE r.i IS NULL) AS kept
  FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.i = r.i GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
