"""Cross-tokenizer alignment: which tokens of one tokenizer hold the bytes of
which tokens of another, and how usual each such pair is in the corpus.

Tokenizer A is a byte-level BPE given as ranks, B a piece BPE with byte
fallback.  Both encode a space and the text.  A and B tokens whose byte ranges
overlap are *linked*; where an A and a B token end at the same byte the
sequence is *cut*, and the tokens between two cuts are a group.

Method, lockstep merging: the token ends of a batch are laid side by side, and
one NumPy state vector holds an A pointer and a B pointer for each lane.  Each
step emits the link of every lane's two tokens, advances the pointer whose
token ends first (both at a cut) and compacts the lanes that are finished.
Documents are first split at single spaces between characters that aren't white
space: no token of A or B reaches over such a space, so both tokenizers cut
there.  Equal pieces of a batch of documents share a lane, and a worker keeps
the pieces it has met (up to ``CACHE`` characters, then it starts anew).  So
the number of steps follows the longest piece, not the longest document.

Two passes over the texts.  The first sums links by pair of ids: in a task
before they are shuffled, then over the corpus.  The second gives each document
its links' counts.  Where there are at most ``MOST_PAIRS`` pairs their counts
are broadcast (16 bytes each); beyond that the pairs of each document are
joined to the counts.  The highest count of each B id has as many rows as B's
vocabulary at most.

Defined cases: a text that is null or empty, or whose A or B bytes are not a
space and the text, has no tokens (zeros and empty strings) and counts for no
pair; texts without such spaces (very long words, runs of white space) are one
piece; equal rows each count; a null ``doc_id`` is kept; an empty table gives
an empty result; other columns are carried unread.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_array, column, small_batches, written

#: Folder with the vocabularies, on every machine.
TOKENIZERS = "/opt/tokenizers"
BYTE_RANKS, PIECE_MODEL = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Pieces that B reads at once.
LINE = 32
#: Pairs whose counts are broadcast at most (64 MB), pairs that a task sums
#: before it sends them, characters of pieces that a worker keeps.
MOST_PAIRS, PAIRS_HELD, CACHE = 1 << 22, 1 << 20, 1 << 23

# Fixed value: the pattern that splits text before the merges of the ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A space with white space beside it, and one without.
_ODD, _PLAIN = re.compile(r"\s | \s| \Z"), re.compile(r"(?<=\S) (?=\S)")
#: A piece that must be read by itself.
_EDGE = re.compile(r"\A\s|\s\Z|▁")


def pieces_of(text: str) -> list[str]:
    """The text in pieces; a space and then the pieces joined by spaces are
    what the tokenizers read."""
    return _PLAIN.split(text) if _ODD.search(text) or text[:1].isspace() else text.split(" ")


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists in a row, and where each begins (and the last ends)."""
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64))).astype(np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, int(at[-1])), at


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken
        with open(f"{folder}/{BYTE_RANKS}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECE_MODEL}")
        self.size_b = self._b.get_piece_size()
        bytes_a = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            bytes_a[i] = token
        bytes_b = [bytes([int(p[1:-1], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, self._b.id_to_piece(i)) for i in range(self.size_b))]
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))

        self.say_a = [[f"{i}{end}" for i in range(len(bytes_a))] for end in ",|"]
        self.say_b = [[f"{i}{end}" for i in range(self.size_b)] for end in ",;\n"]

    def encode(self, pieces: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Tokens of a space and each piece in a row and where each piece's
        begin, for A and B; a piece whose bytes differ has none.  The pieces
        are read as lines of a text, as both tokenizers cut at its spaces."""
        lines = [" ".join(pieces[i:i + LINE]) for i in range(0, len(pieces), LINE)]
        text = " " + " ".join(lines)
        want = text.encode()
        ids_a, ids_b = np.array(self._a.encode_ordinary(text), np.int64), _flat(self._b.encode(lines, num_threads=1))[0]
        if all(b"".join(map(t.__getitem__, ids.tolist())) == want for t, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
            end = np.cumsum([len(p.encode()) + 1 for p in pieces])
            at = []
            for size, ids in ((self.len_a, ids_a), (self.len_b, ids_b)):
                ends = np.cumsum(size[ids])
                upto = np.searchsorted(ends, end)
                if not (ends[np.minimum(upto, len(ends) - 1)] == end).all():
                    break
                at.append(np.concatenate(([0], upto + 1)))
            else:
                return (ids_a, at[0]), (ids_b, at[1])
        return self._one_by_one(pieces)

    def _one_by_one(self, pieces: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        a, b = [self._a.encode_ordinary(" " + p) for p in pieces], self._b.encode(pieces, num_threads=1)
        for k, p in enumerate(pieces):
            want = (" " + p).encode()
            if b"".join(map(self.bytes_b.__getitem__, b[k])) != want or b"".join(map(self.bytes_a.__getitem__, a[k])) != want:
                a[k], b[k] = [], []
        return _flat(a), _flat(b)


@lru_cache(maxsize=2)
def tokenizers(folder: str) -> Tokenizers:
    return Tokenizers(folder)


def lockstep(size_a: np.ndarray, at_a: np.ndarray, size_b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of all lanes: ``size_*`` are the bytes of the lanes'
    tokens in a row, ``at_*`` where each lane begins in them.  Returns the
    lane, A place, B place of each link and whether a group ends with it, in
    the order of lanes and bytes.  A lane's A and B tokens have equal bytes."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    lane = np.flatnonzero(np.diff(at_a) > 0)
    i, j, last = at_a[lane], at_b[lane], at_a[lane + 1]
    # ends count from the lane's own first byte
    from_a, from_b = (end_a[i] - size_a[i], end_b[j] - size_b[j]) if len(lane) else (i, j)
    links: list[tuple[np.ndarray, ...]] = []
    while len(lane):
        here, there = end_a[i] - from_a, end_b[j] - from_b
        cut = here == there
        links.append((lane, i, j, cut))
        i, j = i + (here <= there), j + (there <= here)
        live = i < last
        if not live.all():
            lane, i, j, last, from_a, from_b = (x[live] for x in (lane, i, j, last, from_a, from_b))
    if not links:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    lanes, a, b, cuts = (np.concatenate(x) for x in zip(*links, strict=True))
    by = np.lexsort((a + b, lanes))
    return lanes[by], a[by], b[by], cuts[by]


class Pieces:
    """Pieces of texts with their alignment, numbered as they come."""

    def __init__(self, tools: Tokenizers):
        self.tools, self.number, self.held = tools, {}, 0
        self.groups: list[str] = []
        self.links, self.at, self.shape = np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros((0, 4), np.int64)

    def numbers(self, texts: list[list[str]]) -> np.ndarray:
        """The numbers of all pieces of ``texts`` in a row; new ones are aligned."""
        known = self.number
        new = list({p for ps in texts for p in ps if p not in known})
        if new:
            self._align(new)
        return np.fromiter((known[p] for ps in texts for p in ps), np.int64)

    def _align(self, new: list[str]) -> None:
        odd = list(filter(_EDGE.search, new))
        plain = list(set(new).difference(odd)) if odd else new
        for some, encode in ((plain, self.tools.encode), (odd, self.tools._one_by_one)):
            if some:
                self._add(some, *encode(some))

    def _add(self, new: list[str], a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> None:
        (ids_a, at_a), (ids_b, at_b), n = a, b, len(new)
        lane, i, j, cut = lockstep(self.tools.len_a[ids_a], at_a, self.tools.len_b[ids_b], at_b)
        cuts, count = np.bincount(lane[cut], minlength=n), np.bincount(lane, minlength=n)
        self.shape = np.concatenate([self.shape, np.stack([np.diff(at_a), np.diff(at_b), cuts, count], axis=1)])
        self.links = np.concatenate([self.links, ids_a[i] * self.tools.size_b + ids_b[j]])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(count)])
        texts = iter(self._texts(ids_a, ids_b, i[cut], j[cut], np.diff(lane[cut], append=-1) != 0))
        self.groups += [next(texts) if c else "" for c in cuts.tolist()]
        self.number.update(zip(new, range(len(self.number), len(self.number) + n), strict=True))
        self.held += sum(map(len, new)) + 8 * n

    def _texts(self, ids_a: np.ndarray, ids_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, last: np.ndarray) -> list[str]:
        """The groups of each piece that has tokens: a group's A tokens, its B
        tokens, the next group's; ``end`` is the last token of each group."""
        say_a, say_b = self.tools.say_a, self.tools.say_b
        close_a, close_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        close_a[end_a] = 1
        close_b[end_b] = 1 + last
        group = np.concatenate([np.cumsum(close_a) - close_a, np.cumsum(close_b > 0) - (close_b > 0)])
        words = ([say_a[k][x] for x, k in zip(ids_a.tolist(), close_a.tolist(), strict=True)]
                 + [say_b[k][x] for x, k in zip(ids_b.tolist(), close_b.tolist(), strict=True)])
        return "".join(map(words.__getitem__, np.argsort(group, kind="stable").tolist())).split("\n")[:-1]

    def links_of(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of the pieces ``used`` in a row, and how many each has."""
        count = self.at[used + 1] - self.at[used]
        start = np.cumsum(count) - count
        return self.links[np.arange(int(count.sum())) + np.repeat(self.at[used] - start, count)], count


_HELD: dict[str, Pieces] = {}


def held_pieces(folder: str) -> Pieces:
    """The worker's pieces, begun anew where they are too many."""
    now = _HELD.get(folder)
    if now is None or now.held > CACHE:
        now = _HELD[folder] = Pieces(tokenizers(folder))
    return now


class Batch:
    """The documents of a batch as numbers of pieces."""

    def __init__(self, texts: list[str | None], folder: str):
        self.pieces = p = held_pieces(folder)
        split = [pieces_of(t) if t else [] for t in texts]
        numbers, self.size = p.numbers(split), np.array([len(s) for s in split], np.int64)
        doc = np.repeat(np.arange(len(texts)), self.size)
        # a document with a piece whose bytes differ has no tokens
        bad = np.bincount(doc[p.shape[numbers, 0] == 0], minlength=len(texts)) > 0
        self.numbers, self.doc = numbers[~bad[doc]], doc[~bad[doc]]
        self.size[bad] = 0

    def sums(self, of_piece: np.ndarray) -> np.ndarray:
        """For each document, the sum of a value of its pieces."""
        upto = np.concatenate(([0], np.cumsum(of_piece[self.numbers])))
        end = np.cumsum(self.size)
        return upto[end] - upto[end - self.size]


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)


def _batches(df: DataFrame, fn, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays([as_array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return df.mapInArrow(run, schema)


def pair_counts(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``(pair, n)``: how many links hold an id pair, over all documents;
    ``pair`` is the A id times the size of B, and the B id."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        pairs: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch in batches:
            b = Batch(column(batch, "text").to_pylist(), folder)
            used, times = np.unique(b.numbers, return_counts=True)
            found, count = b.pieces.links_of(used)
            pairs.append(found)
            counts.append(np.repeat(times, count))
            if sum(map(len, pairs)) > PAIRS_HELD:
                keys, n = _summed(pairs, counts)
                pairs, counts = [keys], [n]
                if len(keys) > PAIRS_HELD // 2:
                    yield keys, n
                    pairs, counts = [], []
        if pairs:
            yield _summed(pairs, counts)

    rows = _batches(docs.select("text"), run, "pair long, n long", [pa.int64(), pa.int64()])
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


_SHAPE = "n_a long, n_b long, n_groups long, n_links long, groups string"
_SHAPE_KINDS = [pa.int64()] * 4 + [pa.string()]


def _shapes(b: Batch) -> list:
    text, end = [], np.cumsum(b.size).tolist()
    numbers, groups = b.numbers.tolist(), b.pieces.groups
    for e, n in zip(end, b.size.tolist(), strict=True):
        text.append(";".join(map(groups.__getitem__, numbers[e - n:e])))
    return [*(b.sums(b.pieces.shape[:, k]) for k in range(4)), text]


def _hashed(shapes: list) -> list:
    return [*shapes[:4], [sha256(x.encode()).hexdigest() if x else "" for x in shapes[4]]]


def groups(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups)``: the groups of each
    document as ``a1,a2|b1;a3|b2,b3``, decimal ids in order."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield [column(batch, "doc_id"), *_shapes(Batch(column(batch, "text").to_pylist(), folder))]

    return _batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, " + _SHAPE, [pa.int64(), *_SHAPE_KINDS])


def aligned(docs: DataFrame, folder: str = TOKENIZERS, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best,
    count_sum)`` for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    counts = written(pair_counts(docs, folder), "pairs")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size_b = tokenizers(folder).size_b
    best = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("best"))
    if counts.count() > most_pairs:
        return _joined(rows, counts, best, folder, size_b)
    table = counts.orderBy("pair").toArrow()
    keys, n = (table.column(c).to_numpy() for c in ("pair", "n"))
    top = np.zeros(size_b, np.int64)
    np.maximum.at(top, keys % size_b, n)
    shared = spark.sparkContext.broadcast((keys, n, n == top[keys % size_b]))

    def run(batches):
        keys, n, is_best = shared.value
        for batch in batches:
            b = Batch(column(batch, "text").to_pylist(), folder)
            used = np.unique(b.numbers)
            found, count = b.pieces.links_of(used)
            where = np.searchsorted(keys, found)
            end = np.cumsum(count)
            per_piece = []
            for value in (is_best, n):
                upto = np.concatenate(([0], np.cumsum(value[where], dtype=np.int64)))
                all_ = np.zeros(len(b.pieces.groups), np.int64)
                all_[used] = upto[end] - upto[end - count]
                per_piece.append(b.sums(all_))
            yield [column(batch, "doc_id"), *_hashed(_shapes(b)), *per_piece]

    schema = "doc_id long, " + _SHAPE.replace("groups string", "groups_sha256 string") + ", n_best long, count_sum long"
    return _batches(rows, run, schema, [pa.int64(), *_SHAPE_KINDS, pa.int64(), pa.int64()])


def _joined(rows: DataFrame, counts: DataFrame, best: DataFrame, folder: str, size_b: int) -> DataFrame:
    """As ``aligned`` for more pairs than a task should hold: each document's
    pairs meet their counts in a join.  Pairs are unique in ``counts``, so a
    pair of very many documents is split by the engine like any skewed key."""
    schema = ("row struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>, "
              "k long, pairs array<struct<pair:bigint,times:bigint>>")
    kind = pa.struct([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])
    pair = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = Batch(column(batch, "text").to_pylist(), folder)
            shapes = [as_array(x, k.type) for x, k in zip([column(batch, "doc_id"), *_hashed(_shapes(b))], kind, strict=True)]
            end, found = np.cumsum(b.size), []
            for e, n in zip(end.tolist(), b.size.tolist(), strict=True):
                keys, times = np.unique(b.pieces.links_of(b.numbers[e - n:e])[0], return_counts=True)
                found.append([{"pair": p, "times": t} for p, t in zip(keys.tolist(), times.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(shapes, fields=list(kind)), column(batch, "k"), pa.array(found, pair)], names=["row", "k", "pairs"])

    # a number for each row, kept in a written table: equal rows stay apart
    told = written(rows.withColumn("k", F.monotonically_increasing_id()).mapInArrow(run, schema), "aligned")
    known = counts.withColumn("b", F.col("pair") % size_b).join(best, "b").select("pair", "n", (F.col("n") == F.col("best")).alias("is_best"))
    sums = (told.select("k", F.inline("pairs")).join(known, "pair").groupBy("k")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    return (told.select("k", "row.*").join(sums, "k", "left").drop("k")
            .withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}))


def digest(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """The fixed columns of ``op13_token_alignment``."""
    return aligned(docs, folder).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
