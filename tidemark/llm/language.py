"""Language ID: a bidirectional gated recurrent network over bytes.

Texts are cut into segments of ``SEGMENT`` bytes; a network reads each segment
from both ends and gives every byte a distribution over the languages.  A
document's probabilities are the mean over its letters, and whole texts are
read.  The network is trained in numpy by backpropagation through time on
segments from a bounded sample of labelled documents (``TRAIN_DOCS`` of each
language), at random places of their texts.

Only the text is an input of a prediction.  A document is held out of training
where ``crc32`` of its id as text leaves 1 when divided by 3.

Defined cases: a null text or one without letters is ``und`` with score 0; a
null ``doc_id`` is not held out and never learned from; without a labelled
document all are ``und``; with one language all texts with letters are that
language; equal rows are predicted one by one; an empty table gives an empty
result; other columns are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, column_bytes, fields, in_arrow, small_batches
from tidemark.operators.joins import join_small

UNKNOWN = "und"
HELD_OUT_OF = 3
SEGMENT = 96
HIDDEN = 12
#: Documents of each language that training may see, and segments of each.
TRAIN_DOCS, TRAIN_SEGMENTS = 800, 8
SHORTEST = 8
STEPS, BATCH = 700, 128
SEED = 5
#: Segments that the network reads at once; bounds memory for long texts.
READ = 1024
#: One in so many training documents is kept out of the steps: the least score
#: of its pieces is the network's ``floor``, below which a pipeline rejects.
KEPT_OUT = 8


def _byte_classes() -> np.ndarray:
    """Bytes with case folded, also in the second byte of Latin letters, and
    with digits, blanks and ASCII signs made one class each."""
    out = np.arange(256, dtype=np.uint8)
    out[:128] = ord(".")
    out[[9, 10, 11, 12, 13, 32]] = ord(" ")
    out[ord("0"):ord("9") + 1] = ord("0")
    lower = np.arange(ord("a"), ord("z") + 1)
    out[lower] = lower
    out[lower - 32] = lower
    return out


BYTE_CLASS = _byte_classes()
#: Bytes that count for a document: ASCII letters and all of other characters.
COUNTS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def classes(text: np.ndarray) -> np.ndarray:
    out = BYTE_CLASS[text]
    folded = np.flatnonzero(text[:-1] == 0xC3) + 1  # U+00C0 to U+00DE
    folded = folded[(out[folded] >= 0x80) & (out[folded] <= 0x9E)]
    out[folded] += 0x20
    return out


# -- network ------------------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Gru:
    """One direction: ``w`` has the input weights and biases of the update,
    reset and new gates for each byte class, ``u`` those of the state, ``b``
    the state's bias in the new gate."""
    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def states(self, x: np.ndarray, back: bool = False) -> Iterator[tuple[int, np.ndarray]]:
        """Steps and states after them for ``x`` (steps, segments), from the
        end if ``back``.  States are (units, segments), so that each gate is
        one run of memory; the array is used again by the next step."""
        size, n = len(self.b), x.shape[1]
        # gates by tanh of half the sum: the half is taken into the weights
        half = np.concatenate((np.full(2 * size, 0.5), np.ones(size))).astype(np.float32)
        w, u = (np.ascontiguousarray((m * half).T.astype(np.float32)) for m in (self.w, self.u))
        b = self.b[:, None].astype(np.float32)
        h, a, s = np.zeros((size, n), np.float32), np.empty((3 * size, n), np.float32), np.empty((3 * size, n), np.float32)
        for t in range(len(x) - 1, -1, -1) if back else range(len(x)):
            np.take(w, x[t], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=s)
            zr = a[:2 * size]
            zr += s[:2 * size]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            new = s[2 * size:]
            new += b
            new *= zr[size:]
            new += a[2 * size:]
            np.tanh(new, out=new)
            h -= new
            h *= zr[:size]
            h += new
            yield t, h

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """``states`` with what the backward pass needs."""
        size = len(self.b)
        h, out, tape = np.zeros((x.shape[1], size), np.float32), [], []
        for t in range(len(x)):
            a, s = self.w[x[t]], h @ self.u
            zr = sigmoid(a[:, :2 * size] + s[:, :2 * size])
            z, r = zr[:, :size], zr[:, size:]
            inner = s[:, 2 * size:] + self.b
            n = np.tanh(a[:, 2 * size:] + r * inner)
            tape.append((h, z, r, n, inner))
            h = n + z * (h - n)
            out.append(h)
        return np.stack(out), tape

    def backward(self, x: np.ndarray, tape: list, grad: np.ndarray) -> Gru:
        """Gradients through time for ``grad`` with respect to the states."""
        du, db = np.zeros_like(self.u), np.zeros_like(self.b)
        inputs = np.empty((*x.shape, self.u.shape[1]), self.u.dtype)
        carry = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, inner = tape[t]
            dh = grad[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            ds = np.concatenate((dz, dr, dn * r), axis=1)
            inputs[t] = np.concatenate((dz, dr, dn), axis=1)
            du += h.T @ ds
            db += (dn * r).sum(axis=0)
            carry = dh * z + ds @ self.u.T
        dw = np.zeros_like(self.w)
        np.add.at(dw, x.ravel(), inputs.reshape(-1, inputs.shape[-1]))
        return Gru(dw, du, db)


@dataclass
class Network:
    ahead: Gru
    back: Gru
    v: np.ndarray
    c: np.ndarray
    languages: list[str]
    #: The least score of labelled pieces that took no part in training.
    floor: float = 0.0

    def parts(self) -> list[np.ndarray]:
        return [*(p for g in (self.ahead, self.back) for p in (g.w, g.u, g.b)), self.v, self.c]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED, kind=np.float32) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(kind)
        one = lambda: Gru(draw(256, 3 * hidden), draw(hidden, 3 * hidden), np.zeros(hidden, kind))
        return cls(one(), one(), draw(2 * hidden, len(languages)), np.zeros(len(languages), kind), languages)

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at each byte of ``x`` (segments, bytes)."""
        steps, size = np.ascontiguousarray(x.T), len(self.ahead.b)
        p = np.empty((x.shape[1], len(self.c), len(x)), np.float32)
        p[:] = self.c[None, :, None]
        for gru, v, back in ((self.ahead, self.v[:size], False), (self.back, self.v[size:], True)):
            v = np.ascontiguousarray(v.T)
            for t, h in gru.states(steps, back):
                p[t] += v @ h
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p.transpose(2, 0, 1)

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss at the weighted bytes of ``x`` and its gradient by ``parts``."""
        steps, weight = np.ascontiguousarray(x.T), weight.T / max(weight.sum(), 1)
        back_steps = np.ascontiguousarray(steps[::-1])
        hf, tape_f = self.ahead.forward(steps)
        hb, tape_b = self.back.forward(back_steps)
        h = np.concatenate((hf, hb[::-1]), axis=2)
        logits = h @ self.v + self.c
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        own = np.take_along_axis(p, np.broadcast_to(y[None, :, None], (*steps.shape, 1)), axis=2)[..., 0]
        loss = float(-(np.log(own + 1e-12) * weight).sum())
        d = p
        d[:, np.arange(len(y)), y] -= 1
        d = (d * weight[..., None]).astype(self.v.dtype)
        dh = d @ self.v.T
        size = len(self.ahead.b)
        gf = self.ahead.backward(steps, tape_f, dh[..., :size])
        gb = self.back.backward(back_steps, tape_b, dh[::-1, :, size:])
        dv = h.reshape(-1, h.shape[2]).T @ d.reshape(-1, d.shape[2])
        return loss, [gf.w, gf.u, gf.b, gb.w, gb.u, gb.b, dv, d.sum(axis=(0, 1))]


def segments(texts: list[bytes], size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte classes (segments, size), the bytes that count, and each segment's
    text.  The last segment of a text is filled up with blanks."""
    counts = [-(-len(t) // size) for t in texts]
    whole = np.frombuffer(b"".join(t.ljust(n * size) for t, n in zip(texts, counts, strict=True)), np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    return classes(whole).reshape(-1, size), COUNTS[whole].reshape(-1, size), owner


def trained(rows: list[tuple[bytes, str]], steps: int = STEPS, batch: int = BATCH, seed: int = SEED) -> Network | None:
    """The network of labelled pieces of text, by Adam."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    net = Network.fresh(languages, seed=seed)
    if len(languages) == 1:
        return net
    x, weight, owner = segments([t for t, _ in rows])
    y = np.array([languages.index(lang) for _, lang in rows])[owner]
    rng = np.random.default_rng(seed)
    # the same number of segments of each language
    pools = [np.flatnonzero(y == i) for i in range(len(languages))]
    pools = [p for p in pools if len(p)]
    parts = net.parts()
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(p, max(1, batch // len(pools))) for p in pools])
        _, grads = net.gradient(x[pick], y[pick], weight[pick].astype(np.float32))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1.0, 3 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(parts, grads, m, v, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return net


# -- documents ------------------------------------------------------------------------

def held_out() -> Column:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(rest == 1, F.lit(False))


def fit(docs: DataFrame, most_docs: int = TRAIN_DOCS, pieces: int = TRAIN_SEGMENTS, seed: int = SEED) -> Network | None:
    """Train on pieces of about ``most_docs`` documents of each language,
    those of the least hashes among what isn't held out."""
    small_batches(docs.sparkSession)
    usable = docs.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy(F.col("lang").cast("string").alias("lang")).count()
    share = counts.select("lang", F.least(F.lit(1.0), F.lit(float(most_docs)) / F.col("count")).alias("share"))
    rank = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30))
    # a row a language: broadcast after a check of its size, so that no text is moved by its language
    some = (join_small(usable.select(F.col("lang").cast("string").alias("lang"), rank.alias("rank"), "text"), share, "lang")
            .where(F.col("rank") < F.col("share") * (1 << 30)).select("lang", "rank", "text"))

    def cut(batch: pa.RecordBatch) -> dict:
        out = {"lang": [], "rank": [], "piece": []}
        for lang, rank, text in zip(column(batch, "lang").to_pylist(), column(batch, "rank").to_pylist(), column_bytes(batch, "text"), strict=True):
            rng = np.random.default_rng(rank)
            starts = rng.integers(0, max(1, len(text) - SEGMENT + 1), pieces)
            # every other piece is short, as short texts and ends of texts are
            sizes = np.where(np.arange(pieces) % 2, rng.integers(SHORTEST, SEGMENT, pieces), SEGMENT)
            for a, n in sorted(set(zip(starts.tolist(), sizes.tolist(), strict=True))):
                out["lang"].append(lang)
                out["rank"].append(rank)
                out["piece"].append(text[a:a + n])
        return out

    rows = in_arrow(some, cut, "lang string, rank long, piece binary").collect()
    rows = sorted((r.lang, r.rank, bytes(r.piece)) for r in rows)
    # a language of few documents is learnt from all of them
    learnt = {lang for lang, rank, _ in rows if rank % KEPT_OUT}
    out = {(lang, rank) for lang, rank, _ in rows if rank % KEPT_OUT == 0 and lang in learnt}
    net = trained([(piece, lang) for lang, rank, piece in rows if (lang, rank) not in out])
    check = [piece for lang, rank, piece in rows if (lang, rank) in out and has_letters(piece)]
    if net is not None and check:
        net.floor = float(probabilities(net, check).max(axis=1).min())
    return net


def has_letters(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities of each text over its bytes that count."""
    total = np.zeros((len(texts), len(net.languages)))
    counted = np.zeros(len(texts))
    group: list[int] = []

    def read() -> None:
        x, weight, owner = segments([texts[i] for i in group])
        owner = np.array(group)[owner]
        for a in range(0, len(x), READ):
            w = weight[a:a + READ]
            p = (net.label(x[a:a + READ]) * w[..., None]).sum(axis=1)
            for k in range(p.shape[1]):
                total[:, k] += np.bincount(owner[a:a + READ], p[:, k], len(texts))
            counted[:] += np.bincount(owner[a:a + READ], w.sum(axis=1), len(texts))

    held = 0
    for i, text in enumerate(texts):
        group.append(i)
        held += len(text) // SEGMENT + 1
        if held >= READ or i + 1 == len(texts):
            read()
            group.clear()
            held = 0
    return total / np.maximum(counted, 1)[:, None]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` (``text``, ``row``) with ``lang_pred`` and ``score``."""
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        texts = column_bytes(batch, "text")
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if net is not None and has_letters(t)]
        if rows:
            p = probabilities(net, [texts[i] for i in rows])
            for i, own in zip(rows, p, strict=True):
                best = int(own.argmax())
                lang[i], score[i] = net.languages[best], float(min(1.0, max(0.0, own[best])))
        return {"row": column(batch, "row"), "text": column(batch, "text"), "lang_pred": lang, "score": score}

    return in_arrow(docs.select("row", "text"), run, fields(docs.schema["row"].dataType, "text string, lang_pred string, score double"))


def identified(docs: DataFrame, net: Network | None) -> DataFrame:
    """``(row, text, lang_pred, score)`` for each document; ``row`` has its
    other columns.  Without a network (nothing to learn from) all are ``und``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return predict(docs.select(F.struct(*rest).alias("row"), "text"), net)


def language_spans(net: Network, text: bytes) -> list[tuple[int, int, str]]:
    """Runs of bytes by their most probable language, blanks and signs going
    with the run before them."""
    if not text:
        return []
    x, weight, _ = segments([text])
    best = np.concatenate([net.label(x[a:a + READ]).argmax(axis=2) for a in range(0, len(x), READ)]).ravel()[:len(text)]
    counts = weight.ravel()[:len(text)]
    where = np.flatnonzero(counts)
    if not len(where):
        return []
    edges = where[np.flatnonzero(np.diff(best[where])) + 1]
    bounds = [0, *edges.tolist(), len(text)]
    return [(a, b, net.languages[int(best[max(a, where[0])])]) for a, b in zip(bounds, bounds[1:], strict=False)]


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    net = fit(known)
    out = identified(known.select("doc_id", "text"), net)
    return (out.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
