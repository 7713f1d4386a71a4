"""Personal data: candidate spans, boosted trees and calibrated thresholds.

High-recall generators propose spans of four kinds (email, ip, card, phone),
also overlapping ones.  Boosted trees score each span by its format and its
context, a calibration turns scores into probabilities, and a threshold for
each kind, set for precision on spans held out of training, selects the
redactions.  Spans that match a kind's base format and pass its check are
always selected; the trees add spans of looser formats.

The trees are trained on candidates of a bounded sample of documents
(``TRAIN_DOCS``, ``TRAIN_SPANS``).  Candidates that pass a base check are
positive, those that fail one negative; both are joined by rewritten forms of
the positives (other separators, no country code) and by number formats that
are no personal data (dates, versions, prices, broken check digits).

Every pattern is linear in the text: none can start again inside a run that
it has read.  Whole texts are read.

Defined cases: null or empty text has no spans; equal rows are found one by
one; a table without candidates to learn from selects base spans only; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, in_arrow, small_batches

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS, TRAIN_SPANS = 20_000, 6_000
PRECISION = 0.99
SEED = 11

# -- candidates ------------------------------------------------------------------

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_TRIGGER = re.compile(r"[0-9@]|[(\[] ?(?:at|AT) ?[)\]]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_BASE = {
    # a run of digits is read from its start only: what follows it is the same from inside
    "ip": re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"),
    "card": re.compile(r"[0-9](?:[ -]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][ ().0-9-]+[0-9]"),
}
_LOOSE = {
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:[. /_-]{1,2}[0-9]{4}){2}[. /_-]{1,2}[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9.+-])(?:(?:00)?[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9]|[.-][0-9])"),
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[] ?(?:at|AT) ?[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[] ?(?:dot|DOT) ?[)\]]) ?[A-Za-z0-9-]{1,63}){1,4}"),
}


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``,
    found from each ``@`` so that long runs are read once."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    return out


def digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = sum(map(int, number[-1::-2]))
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in number[-2::-2])) % 10 == 0


def passes(kind: str, span: str) -> bool:
    """The base check of a span that matches its kind's base format."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in span.split("."))
    if kind == "card":
        return 16 <= len(d := digits(span)) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(digits(span)) <= 15
    return True


@dataclass(frozen=True)
class Span:
    kind: int
    start: int
    end: int
    base: bool


def overlap(a: Span, b: Span) -> bool:
    return a.start < b.end and b.start < a.end


def candidates(text: str) -> list[Span]:
    """All proposed spans; ``base`` marks those of the base rules."""
    if not _TRIGGER.search(text):
        return []
    out = [Span(0, a, b, True) for a, b in emails(text)]
    for kind, pattern in _BASE.items():
        out += [Span(KINDS.index(kind), m.start(), m.end(), passes(kind, m.group())) for m in pattern.finditer(text)]
    known = {(s.kind, s.start, s.end) for s in out}
    for kind, pattern in _LOOSE.items():
        k = KINDS.index(kind)
        out += [Span(k, m.start(), m.end(), False) for m in pattern.finditer(text) if (k, m.start(), m.end()) not in known]
    return out


# -- features --------------------------------------------------------------------

#: Fixed cue words: what people write before an address or a number.
_CUES = (
    ("mail", "email", "e-mail", "contact", "write"),
    ("ip", "host", "server", "address", "addr"),
    ("card", "visa", "mastercard", "amex", "credit", "payment"),
    ("phone", "tel", "call", "mobile", "fax", "cell", "telephone"),
)
_NOT = ("version", "date", "isbn", "price", "page", "id", "no", "order", "total", "year")


def features(text: str, s: Span) -> list[float]:
    span = text[s.start:s.end]
    number = digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span[:200])] or [0]
    before = re.findall(r"[\w-]+", text[max(0, s.start - 40):s.start].lower())[-3:]
    edge = [text[i] if 0 <= i < len(text) else " " for i in (s.start - 1, s.end)]
    host = span.rpartition("@")[2] if "@" in span else ""
    return [
        *[float(s.kind == k) for k in range(len(KINDS))],
        float(min(len(span), 200)), float(min(len(number), 60)), len(number) / len(span),
        *[float(min(span.count(c), 20)) for c in " -.(+:@"],
        float(len(groups)), float(min(max(groups), 60)), float(min(groups)), float(np.std(groups)),
        float(luhn(number)) if 12 <= len(number) <= 19 else -1.0,
        float(max(int(g) for g in re.findall(r"[0-9]{1,9}", span[:200]) or ["0"]) <= 255),
        float(len(set(number))), float(len(host.rpartition(".")[2])) if host else -1.0,
        *[float(c.isalnum()) for c in edge], *[float(c.isspace()) for c in edge], *[float(c in "$€£#/=%_") for c in edge],
        *[float(any(w in cue for w in before)) for cue in _CUES], float(any(w in _NOT for w in before)),
        float(int(number[:4]) in range(1900, 2100)) if len(number) >= 4 else 0.0,
    ]


# -- boosted trees -----------------------------------------------------------------

@dataclass
class Tree:
    """A regression tree in arrays; a leaf has feature -1."""
    feature: list[int]
    cut: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(x[rows, feature[node]] <= cut[node], left[node], right[node])
        return np.array(self.value)[at]


def grown(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, l2: float = 1.0) -> Tree:
    """A tree of Newton steps: splits of the largest gain, leaves ``-G/(H+l2)``."""
    tree = Tree([], [], [], [], [])

    def grow(rows: np.ndarray, level: int) -> int:
        node = len(tree.feature)
        for part, v in zip((tree.feature, tree.cut, tree.left, tree.right, tree.value),
                           (-1, 0.0, -1, -1, -g[rows].sum() / (h[rows].sum() + l2)), strict=True):
            part.append(v)
        best = (1e-6, -1, 0.0)
        if level < depth and len(rows) > 8:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + l2)
            for f in range(x.shape[1]):
                order = rows[np.argsort(x[rows, f], kind="stable")]
                v = x[order, f]
                cuts = np.flatnonzero(v[1:] > v[:-1])
                if len(cuts):
                    gl, hl = np.cumsum(g[order])[cuts], np.cumsum(h[order])[cuts]
                    gain = gl ** 2 / (hl + l2) + (g[rows].sum() - gl) ** 2 / (h[rows].sum() - hl + l2) - whole
                    i = int(np.argmax(gain))
                    if gain[i] > best[0]:
                        best = (float(gain[i]), f, float(v[cuts[i]] + v[cuts[i] + 1]) / 2)
        if best[1] >= 0:
            side = x[rows, best[1]] <= best[2]
            tree.feature[node], tree.cut[node] = best[1], best[2]
            tree.left[node] = grow(rows[side], level + 1)
            tree.right[node] = grow(rows[~side], level + 1)
        return node

    grow(np.arange(len(x)), 0)
    return tree


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    trees: list[Tree]
    start: float
    scale: tuple[float, float]
    limits: list[float]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((0.2 * t.predict(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return sigmoid(a * self.raw(x) + b)


def boosted(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, precision: float = PRECISION) -> Model:
    """Trees from two thirds of the spans; calibration and the threshold of
    each kind from the rest."""
    held = np.random.default_rng(SEED).random(len(y)) < 1 / 3
    xt, yt = x[~held], y[~held]
    rate = float(np.clip(yt.mean(), 0.01, 0.99))
    model = Model([], float(np.log(rate / (1 - rate))), (1.0, 0.0), [2.0] * len(KINDS))
    score = np.full(len(yt), model.start)
    for _ in range(rounds):
        p = sigmoid(score)
        model.trees.append(grown(xt, p - yt, p * (1 - p), depth))
        score += 0.2 * model.trees[-1].predict(xt)
    raw, yh = model.raw(x[held]), y[held]
    a, b = 1.0, 0.0
    for _ in range(50):  # Platt's two numbers by Newton steps, held near (1, 0)
        p = sigmoid(a * raw + b)
        w = p * (1 - p)
        grad = np.array([((p - yh) * raw).sum() + a - 1, (p - yh).sum() + b])
        hess = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
    model.scale = (float(a), float(b))
    p = model.probability(x[held])
    for k in range(len(KINDS)):
        own = x[held][:, k] == 1
        for limit in np.unique(np.concatenate((p[own], [0.5]))):
            chosen = own & (p >= limit)
            if limit >= 0.5 and chosen.sum() >= 20 and yh[chosen].mean() >= precision:
                model.limits[k] = float(limit)
                break
    return model


# -- training spans ----------------------------------------------------------------

def rewritten(kind: int, span: str, rng: np.random.Generator) -> list[tuple[str, int]]:
    """Other forms of a positive span, and lookalikes that are none."""
    number = digits(span)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    random = "".join(map(str, rng.integers(0, 10, 20)))
    if KINDS[kind] == "phone" and len(number) >= 10:
        a, b, c = number[-10:-7], number[-7:-4], number[-4:]
        sep = pick("-", ".", " ")
        return [(f"({a}) {b}-{c}", 1), (f"{a}{sep}{b}{sep}{c}", 1),
                (f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}", 0),
                (f"{random[:3]}.{random[3:6]}.{random[6:9]}.{random[9:12]}", 0), (random[:10], 0)]
    if KINDS[kind] == "card" and len(number) >= 16:
        sep = pick(".", "/", "_", "  ", "-")
        broken = number[:-1] + str((int(number[-1]) + int(rng.integers(1, 10))) % 10)
        return [(sep.join(number[i:i + 4] for i in range(0, len(number), 4)), 1),
                (sep.join(broken[i:i + 4] for i in range(0, len(broken), 4)), 0), (broken, 0)]
    if KINDS[kind] == "ip":
        v6 = ":".join(f"{x:04x}" for x in rng.integers(0, 65536, 8))
        high, low = rng.integers(256, 1000, 3), rng.integers(0, 256, 3)
        return [(v6, 1), *[(f"{a}.{low[0]}.{low[1]}.{low[2]}", 0) for a in high[:2]], (f"{low[0]}.{low[1]}.{high[2]}.{low[2]}", 0), (f"{random[0]}.{random[1]}.{random[2]}", 0)]
    if KINDS[kind] == "email":
        user, _, host = span.partition("@")
        name, _, tld = host.rpartition(".")
        return [(f"{user} {pick('[at]', '(at)', '[ at ]')} {name}{pick('.', ' [dot] ', ' (dot) ')}{tld}", 1), (f"{user}@{name.split('.')[0]}", 0)]
    return []


def training_rows(text: str, seed: int) -> tuple[list[list[float]], list[int]]:
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    found = candidates(text)
    firm = [s for s in found if s.base]
    for s in found:
        if not s.base and (any(overlap(s, b) and b.kind == s.kind for b in firm)
                           or KINDS[s.kind] not in ("card", "ip") and not any(overlap(s, b) for b in firm)):
            continue  # part of a span of its kind, or neither passed nor failed a check
        xs.append(features(text, s))
        ys.append(int(s.base))
        if s.base:
            head, tail = text[max(0, s.start - 60):s.start], text[s.end:s.end + 60]
            for form, label in rewritten(s.kind, text[s.start:s.end], rng):
                put = head + form + tail
                for c in candidates(put):
                    if c.start < len(head) + len(form) and c.end > len(head):
                        whole = c.start == len(head) and c.end == len(head) + len(form)
                        xs.append(features(put, c))
                        ys.append(int(label and whole and c.kind == s.kind))
    return xs, ys


def trained(docs: DataFrame, most_docs: int = TRAIN_DOCS, most_spans: int = TRAIN_SPANS) -> Model | None:
    """The model of a bounded sample: documents of the least hashes, spans of
    the least hashes among theirs.  None without both classes."""
    spark = docs.sparkSession
    small_batches(spark)
    key = F.xxhash64(F.lit(SEED), "doc_id", "text")
    share = min(1.0, most_docs / max(1, docs.count()))
    some = docs.select(key.alias("h"), "text").where(F.col("text").rlike("[0-9@]"))
    some = some.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))

    def rows(batch: pa.RecordBatch) -> dict:
        h, x, y = [], [], []
        for seed, text in zip(column(batch, "h").to_pylist(), column(batch, "text").to_pylist(), strict=True):
            fx, fy = training_rows(text, seed % (1 << 32))
            h += [int.from_bytes(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=7).digest()) for i in range(len(fx))]
            x += fx
            y += fy
        return {"h": h, "x": x, "y": y}

    got = in_arrow(some, rows, "h long, x array<double>, y int").orderBy("h").limit(most_spans).collect()
    if len({r.y for r in got}) < 2:
        return None
    return boosted(np.array([r.x for r in got]), np.array([r.y for r in got], float))


# -- selection ---------------------------------------------------------------------

def selected(text: str, model: Model | None) -> tuple[list[Span], list[Span]]:
    """The base spans and all selected spans, by kind and start.  A span of the
    trees gives way to any base span and to a likelier span that it overlaps."""
    found = candidates(text)
    base = [s for s in found if s.base]
    more = [s for s in found if not s.base]
    chosen = list(base)
    if more and model is not None:
        p = model.probability(np.array([features(text, s) for s in more]))
        for i in np.argsort(-p, kind="stable"):
            s = more[i]
            if p[i] >= model.limits[s.kind] and not any(overlap(s, c) for c in chosen):
                chosen.append(s)
    order = lambda s: (s.kind, s.start, s.end)
    return sorted(base, key=order), sorted(chosen, key=order)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each selected span replaced by its kind in brackets;
    overlapping spans become one, named by the first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at:s.start], f"[{KINDS[s.kind].upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, model: Model | None = None, redact: bool = False) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans[, redacted])``
    for each document; the model is trained on ``docs`` if none is given."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = trained(docs) if model is None else model
    small_batches(docs.sparkSession)
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string" + ", redacted string" * redact

    def find(batch: pa.RecordBatch) -> dict:
        texts = [x or "" for x in column(batch, "text").to_pylist()]
        both = [selected(t, model) for t in texts]
        out = {"doc_id": column(batch, "doc_id"), "base": [listed(b) for b, _ in both], "spans": [listed(s) for _, s in both]}
        if redact:
            out["redacted"] = [redacted(t, s) for t, (_, s) in zip(texts, both, strict=True)]
        return out | {f"n_{k}": [sum(s.kind == i for s in b) for b, _ in both] for i, k in enumerate(KINDS)}

    return in_arrow(docs, find, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    return find_pii(docs).select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")
