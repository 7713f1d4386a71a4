import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii
from tests.llm.cases import SF, documents, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            span, number = m.group(), re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in span.split(".")) or kind == "card" and 16 <= len(number) <= 19 and luhn(number)
                    or kind == "phone" and 8 <= len(number) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+-() 25é", max_size=40))
def test_base_spans_are_the_patterns(text):
    assert [f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in pii.selected(text, None)[0]] == base(text)


def test_known_data():
    text = "mail bob.t@mail8.example.com, ip 42.144.35.254, card 4111 1111 1111 1111, call +1 (988) 555-2485; 300.1.1.1 and 4111111111111112"
    found, _ = pii.selected(text, None)
    assert [text[s.start:s.end] for s in found] == ["bob.t@mail8.example.com", "42.144.35.254", "4111 1111 1111 1111", "+1 (988) 555-2485"]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.digest(docs).collect():
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in pii.KINDS]
        assert set(want) <= set(r.spans.split(",")) | {""}
        if not re.search(r"[0-9@]|\(at\)|\[at\]", texts[r.doc_id]):
            assert r.spans == ""


def model():
    """Trees from texts of the kinds of personal data."""
    rng = np.random.default_rng(0)
    xs, ys = [], []
    for i in range(400):
        d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
        card = next(c for c in iter(lambda: "4" + d(15), "") if luhn(c))
        text = f"word call +1 ({d(3)}) 555-{d(4)} then 10.{d(2)}.7.{d(2)} or a{d(2)}@mail.example.org pay {card} v{d(1)}.{d(1)} {d(3)}.{d(2)}.{d(3)}.9 {d(16)}"
        x, y = pii.training_rows(text, i)
        xs += x
        ys += y
    return pii.boosted(np.array(xs), np.array(ys, float))


def test_trees_add_looser_forms_and_leave_lookalikes():
    m = model()
    text = "please call (212) 555-0187 today"
    _, chosen = pii.selected(text, m)
    assert [text[s.start:s.end] for s in chosen] == ["(212) 555-0187"]
    assert pii.redacted(text, chosen) == "please call [PHONE] today"
    for clean in ("on 2024-01-31 we met", "version 1.2.3 costs $45.10", "pages 100-200 of 1999", "plain words only"):
        assert pii.selected(clean, m)[1] == []


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(4)
    x = np.concatenate((np.eye(4)[rng.integers(0, 4, 1500)], rng.random((1500, 3))), axis=1)
    y = ((x[:, 4] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    m = pii.boosted(x, y)
    p = m.probability(x)
    assert ((p > 0.5) == (y == 1)).mean() > 0.97
    assert abs(p.mean() - y.mean()) < 0.05


def test_long_runs_take_linear_time():
    import time
    t = time.time()
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "a@" * 150_000, "+" * 300_000, "1 " * 150_000, "(at)" * 60_000, "0:" * 100_000):
        pii.candidates(text)
    assert time.time() - t < 30


def test_given_model_and_redaction(spark):
    out = pii.find_pii(documents(spark), model(), redact=True).collect()
    assert len(out) == len(rows())
    assert all("redacted" in r.asDict() for r in out)
