import numpy as np
import zlib

from tidemark.llm import language
from tests.llm.cases import documents

SF = "/root/testdata/sf0.01"


def test_gradient_is_that_of_the_loss():
    net = language.Network.fresh(["a", "b", "c"], hidden=4, seed=1, kind=np.float64)
    rng = np.random.default_rng(2)
    x, y, w = rng.integers(0, 256, (5, 7)).astype(np.uint8), rng.integers(0, 3, 5), rng.random((5, 7))
    _, grads = net.gradient(x, y, w)
    for part, grad in zip(net.parts(), grads, strict=True):
        flat = part.reshape(-1)
        for i in rng.choice(len(flat), min(20, len(flat)), replace=False):
            was = flat[i]
            flat[i] = was + 1e-5
            up, _ = net.gradient(x, y, w)
            flat[i] = was - 1e-5
            down, _ = net.gradient(x, y, w)
            flat[i] = was
            assert abs((up - down) / 2e-5 - grad.reshape(-1)[i]) < 1e-6


def test_fast_states_equal_the_recorded_ones():
    net = language.Network.fresh(["a", "b"], hidden=6, seed=3)
    x = np.random.default_rng(1).integers(0, 256, (20, 9))
    for back in (False, True):
        want = net.ahead.forward(x[::-1] if back else x)[0]
        want = want[::-1] if back else want
        for t, h in net.ahead.states(x, back):
            assert np.allclose(h.T, want[t], atol=1e-5)


def test_bytes_are_folded():
    fold = lambda s: language.classes(np.frombuffer(s.encode(), np.uint8)).tolist()
    assert fold("ÉTÉ Über 7!") == fold("été über 9?")
    assert fold("ab") != fold("ba")


def small_net():
    rng = np.random.default_rng(0)
    words = {"aa": ["sol", "luna", "mar"], "bb": ["werk", "kraft", "zug"]}
    return language.trained([(" ".join(rng.choice(words[k], 14)).encode(), k) for k in words for _ in range(80)], steps=80)


def test_every_position_gets_a_label():
    net = small_net()
    a, b = b"sol luna mar " * 40, b"werk kraft zug " * 40
    spans = language.language_spans(net, a + b)
    assert spans[0][0] == 0 and spans[-1][1] == len(a + b)
    assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    labels = [name for x, y, name in spans for _ in range(y - x)]
    assert labels[:len(a)].count("aa") > 0.9 * len(a) and labels[len(a):].count("bb") > 0.9 * len(b)


def test_pooling_reads_whole_texts():
    net = small_net()
    short, long = b"sol luna mar ", b"werk kraft zug "
    p = language.probabilities(net, [short * 40, short * 40 + long * 4000, b"", long * 30_000])
    assert p[0].argmax() == 0 and p[1].argmax() == 1 and p[3].argmax() == 1
    alone = language.probabilities(net, [short * 40])
    assert np.allclose(alone[0], p[0], atol=1e-6)


def test_held_out_accuracy_and_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    out = language.digest(docs).collect()
    assert len(out) == len(lang)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    assert np.mean([lang[r.doc_id][0] == r.lang_pred for r in held]) >= 0.97


def test_und_and_labels_that_may_not_be_used(spark):
    docs = documents(spark)
    got = {r.doc_id: r for r in language.digest(docs).collect()}
    for doc in (100, 101, 102, 103):
        assert (got[doc].lang_pred, got[doc].score) == ("und", 0.0)
    assert {r.lang_pred for r in got.values()} <= {"en", "de", "und"}
    # held-out labels and sources have no influence
    from pyspark.sql import functions as F
    other = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("zz"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in language.digest(other).collect()} == {k: (r.lang_pred, r.score) for k, r in got.items()}


def test_without_labels_all_are_unknown(spark):
    docs = documents(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.digest(docs).collect()} == {"und"}


def test_pooled_probabilities_by_a_plain_loop():
    """A document's score from the labels of its bytes, one byte after another."""
    net = small_net()
    for text in (b"sol luna mar", b"werk kraft zug 12 " * 30, "Ärger sol Über".encode(), b"x" * 500):
        total, n = np.zeros(len(net.languages)), 0
        for a in range(0, len(text), language.SEGMENT):
            piece = text[a:a + language.SEGMENT]
            x, _, _ = language.segments([piece])
            labels = net.label(x).reshape(-1, len(net.languages))
            for i, byte in enumerate(piece):
                if byte >= 128 or chr(byte).isalpha():
                    total, n = total + labels[i], n + 1
        assert np.allclose(language.probabilities(net, [text])[0], total / n, atol=1e-5)


def test_the_floor_comes_from_pieces_kept_out_of_training(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, real = [], language.trained
    monkeypatch.setattr(language, "trained", lambda rows, *a: seen.append({p for p, _ in rows}) or real(rows, *a))
    asked, scores = [], language.probabilities
    monkeypatch.setattr(language, "probabilities", lambda net, texts: asked.append(set(texts)) or scores(net, texts))
    net = language.fit(docs, most_docs=60)
    assert 0 < net.floor < 1 and asked[0] and len(asked[0] & seen[0]) < len(asked[0]) / 10
    assert net.floor == scores(net, sorted(asked[0])).max(axis=1).min() or abs(net.floor - scores(net, sorted(asked[0])).max(axis=1).min()) < 1e-5
