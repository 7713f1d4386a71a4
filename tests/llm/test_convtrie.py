"""The conversation trie against a walk over all prefixes, and its SQL."""

import random
from hashlib import sha256
from zlib import crc32

import duckdb
import pytest

from tests.llm.cases import SF, sentence
from tidemark.llm import convtrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    md5 = __import__("hashlib").md5
    own = {c: [(r, t) for *_, r, t in sorted(ts, key=lambda x: (*x[:2], md5(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()))] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = (own.get(base, [])[:h] + ts[h:]) if rebuild else ts
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        d = len(path)
        under = [(p, m) for p, m in nodes.items() if p[:d] == path]
        words = lambda p: len(p[-1][1].encode().split()) if p else 0
        ends = sorted(c for c in members if len(built[c]) == d)
        out.append((min(members), d, min(nodes[path[:-1]]) if d else None, len(members), sum(len(p) == d + 1 for p, _ in under),
                    sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in nodes) for p, _ in under),
                    sum((len(m) - 1) * words(p) for p, m in under), sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trees(seed, n=60):
    """Conversations that share beginnings of all lengths."""
    rng = random.Random(seed)
    known, rows = [[]], []
    for k in range(n):
        base = rng.choice(known)
        talk = base[:rng.randint(0, len(base))] + [(rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "b c", sentence(rng, rng.randint(1, 9))])) for _ in range(rng.choice([0, 0, 1, 2, 5, 9]))]
        known.append(talk)
        c = rng.choice([k, k * 20, k + 5000, -k, 7 * k])
        rows += [(c, t if rng.random() < .9 else None, r, x) for t, (r, x) in enumerate(talk)]
    rng.shuffle(rows)
    return rows


ODD = [(None, 0, "user", "nobody's"), (1, None, None, None), (1, None, None, None), (1, 3, "user", ""), (2, 5, "user", "x"), (2, 5, "user", "x"), (2, 5, "a", "y z"),
       (20, 0, "u", "long " * 50_000), (21, 0, "u", "long " * 50_000), (40, -9, "u", "one"), (41, 1 << 40, "u", "one"), (-3, 1, "u", "ü\x0b  é"), (-20, 1, "u", "ü")]


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_rebuilt_tries(spark, seed):
    rows = trees(seed)
    assert got(convtrie.digest(frame(spark, rows))) == by_hand(rows)


def test_odd_conversations(spark):
    docs = frame(spark, ODD)
    assert got(convtrie.digest(docs)) == by_hand(ODD)
    from pyspark.sql import functions as F
    extra = docs.withColumns({c: F.lit(1) for c in ("pos", "h", "words", "k", "depth", "size", "top", "items", "q1")})
    assert got(convtrie.digest(extra)) == by_hand(ODD)
    assert convtrie.digest(docs.limit(0)).collect() == []
    assert convtrie.digest(frame(spark, [(None, 1, "u", "x")])).collect() == []


@pytest.mark.parametrize("block", [1, 2, 5, 50])
def test_any_block_gives_the_same_trie(spark, block):
    rows = trees(7, 40) + [(900, t, "u", str(t // 2)) for t in range(300)] + [(901, t, "u", str(t // 2)) for t in range(310)]
    assert got(convtrie.prefix_trie(frame(spark, rows), block)) == by_hand(rows, rebuild=False)


def test_conversations_without_turns_and_their_root(spark):
    # h takes all own turns away and nothing takes their place
    rows = [(c, 0, "u", "x") for c in range(101, 160) if crc32(str(c).encode()) % 4 and c % 20]
    assert got(convtrie.digest(frame(spark, rows))) == by_hand(rows)
    assert len(by_hand(rows)) == 1


def test_many_ends_at_one_node(spark, monkeypatch):
    rows = [(c, 0, "u", "same") for c in range(-300, 12_000, 3)]
    assert got(convtrie.prefix_trie(frame(spark, rows))) == by_hand(rows, rebuild=False)


def test_texts_of_nodes(spark):
    rows = trees(3, 30)
    docs = frame(spark, rows)
    nodes = convtrie.prefix_trie(docs)
    found = convtrie.with_texts(nodes, docs).collect()
    assert len(found) == nodes.count() and all((r.text is None) == (r.depth == 0) for r in found)


def test_sql_on_odd_conversations(spark):
    import pandas as pd
    rows = trees(11) + ODD
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    con.execute("CREATE VIEW conversations AS SELECT * FROM given")
    res = con.execute(convtrie.ORACLE)
    assert [d[0] for d in res.description] == COLUMNS
    assert sorted(map(tuple, res.fetchall()), key=repr) == by_hand(rows)


def test_block_digests_group_first(spark):
    """A conversation that leaves the others early is taken apart in its first block only."""
    rows = [(c, t, "u", f"{c} {t}") for c in range(50) for t in range(40)]
    turns = convtrie.hashed_turns(frame(spark, rows))
    per = convtrie.blocks(turns)
    assert per.count() == 50 * 40 // convtrie.BLOCK
    assert per.groupBy("k", "p1", "p2").agg({"e1": "count"}).where("k > 0 and `count(e1)` > 1").count() == 0
    assert got(convtrie.prefix_trie(spark.createDataFrame([(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()], SCHEMA)))
