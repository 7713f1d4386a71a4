"""Prefix trie of conversations by block digests.

A node of depth ``d`` stands for a sequence of ``d`` turns that some
conversation starts with; the root has no turns.  Its members are the
conversations that start with it, its name is the least of them.

Method, fixed-length blocks: a conversation's turns are digested in blocks of
``block`` turns, and conversations are grouped by successive block digests (a
digest covers all turns up to the block's end).  Where all conversations that
reach a block boundary share the next block, its inner turns are a chain with
the same members: one row stands for them until the end.  Only blocks in which
siblings diverge are taken apart, and grouped turn by turn.

Sums over subtrees need no walk along the trie.  The nodes a conversation names
are the lower end of its path, from depth ``top`` on.  So a subtree is the
members' ends: each member adds what it has from its own ``top`` on, and the
node that the sum is for has all of its member's own path.  All figures of a
node are then sums over its members.

A conversation's turns are numbered in spans of ``SPAN`` turn numbers, and then
handled a block at a time; texts are hashed (MD5 with the role) before the first
shuffle and travel no further.  The ids of the conversations that end at a node
are joined to texts of ``IDS`` id numbers, which one task hashes in a stream, as
SHA-256 has to; it holds one batch of such texts.

Defined cases: rows without a ``conv_id`` belong to no conversation; a null turn
number comes first; turns of the same number are ordered by the MD5 of role and
text; a null role or text is empty; equal rows are turns of their own; an empty
table has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WHITESPACE, written

#: Turns of a block, turn numbers of a span, id numbers of a text of ids.
BLOCK, SPAN, IDS = 4, 64, 4096
WORD = "[^" + "".join(f"\\x{ord(c):02X}" for c in WHITESPACE) + "]+"
#: The contract's rebuilding: neighbours share the first turns of every twentieth conversation.
FAMILY, MOST_SHARED = 20, 3

_NODE = ["depth", "q1", "q2"]


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, h, words)``: turns numbered from 1, ``h`` the MD5 of
    role and text, ``words`` the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.expr(f"cast(floor(turn / {SPAN}) as long)"), F.lit(-(1 << 62))).alias("span"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("h"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    at = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "h")
    rows = rows.withColumn("rank", F.row_number().over(at))
    spans = rows.groupBy("conv_id", "span").agg(F.max("rank").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return rows.join(spans, ["conv_id", "span"]).select("conv_id", (F.col("rank") + F.col("before")).cast("long").alias("pos"), "h", "words")


def shared_turns(conv_id: str) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, pos, h, words)`` of the rebuilt conversations and the
    ``(conv_id)`` of all, also those that are left without turns."""
    lengths = written(turns.groupBy("conv_id").agg(F.max("pos").alias("size")), "lengths")
    convs = lengths.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), shared_turns("conv_id").alias("take"))
    firsts = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= MOST_SHARED)).withColumnRenamed("conv_id", "base")
    heads = convs.join(firsts, "base").where("pos <= take").select("conv_id", "pos", "h", "words")
    had = lengths.select(F.col("conv_id").alias("base"), "size")
    moved = convs.join(had, "base", "left").select("conv_id", "take", F.least("take", F.coalesce("size", F.lit(0))).alias("got"))
    own = (turns.join(moved, "conv_id").where("pos > take")
           .select("conv_id", (F.col("pos") - F.col("take") + F.col("got")).cast("long").alias("pos"), "h", "words"))
    return heads.unionByName(own), convs.select("conv_id")


def blocks(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, k, start, n, p1, p2, e1, e2, items, size, total)``: block
    ``k`` has ``n`` turns after the first ``start``; ``p`` and ``e`` are the
    digests of all turns before it and up to its end; ``items`` has for each
    turn its ``depth``, digests ``q``, those of its parent ``u``, and the words
    ``before`` it; ``size`` and ``total`` are the conversation's turns and words."""
    lanes = [F.xxhash64(F.lit(i), F.col("pos"), F.col("h")).alias(f"t{i}") for i in (1, 2)]
    per = (turns.select("conv_id", "pos", "words", F.expr(f"(pos - 1) div {int(block)}").alias("k"), *lanes)
           .groupBy("conv_id", "k").agg(F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "words"))).alias("own"),
                                        F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"), F.sum("words").alias("w"), F.count("*").alias("n")))
    conv = Window.partitionBy("conv_id")
    upto = conv.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    rows = per.select(
        "conv_id", "k", (F.col("k") * int(block)).alias("start"), "n", "own", "x1", "x2",
        *[F.coalesce(F.bit_xor(f"x{i}").over(upto), zero).alias(f"p{i}") for i in (1, 2)],
        F.coalesce(F.sum("w").over(upto), zero).alias("before"),
        F.sum("n").over(conv).alias("size"), F.sum("w").over(conv).alias("total"))
    first = F.struct(zero.alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), zero.alias("u1"), zero.alias("u2"),
                     zero.alias("before"), F.col("before").alias("after"))

    def step(done, turn):
        last = F.element_at(done, -1)
        return F.concat(done, F.array(F.struct(
            turn["pos"].alias("depth"), last["q1"].bitwiseXOR(turn["t1"]).alias("q1"), last["q2"].bitwiseXOR(turn["t2"]).alias("q2"),
            last["q1"].alias("u1"), last["q2"].alias("u2"), last["after"].alias("before"), (last["after"] + turn["words"]).alias("after"))))

    items = F.slice(F.aggregate("own", F.array(first), step), F.lit(2), F.size("own"))
    return rows.select("conv_id", "k", "start", "n", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("e1"),
                       F.col("p2").bitwiseXOR(F.col("x2")).alias("e2"), items.alias("items"), "size", "total")


def ends_of(convs: DataFrame) -> DataFrame:
    """``(depth, q1, q2, ends_sha256)`` of the nodes where conversations end."""
    texts = (convs.groupBy(F.col("size").alias("depth"), "q1", "q2", F.expr(f"conv_id div {IDS}").alias("part"))
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
             .repartition(*_NODE).sortWithinPartitions(*_NODE, "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, sha256()

        def row(done):
            return pa.RecordBatch.from_pylist([dict(zip((*_NODE, "ends_sha256"), (*x, s), strict=True)) for x, s in done], schema)

        for batch in batches:
            done, cols = [], [batch.column(i).to_pylist() for i in range(5)]
            for *at, _, ids in zip(*cols, strict=True):
                if at != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = at, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield row(done)
        if node is not None:
            yield row([(node, state.hexdigest())])

    schema = pa.schema([(c, pa.int64()) for c in _NODE] + [("ends_sha256", pa.string())])
    return texts.select(*_NODE, "part", "ids").mapInArrow(run, "depth long, q1 long, q2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of conversations ``convs`` with hashed ``turns``: ``(conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``."""
    rows = written(blocks(turns, block), "blocks")
    start = ["k", "p1", "p2"]
    # Block digests: where do conversations that reach a boundary go on differently?
    ways = rows.groupBy(*start, "e1", "e2", "n").agg(F.lit(1).alias("one"))
    split = written(ways.groupBy(*start).agg(F.sum("one").alias("ways")).where("ways > 1").select(*start), "diverging")
    # all conversations start at the root: its blocks are taken apart unasked
    apart = rows.where("k = 0").unionByName(rows.where("k > 0").join(split, start, "left_semi"))
    whole = rows.where("k > 0").join(split, start, "left_anti")
    apart = apart.select("conv_id", "size", "total", F.inline("items"))
    whole = whole.select("conv_id", "size", "total", "n", F.col("items")[0].alias("first"), "items",
                         (F.col("start") + F.col("n")).alias("depth"), F.col("e1").alias("q1"), F.col("e2").alias("q2"))

    # The nodes that each conversation names: from which depth, and is its end a leaf?
    tops = apart.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.max("size").alias("longest"), F.min("before").alias("before"))
    chains = whole.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.max("size").alias("longest"),
                                       F.min("first.before").alias("before"), F.min("first.depth").alias("from"))
    named = tops.withColumn("from", F.col("depth")).unionByName(chains.select(*tops.columns, "from"))
    named = named.groupBy("conv_id").agg(F.min("from").alias("top"), F.min_by("before", "from").alias("mark"),
                                         F.max((F.col("depth") == F.col("longest")).cast("long")).alias("leaf"))
    last = rows.where(F.col("start") + F.col("n") == F.col("size")).select("conv_id", "size", "total", F.col("e1").alias("q1"), F.col("e2").alias("q2"))
    zero = F.lit(0).cast("long")
    # shared: words of the path above the nodes that a conversation names
    facts = written(convs.join(last, "conv_id", "left").join(named, "conv_id", "left").select(
        "conv_id", "top", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("mark", "total", zero).alias("shared"),
        *[F.coalesce(c, zero).alias(c) for c in ("size", "q1", "q2")]), "conversations")
    more = facts.select("conv_id", "top", "leaf", "shared")

    def figures(members: DataFrame, *keys: str) -> DataFrame:
        """Sums over members; those of all but the one that names the node."""
        child = F.coalesce((F.col("top") == F.col("depth") + 1).cast("long"), zero)
        name = F.min_by(F.struct("shared", child.alias("child"), "size", "top"), "conv_id")
        return (members.groupBy(*keys).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("leaf").alias("leaves"),
            F.sum("shared").alias("shared"), F.sum(child).alias("children"), name.alias("name"), *kept(members, keys))
            .withColumn("shared", F.col("shared") - F.col("name.shared"))
            .withColumn("n_children", F.col("children") - F.col("name.child") + (F.col("name.size") > F.col("depth")).cast("long"))
            .withColumn("top", F.col("name.top")).drop("children", "name"))

    def kept(members: DataFrame, keys: tuple[str, ...]) -> list[Column]:
        return [F.first(c).alias(c) for c in ("u1", "u2", "before", "items") if c in members.columns and c not in keys]

    def saved() -> Column:
        return F.col("shared") - (F.col("n_convs") - 1) * F.col("before")

    out = ["conv_id", *_NODE, "u1", "u2", "top", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    single = (figures(apart.drop("total", "after").join(more, "conv_id"), *_NODE)
              .withColumn("n_leaves", F.col("leaves")).withColumn("saved_tokens", saved()).select(*out))
    inner = figures(whole.drop("total", "n", "first").join(more, "conv_id"), *_NODE).withColumnRenamed("depth", "until")
    inner = inner.drop("q1", "q2").select("*", F.inline("items").alias(*[f"i_{c}" for c in ("depth", "q1", "q2", "u1", "u2", "before", "after")]))
    inner = inner.select(
        "conv_id", *[F.col(f"i_{c}").alias(c) for c in (*_NODE, "u1", "u2", "before")], "top", "n_convs",
        F.when(F.col("i_depth") < F.col("until"), F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), "shared").withColumn("saved_tokens", saved()).select(*out)
    root = (figures(facts.select("conv_id", "top", "leaf", "shared", "size", zero.alias("depth"), zero.alias("u1"), zero.alias("u2"), zero.alias("before")), "depth")
            .withColumn("n_leaves", F.greatest("leaves", F.lit(1).cast("long"))).withColumn("saved_tokens", saved())
            .withColumns({"q1": zero, "q2": zero}).select(*out))
    nodes = written(root.unionByName(single).unionByName(inner), "nodes")

    # A node's parent has the same name unless it is the first that its conversation names.
    first_named = nodes.where("depth > 0 and depth = top").select(*_NODE, (F.col("depth") - 1).alias("up"), "u1", "u2")
    above = nodes.select(F.col("depth").alias("up"), F.col("q1").alias("u1"), F.col("q2").alias("u2"), F.col("conv_id").alias("parent"))
    parents = first_named.join(above, ["up", "u1", "u2"]).select(*_NODE, "parent")
    none = F.lit(sha256(b"").hexdigest())
    return (nodes.join(parents, _NODE, "left").join(ends_of(facts), _NODE, "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of conversations as they are (``conv_id, turn, role, text``)."""
    turns = written(hashed_turns(conversations), "turns")
    return trie(turns, turns.select("conv_id").distinct(), block)


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of ``prefix_trie`` with ``role`` and ``text`` of their last turn."""
    at = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.unhex(F.md5(F.concat(
        F.length("role").cast("string"), F.lit(":"), "role", "text"))))
    said = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
            .withColumn("depth", F.row_number().over(at).cast("long")).drop("turn"))
    return nodes.join(said, ["conv_id", "depth"], "left")


def digest(conversations: DataFrame) -> DataFrame:
    """The fixed columns of ``op12_prefix_trie``: the trie of the rebuilt conversations."""
    return trie(*rebuilt(written(hashed_turns(conversations), "turns")))


ORACLE = """
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 20 AS b, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(c::VARCHAR, ''), lambda z: [ascii(z)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda s, z: xor(xor(s, z) >> 1, (xor(s, z) & 1) * 3988292384)), 4294967295) % 4 AS h
  FROM (SELECT c, count(*) AS n FROM own GROUP BY c)),
moved AS (SELECT v.c, v.b, v.h, least(v.h, coalesce(f.n, 0)) AS got FROM convs v LEFT JOIN convs f ON f.c = v.b),
said AS (
  SELECT m.c, o.pos, o.r, o.x FROM moved m JOIN own o ON o.c = m.b AND o.pos <= m.h
  UNION ALL SELECT m.c, o.pos - m.h + m.got, o.r, o.x FROM moved m JOIN own o ON o.c = m.c AND o.pos > m.h),
path AS (
  SELECT c, 0 AS d, '' AS p, NULL AS up, 0 AS w FROM convs
  UNION ALL SELECT c, pos, p, substr(p, 1, length(p) - length(s)), w FROM (
    SELECT c, pos, s, w, string_agg(s, '') OVER (PARTITION BY c ORDER BY pos) AS p FROM (
      SELECT c, pos, length(r) || ':' || r || length(x) || ':' || x AS s, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS w FROM said))),
ends AS (SELECT d, p, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e FROM (SELECT c, max(d) AS d, arg_max(p, d) AS p FROM path GROUP BY c) GROUP BY d, p),
nodes AS (SELECT d, p, min(up) AS up, min(w) AS w, min(c) AS c, count(*) AS n FROM path GROUP BY d, p),
kids AS (SELECT d - 1 AS d, up AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY d, up),
sums AS (
  SELECT a.d, a.p, sum((x.n - 1) * x.w) AS saved, count(*) FILTER (WHERE x.k IS NULL) AS leaves
  FROM (SELECT nodes.*, kids.k FROM nodes LEFT JOIN kids USING (d, p)) x JOIN path a ON a.c = x.c AND a.d <= x.d GROUP BY a.d, a.p)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, u.c AS parent_conv_id, n.n AS n_convs, coalesce(k.k, 0) AS n_children, s.leaves AS n_leaves,
  s.saved::BIGINT AS saved_tokens, coalesce(e.e, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s USING (d, p) LEFT JOIN kids k USING (d, p) LEFT JOIN ends e USING (d, p)
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.up
"""
