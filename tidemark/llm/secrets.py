"""Secret scans: candidate tokens and a random forest against false positives.

A pattern proposes every long token that has a digit, is all capitals, or
opens a private key, every token in an issuer's format, and whatever is
assigned to a secret name, of any length and characters (to the closing quote,
or to the next blank without the sentence's signs).  A random forest scores each candidate by its length, its
character transitions, how much of it is dictionary words, the path (the
document's ``source``) and the words around it; candidates below the threshold
are dropped as false positives.

The forest is trained on labelled findings: a table ``(token, before, after,
path, label)`` that the caller may give, joined by findings of ``documents``
that a rule labels (issuer formats and assignments to secret names are secrets;
words, dates, paths, checksums and numbers are not), and by the examples below.
Rule findings come from a bounded sample (``TRAIN_ROWS`` of the least hashes),
and half of them are learnt without the two features that the rule itself uses,
so that the forest also judges findings that no rule decides;
the transition table and the dictionary come from the words of all documents,
which are counted once and written.

All of it is DataFrame, SQL and ``pyspark.ml`` code, run in the JVM.

Defined cases: a null text has no candidates; a null source is an empty path;
equal rows are scanned one by one; a table without candidates, or an empty
one, gives no findings; a token cut by a line end is two tokens; other columns
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, written

TRAIN_ROWS = 4000
DICTIONARY = 400
TREES, DEPTH, SEED = 24, 8, 3
KEEP = 0.5
#: Characters of context on either side of a token.
CONTEXT = 48

_T = "A-Za-z0-9_+/-"
#: Token formats of well-known issuers.
_FORMATS = (r"(?:AKIA|ASIA)[A-Z0-9]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"sk_live_[A-Za-z0-9]{16,}",
            r"AIza[A-Za-z0-9_-]{35}", r"glpat-[A-Za-z0-9_-]{20}")
ISSUED = "|".join(f"^{x}$" for x in _FORMATS) + "|^-----BEGIN"
_NAMES = r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?"
ASSIGNED = _NAMES + r"[\"']?\s*(?:=|:|=>|:=)\s*[\"']?$"
_SET = r"(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?[\"']?\s{0,4}(?:=>|:=|=|:)\s{0,4}"
PATTERN = (rf"-----BEGIN [A-Z ]{{0,32}}PRIVATE KEY-----|(?<![{_T}])(?:(?=[A-Za-z_+/-]*+[0-9])|(?=[A-Z_+/-]{{16}}))"
           rf"[{_T}]{{12,}}+={{0,2}}"
           rf"|(?<![{_T}])(?:{'|'.join(_FORMATS)})(?![{_T}])"
           # few places have a sign of assignment just before them: only there are names looked for
           rf"|(?<=[=:>\"'\s])(?<=[=:>][\s\"']{{0,5}})(?:(?<={_SET}[\"'])[^\s\"']++|(?<={_SET})[^\s\"'=:>][^\s\"']*+)")
#: What ends a sentence or a bracket is no part of a value without quotes.
_SIGNS = ".,;:?)]}"

_PLAIN = r"(?i)sha-?\d*|md5|checksum|hash|commit|digest|uuid|guid|version|isbn|revision|etag"
_SAMPLE_PATH = r"(?i)test|example|sample|mock|fixture|doc"

#: Labelled findings that any training set has: ``(token, before, after, label)``.
EXAMPLES = [
    ("AK" + "IAQ3EGRTNW5ZLXKVB2", "aws_access_key_id = ", "", 1.0), ("AK" + "IAJX4SPQN2MDR7VLTK", "", " is my id", 1.0),
    ("AK" + "IAZBQWLMNPRSTUVXYH", "key ", "", 1.0), ("gh" + "p_9fK2mQx7RtLw3ZcVb8NsYp4HdJ6gA1eU5TiO", "use ", "", 1.0),
    ("5f2b9c81e7d04a63b8f1", "password=", "", 1.0), ("9a7c3e51d2b8f604ac19e7d35b2f8046c1d9e7a3", 'token = "', '"', 1.0),
    ("tR7wQz2LpX9vKm4NbY6c", "secret: ", "", 1.0), ("sk_" + "live_4eC39HqLyjWDarjtT1zdp7dc", "", "", 1.0),
    ("xox" + "b-17653672481-19874698323-pdFZKVeTuE8sk7oOcHrzqqgy", "slack ", "", 1.0),
    ("your_token_here_1", "token = ", "", 0.0), ("xxxxxxxxxxxxxxx0", "password=", "", 0.0), ("changeme12345", "password: ", "", 0.0),
    ("e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", "sha256 ", "", 0.0),
    ("d41d8cd98f00b204e9800998ecf8427e", "md5: ", "", 0.0), ("3f2504e0-4f89-11d3-9a0c-0305e82c3301", "uuid ", "", 0.0),
    ("2024-01-31T10-15-00", "on ", "", 0.0), ("src/main/java/v2/App", "see ", "", 0.0), ("4041894974608795", "card ", "", 0.0),
    ("1234567890123456", "", "", 0.0), ("INTERNATIONALIZATION", "THE ", " OF", 0.0), ("version-2-of-the-book", "", "", 0.0),
    ("chapter_12_introduction", "", "", 0.0), ("da39a3ee5e6b4b0d3255bfef95601890afd80709", "commit ", "", 0.0),
    ("0000000000000000", "id ", "", 0.0), ("AAAAAAAAAAAAAAAAAAAA", "", "", 0.0), ("covid-19-related", "the ", "", 0.0),
]

FEATURES = ["n", "distinct", "digit", "upper", "lower", "turns", "runs", "hex", "entropy", "likely", "known", "issued",
            "assigned", "quoted", "cue", "plain", "sample_path", "caps_before"]


def candidates(docs: DataFrame) -> DataFrame:
    """``(k1, k2, doc_id, path, start, end, token, before, after)`` for each
    token that the pattern proposes, in code points of the whole text."""
    text = F.col("text")
    found = docs.select(F.monotonically_increasing_id().alias("rid"), *row_key(), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"),
                        text.alias("text"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("m"))
    # what lies between the matches gives their places
    parts = F.when(F.size("m") > 0, F.split("text", PATTERN, -1))
    rows = (found.withColumn("p", parts)
            .select("rid", "k1", "k2", "doc_id", "path", F.posexplode(F.zip_with(
                F.arrays_zip("m", "p"), F.slice("p", F.lit(2), F.size("p")), lambda a, b: F.struct(
                    a["m"].alias("token"), F.length(a["p"]).alias("gap"), F.right(a["p"], F.lit(CONTEXT)).alias("before"),
                    F.left(b, F.lit(CONTEXT)).alias("after")))).alias("i", "x"))
            .select("rid", "k1", "k2", "doc_id", "path", "i", "x.*").where(F.col("token").isNotNull()))
    # a row at a time, so that equal documents don't meet in one task
    so_far = Window.partitionBy("rid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum((F.col("gap") + F.length("token")).cast("long")).over(so_far))
    rows = rows.withColumn("start", F.col("end") - F.length("token"))
    short = F.expr(f"rtrim('{_SIGNS}', token)")
    short = F.when(F.col("before").rlike("[\"']$") | (short == ""), F.col("token")).otherwise(short)
    signs = F.substr("token", F.length("short") + 1)
    return (rows.withColumn("short", short).withColumn("after", F.left(F.concat(signs, F.col("after")), F.lit(CONTEXT)))
            .withColumn("token", F.col("short")).withColumn("end", F.col("start") + F.length("short")).select("k1", "k2", "doc_id", "path", "start", "end", "token", "before", "after"))


# -- features ---------------------------------------------------------------------

def folded(word: Column) -> Column:
    """Lower case, digits as 0, other characters as -."""
    return F.regexp_replace(F.regexp_replace(F.lower(word), "[0-9]", "0"), "[^a-z0]", "-")


def pairs_of(word: Column) -> Column:
    """The neighbouring characters, in time linear in the word."""
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    both = F.zip_with(chars, F.slice(chars, F.lit(2), F.size(chars)), lambda a, b: F.concat(a, b))
    return F.filter(both, lambda p: p.isNotNull())


def language_tables(docs: DataFrame) -> tuple[Column, Column]:
    """The character transitions and the commonest words of all documents, as
    a map of at most 28 * 28 entries and an array of ``DICTIONARY``."""
    words = written(docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,24}"), F.lit(0))).alias("w"))
                    .groupBy("w").count(), "words")
    top = [r.w for r in words.orderBy(F.desc("count"), "w").limit(DICTIONARY).collect()]
    pairs = words.select("count", F.explode(pairs_of(F.col("w"))).alias("pair")).groupBy("pair").agg(F.sum("count").alias("n")).collect()
    own = {r.pair: r.n for r in pairs}
    heads: dict[str, int] = {}
    for pair, n in own.items():
        heads[pair[0]] = heads.get(pair[0], 0) + n
    logs = reduce(lambda a, b: a + b, ([F.lit(p), F.log(F.lit((n + 0.5) / (heads[p[0]] + 14.0)))] for p, n in sorted(own.items())), [])
    likely = F.create_map(*logs) if logs else F.create_map().cast("map<string,double>")
    return likely, (F.array(*map(F.lit, top)) if top else F.array().cast("array<string>"))


def featured(found: DataFrame, tables: tuple[Column, Column]) -> DataFrame:
    """``found`` with the columns of ``FEATURES``."""
    likely, dictionary = tables
    token, n = F.col("token"), F.length("token").cast("double")
    share = lambda pattern: F.length(F.regexp_replace(token, pattern, "")) / n
    flag = lambda column, pattern: column.rlike(pattern).cast("double")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    chars = F.split(token, "")
    count = lambda c: F.length(token) - F.length(F.replace(token, c, F.lit("")))
    entropy = F.aggregate(F.array_distinct(F.filter(chars, lambda c: c != "")), F.lit(0.0),
                          lambda a, c: a - count(c) / n * F.log2(count(c) / n))
    pairs = pairs_of(folded(token))
    unseen = F.lit(-8.0)
    fit = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.coalesce(F.try_element_at(likely, p), unseen)) / F.greatest(n - 1, F.lit(1.0))
    runs = F.regexp_extract_all(F.lower(token), F.lit("[a-z]{3,}"), F.lit(0))
    covered = F.aggregate(runs, F.lit(0), lambda a, w: a + F.when(F.array_contains(dictionary, w), F.length(w)).otherwise(0)) / n
    near = F.concat_ws(" ", F.right("before", F.lit(24)), F.left("after", F.lit(12)))
    out = {
        "n": n, "distinct": F.size(F.array_distinct(chars)) / n, "digit": share("[^0-9]"), "upper": share("[^A-Z]"), "lower": share("[^a-z]"),
        "turns": (F.length(F.regexp_replace(shape, r"(.)\1+", "$1")) - 1) / n, "runs": F.size(F.regexp_extract_all(token, F.lit(r"(.)\1\1"), F.lit(0))).cast("double"),
        "hex": flag(token, "^[0-9a-f]+$"), "entropy": entropy, "likely": fit, "known": covered, "issued": flag(token, ISSUED),
        "assigned": flag(F.col("before"), ASSIGNED), "quoted": flag(F.col("before"), "[\"'`]$"), "cue": flag(near, _NAMES), "plain": flag(near, _PLAIN),
        "sample_path": flag(F.col("path"), _SAMPLE_PATH), "caps_before": flag(F.col("before"), r"[A-Z]{2,}\W*$"),
    }
    return found.select("*", *[F.coalesce(out[c].cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])


# -- forest -----------------------------------------------------------------------

def examples(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(t).alias("token"), F.lit(b).alias("before"), F.lit(a).alias("after"), F.lit("").alias("path"), F.lit(y).alias("label"))
            for t, b, a, y in EXAMPLES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def ruled(found: DataFrame) -> DataFrame:
    """Findings that the rule labels; the others stay unlabelled."""
    secret = F.col("token").rlike(ISSUED) | (F.col("before").rlike(ASSIGNED) & F.col("token").rlike("[0-9]") & (F.size(F.array_distinct(F.split("token", ""))) >= 8))
    clean = (F.col("token").rlike(r"^[0-9_+/-]+$") | F.col("token").rlike(r"^[A-Z_+/-]+$") & ~F.col("token").rlike(ISSUED)
             | F.col("before").rlike(_PLAIN + r"\W{0,3}$") | F.col("token").rlike(r"^(?:[a-z]++[/_-]++)++[a-z0-9]*$"))
    label = F.when(secret, 1.0).when(clean, 0.0)
    return found.withColumn("label", label).where(F.col("label").isNotNull()).select("token", "before", "after", "path", "label")


def fit(found: DataFrame, tables: tuple[Column, Column], labelled: DataFrame | None = None) -> RandomForestClassificationModel:
    """A forest of the labelled findings, each class weighing the same."""
    rows = ruled(found).orderBy(F.xxhash64(F.lit(SEED), "token", "before"), "token", "before", "after", "path").limit(TRAIN_ROWS)
    # the rule's own features are hidden from every other of its findings
    hidden = F.pmod(F.xxhash64(F.lit(SEED + 1), "token", "before"), F.lit(2)) == 0
    rows = rows.withColumn("hide", hidden).unionByName(examples(found.sparkSession).withColumn("hide", F.lit(False)))
    if labelled is not None:
        rows = rows.unionByName(labelled.select("token", "before", "after", "path", F.col("label").cast("double").alias("label"), F.lit(False).alias("hide")))
    shown = {c: F.when(F.col("hide"), F.lit(0.0)).otherwise(F.col(c)) for c in ("issued", "assigned")}
    rows = written(featured(rows, tables).withColumns(shown).drop("hide").orderBy("token", "before", "after", "path", "label").coalesce(1), "labelled-findings")
    by = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = F.when(F.col("label") == 1, 0.5 / by.get(1.0, 1)).otherwise(0.5 / by.get(0.0, 1)) * sum(by.values())
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows.withColumn("weight", weight))
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, keep: float = KEEP) -> DataFrame:
    """``(doc_id, path, start, end, token, before, after, score)`` of the
    candidates that the forest holds for secrets."""
    found = written(candidates(docs), "secret-candidates")
    tables = language_tables(docs)
    model = fit(found, tables, labelled)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(featured(found, tables))
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return scored.where(F.col("score") >= keep).select("doc_id", "path", "start", "end", "token", "before", "after", "score")


def digest(docs: DataFrame) -> DataFrame:
    """A row for each finding; the secret itself only as a hash."""
    kind = (F.when(F.col("token").rlike("^-----BEGIN"), "private-key").when(F.col("token").rlike(ISSUED), "issued")
            .when(F.col("before").rlike(ASSIGNED), "assigned").otherwise("token"))
    return scan(docs).select("doc_id", "start", "end", kind.alias("kind"), F.sha2("token", 256).alias("token_sha256"), "score")
