"""Documents with the odd cases that every operator must handle."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHING = ["k1", "k2", "row", "size", "start", "fp", "h", "kept", "hits", "key", "ord", "n", "s", "bucket", "score", "root", "words"]


def sentence(rng, n):
    syllables = ["the", "er", "an", "ing", "on", "re", "nd", "st", "ou", "tion", "wh", "ble"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def rows():
    rng = random.Random(3)
    passage = sentence(rng, 60)
    shared = "A line that many documents share"
    out = []
    for i in range(30):
        text = sentence(rng, 40) + "\n" + (shared if i % 2 else "own line " + str(i)) + "\n" + sentence(rng, 30)
        if i % 7 == 0:
            text += " " + passage
        out.append((i, text, ["en", "de", None][i % 3], ["b", "a", None, "c"][i % 4], len(text)))
    near = out[3][1].split(" ")
    near[20] = "changed"
    out += [
        (100, None, "en", "a", None), (101, "", "en", None, 0), (102, " \t\n ", "de", "a", 4), (103, "12 34 !!", None, "b", 8),
        (None, sentence(rng, 30), "en", "a", 10), (None, None, None, None, None), (104, "x", "en", "a", 1),
        out[3][:1] + out[3][1:], out[3], (105, out[3][1], "en", "a", 5), (106, " ".join(near), "en", "a", 5),
        (107, sentence(rng, 30_000), "en", "a", 9), (108, "a" * 200_000, "en", "b", 9), (109, "Ärger Über ÉTÉ 日本語   KK İ " + passage, "de", "a", 9),
        (110, (shared + "\n") * 50, "en", "a", 9), (111, "1" * 100_000 + "." * 50_000 + "@" * 1000, "en", "b", 9),
    ]
    return out


def documents(spark):
    return spark.createDataFrame(rows(), COLUMNS)


def clashing(docs):
    """Extra columns with the operators' own names, a map and a struct too."""
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(i))
    return docs.withColumn("value", F.struct(F.lit(1).alias("text"), F.lit("x").alias("doc_id"))).withColumn("at", F.create_map(F.lit("a"), F.lit(2)))


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def queries():
    from tidemark.llm import queries as q
    return q.QUERIES
