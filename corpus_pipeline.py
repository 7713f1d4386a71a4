"""A training corpus from ``documents``: the operators of ``tidemark.llm`` in a row.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns the next documents, which ``run`` writes as Parquet and
reads again.  All stages but the last return the columns they were given, with
``text`` (and ``n_chars``, where it exists) as the stage left it.

Defined cases are those of the operators; a document whose lines all go stays
with an empty text, and of several such documents the near-duplicate stage
keeps one.  An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, lines, mixing, simhash
from tidemark.llm.common import unpacked, written
from tidemark.session import scratch_scope
from tidemark.sources import fs
from tidemark.sources.tables import load


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with some confidence: at
    least that of the labelled pieces which the network was not trained on."""
    net = language.fit(docs)
    kept = language.identified(docs, net).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= (net.floor if net else 0.0)))
    return unpacked(kept, docs.columns)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    out = unpacked(lines.dedup_lines(docs), docs.columns, text="kept")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each SimHash group."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of each document."""
    return mixing.digest(docs)


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", without_shared_lines),
    ("simhash_near_dedup", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed_sources),
]

#: The recurrent network, fingerprints and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  What a stage writes on the way goes when
    its result is written, and its input when the next result is."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch_scope(spark) as scope:
            docs = written(stage(spark, docs, sf_dir), name)
            kept = scope.keep_last()
        if before is not None:
            fs.remove(spark, before)
        before = kept
    return docs
