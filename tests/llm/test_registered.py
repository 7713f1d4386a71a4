"""The registered queries: names, and SQL where SQL can express them."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import queries
from tools.oracle_check import VIEWS, digest

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(queries.ORACLE_SQL[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in res.description], res.fetchall())


def test_pipeline_by_hand(spark):
    """Each stage's decisions, from the operators' rows over the documents it was given."""
    from tidemark.llm import decontaminate, language, mixing, simhash
    from tidemark.llm.common import written
    docs = written(spark.read.parquet(f"{SF}/documents.parquet"), "docs")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, given, SF), name)
        if name == "language_id":
            floor = language.fit(given).floor
            assert 0 < floor < 1
            sure = {r.doc_id for r in language.digest(given).collect() if r.lang_pred != "und" and r.score >= floor}
            assert ids(out) == sure
        elif name == "line_dedup":
            assert ids(out) == ids(given) and out.where("n_chars <> length(text)").count() == 0
        elif name == "simhash_near_dedup":
            assert ids(out) == {r.component_id for r in simhash.digest(given).collect()}
        elif name == "benchmark_decontamination":
            assert ids(out) == ids(given) - {r.doc_id for r in decontaminate.digest(given, items).collect()}
        else:
            assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mixing.digest(given).collect()))
        given = out
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, given.collect()))
