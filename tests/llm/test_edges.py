"""Every operator and stage on nulls, empty and very long texts, repeated rows,
empty tables and extra columns of clashing names."""

import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, language, licenses, lines, mixing, pii, secrets, simhash, substrings
from tests.llm.cases import clashing, collected, documents, empty, rows

DIGESTS = {
    "mixing": mixing.digest, "lines": lines.digest, "pii": pii.digest, "language": language.digest, "simhash": simhash.digest,
    "substrings": substrings.digest, "licenses": licenses.digest,
}


@pytest.fixture(scope="module")
def benchmark(spark):
    text = rows()[0][1]
    return spark.createDataFrame([(1, " ".join(text.split()[-60:])), (2, None), (3, ""), (4, "short"), (None, "no id but a text of its own here")],
                                 "item_id long, text string")


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_a_row_for_each_document_whatever_its_columns(spark, name):
    docs = documents(spark)
    plain = collected(DIGESTS[name](docs))
    assert len(plain) == len(rows())
    assert collected(DIGESTS[name](clashing(docs))) == plain


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_empty_table(spark, name):
    assert DIGESTS[name](empty(spark)).collect() == []


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_only_null_texts(spark, name):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, None, None, None, None), (None, None, None, None, None)],
                                 documents(spark).schema)
    assert DIGESTS[name](docs).count() == 3


def test_findings_of_null_texts_alone(spark, benchmark):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, None, None, None, None)], documents(spark).schema)
    assert secrets.digest(docs).collect() == [] and decontaminate.digest(docs, benchmark).collect() == []
    assert decontaminate.clean(docs, benchmark).count() == 2


def test_findings_of_odd_tables(spark, benchmark):
    docs = documents(spark)
    assert collected(secrets.digest(docs)) == collected(secrets.digest(clashing(docs)))
    assert secrets.digest(empty(spark)).collect() == []
    found = collected(decontaminate.digest(docs, benchmark))
    assert found and collected(decontaminate.digest(clashing(docs), benchmark)) == found
    assert decontaminate.digest(empty(spark), benchmark).collect() == []
    assert decontaminate.digest(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(rows())


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_tables(spark, tmp_path, benchmark, k):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, stage = corpus_pipeline.STAGES[k]
    docs = documents(spark)
    out = stage(spark, docs, str(tmp_path))
    more = stage(spark, clashing(docs), str(tmp_path))
    none = stage(spark, empty(spark), str(tmp_path))
    assert none.count() == 0
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns and none.columns == docs.columns
        assert more.columns == clashing(docs).columns
        assert collected(more.select(*docs.columns)) == collected(out)
    else:
        assert collected(more) == collected(out)
