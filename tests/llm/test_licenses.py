import re

from tidemark.llm import licenses
from tests.llm.cases import SF, documents, rows

LOWER = {i: i + 32 for i in range(65, 91)}
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


def expected(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for label, phrase in PHRASES.items() for n in [len(phrase.split())]
              for i in range(len(words) - n + 1) if words[i:i + n] == phrase.split()]
    return (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({x for _, x in places})))


TEXTS = [
    "Released under the MIT License. The MIT-license, the mit  license!", "cc by cc by CC-BY", "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0", "Licensed under the new Apache License, Version 2.0", "gnu gnu general public license license",
    "mit licenses, smit license, mıt license, apacheélicense", "All rights reserved.", "MIT LİCENSE and worK", "", None,
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation", "mit " * 500 + "license",
]


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_base_against_brute_force(spark):
    got = rows_of(licenses.digest(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")))
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert "cc-by-nc" in got[2].labels and "cc-by-4.0" not in got[2].labels
    assert "apache-2.0" in got[3].labels.split(",") and "apache-2.0" in got[4].labels.split(",")
    assert got[7].labels == "all-rights-reserved" and got[9].labels == ""
    assert {"gpl", "gpl-notice"} <= set(got[11].labels.split(","))


def test_tables_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = rows_of(licenses.digest(docs))
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected(texts[i]) for i, r in got.items())
    want = sorted(expected(r[1]) for r in rows())
    assert sorted((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.digest(documents(spark)).collect()) == want


def test_plan_has_no_python(spark):
    plan = licenses.digest(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
