"""Log-line parse rules on edge cases, and the parse/reject split."""

from pyspark.sql import functions as F

from tidemark.operators import parse

# (line, hour, user_id, site_id); None = NULL
EDGE_CASES = [
    ("2020-01-01T10:11:12|~|1.2.3.4|~|/p?uid=u1&sid=s1", "2020-01-01-10", "u1", "s1"),
    ("2020-01-01T10|~|x|~|a=b", "2020-01-01-10", "b", None),
    ("short|~|x|~|a=b&c=d", None, "b", "d"),
    ("", None, None, None),
    (None, None, None, None),
    ("2020-01-01T10:00|~|x|~|/p?uid=&sid=", "2020-01-01-10", "", ""),
    ("2020-01-01T10:00|~|x", "2020-01-01-10", None, None),
    ("2020-01-01T10:00|~|x|~|a|b|c|d|~|tail", "2020-01-01-10", "b", "d"),
    ("TTTT-01-01T10:00|~||~|k=v&q=w&z=1|~|", "-----01-01-10", "v", "w"),
    ("2020-01-01T1é\U0001F600|~|x|~|a=b&c=d", "2020-01-01-1é", "b", "d"),
]


def _lines(spark):
    rows = [(i, c[0]) for i, c in enumerate(EDGE_CASES)]
    return spark.createDataFrame(rows, "id INT, value STRING")


def test_edge_case_fields(spark):
    got = {r["id"]: (r["hour"], r["user_id"], r["site_id"])
           for r in parse.with_log_fields(_lines(spark)).collect()}
    for i, (_, hour, user, site) in enumerate(EDGE_CASES):
        assert got[i] == (hour, user, site), EDGE_CASES[i][0]


def test_parse_and_rejects_partition_the_input(spark):
    lines = _lines(spark)
    ok = parse.parse_log(lines, keep=("id",))
    bad = parse.parse_rejects(lines, keep=("id",))
    ok_ids = {r["id"] for r in ok.collect()}
    bad_ids = {r["id"] for r in bad.collect()}
    expected_ok = {i for i, c in enumerate(EDGE_CASES) if None not in c[1:]}
    assert ok_ids == expected_ok
    assert bad_ids == set(range(len(EDGE_CASES))) - expected_ok
    # the NULL line is a reject, not a failure
    assert 4 in bad_ids


def test_parse_stays_in_codegen(spark, capsys):
    """No Python UDF in the parse plan: it is built-in expressions only."""
    parse.parse_log(_lines(spark)).explain(mode="formatted")
    plan = capsys.readouterr().out
    assert "EvalPython" not in plan


def test_hour_and_day_keys(spark):
    df = spark.createDataFrame([("2024-01-05T07:08:09|~|a|~|x=u&y=s",)], "value STRING")
    r = parse.parse_log(df).withColumn("day", F.substring("hour", 1, 10)).first()
    assert (r["hour"], r["day"]) == ("2024-01-05-07", "2024-01-05")


def _model(line):
    """Plain-Python statement of the parse rules (independent of Spark)."""
    import re
    if line is None:
        return (None, None, None)
    fields = re.split(r"\|~\|", line)
    a0 = fields[0]
    hour = a0[:13].replace("T", "-") if len(a0) >= 13 else None
    if len(fields) < 3:
        return (hour, None, None)
    pieces = re.split(r"[=|&]", fields[2])
    user = pieces[1] if len(pieces) > 1 else None
    site = pieces[3] if len(pieces) > 3 else None
    return (hour, user, site)


def test_random_lines_match_model(spark):
    import random
    rng = random.Random(7)
    alphabet = ["|", "~", "|~|", "=", "&", "T", "2", "0", "-", ":", "a", "b", " ", "é", "\U0001F600", "\n"]
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    lines += ["2024-01-01T00:00:00" + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
              for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(lines)), "id INT, value STRING")
    got = {r["id"]: (r["hour"], r["user_id"], r["site_id"])
           for r in parse.with_log_fields(df).collect()}
    bad = [(lines[i], got[i], _model(lines[i])) for i in range(len(lines)) if got[i] != _model(lines[i])]
    assert not bad, bad[:5]
