"""Traffic metrics on a hand-made batch with known answers."""

from tidemark.operators import metrics, parse

LINES = [
    "2024-01-01T10:00:00|~|a|~|/p?uid=u1&sid=s1",
    "2024-01-01T10:30:00|~|a|~|/p?uid=u1&sid=s2",
    "2024-01-01T11:00:00|~|a|~|/p?uid=u2&sid=s1",
    "2024-01-02T09:00:00|~|a|~|/p?uid=u1&sid=s1",
    "broken line",
]


def _parsed(spark):
    return parse.parse_log(spark.createDataFrame([(v,) for v in LINES], "value STRING"))


def test_page_views(spark):
    p = _parsed(spark)
    assert {tuple(r) for r in metrics.pv_by_hour(p).collect()} == {
        ("2024-01-01-10", 2), ("2024-01-01-11", 1), ("2024-01-02-09", 1)}
    assert {tuple(r) for r in metrics.site_pv_by_hour(p).collect()} == {
        ("s1", "2024-01-01-10", 1), ("s2", "2024-01-01-10", 1),
        ("s1", "2024-01-01-11", 1), ("s1", "2024-01-02-09", 1)}
    assert metrics.batch_total(p).first()["events"] == 4


def test_unique_users_and_stored_members(spark):
    p = _parsed(spark)
    assert {tuple(r) for r in metrics.uv_by_day(p).collect()} == {("2024-01-01", 2), ("2024-01-02", 1)}
    stored = spark.createDataFrame([("2024-01-02", "u9"), ("2024-01-02", "u1")], "day STRING, user_id STRING")
    members = {tuple(r) for r in metrics.uv_members_by_day(p, stored).collect()}
    assert members == {("2024-01-01", "u1"), ("2024-01-01", "u2"), ("2024-01-02", "u1"), ("2024-01-02", "u9")}
    assert {tuple(r) for r in metrics.uv_from_members(metrics.uv_members_by_day(p, stored)).collect()} == {
        ("2024-01-01", 2), ("2024-01-02", 2)}
