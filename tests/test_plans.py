"""Physical-plan properties the scale design relies on (read from explain)."""

import pytest

from tidemark import queries as q
from tidemark.sources import derive, tables
from tidemark.streaming.ledger import batch_ledger_rows

SF = "/root/testdata/sf0.001"


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


@pytest.fixture()
def static_plans(spark):
    """Plans as the planner first lays them out: no AQE rewrites, no
    size-based broadcast of tiny test tables."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    previous = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in previous.items():
        spark.conf.set(k, v)


def test_metrics_aggregate_partially_and_prune_columns(spark, capsys, static_plans):
    plan = _plan(q.q_pv_by_hour(spark, SF), capsys)
    assert "partial_count" in plan                       # map-side combine before the shuffle
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "EvalPython" not in plan


def test_exact_distinct_users_shuffle_by_day_and_user_first(spark, capsys, static_plans):
    plan = _plan(q.q_uv_by_day(spark, SF), capsys)
    # dedup on (day, user_id) before counting per day: a hot day is spread out
    assert plan.count("Exchange") == 2
    assert "user_id" in plan.split("Exchange hashpartitioning(")[-1].split(")")[0]


def test_ledger_batch_is_one_aggregation_one_exchange(spark, capsys, static_plans):
    records = q._records(spark, SF).checkpoint(eager=True)
    plan = _plan(batch_ledger_rows(records, 0, 0), capsys)
    assert plan.count("Exchange") == 1
    assert "Expand" in plan


def test_dense_offsets_shuffle_the_records_once(spark, capsys, static_plans):
    ev = tables.load(spark, SF, "events", ["event_id", "ts", "user_id", "event_type"])
    plan = _plan(derive.topic_records(ev), capsys)
    big = [line for line in plan.splitlines() if "Exchange hashpartitioning(partition" in line]
    # 1 exchange of the records (shared by the join and the row_number window);
    # the other 3 move only the per-(partition, block) count table.
    assert plan.count("Exchange") == 4 and len(big) == 4
    assert plan.count("FileScan parquet [event_id") == 2   # records scan + count-table scan


def test_positioned_read_broadcasts_the_checked_range_table(spark, capsys):
    plan = _plan(q.q_positioned_read(spark, SF), capsys)
    assert "BroadcastHashJoin" in plan
    # the planned offsets reach the scan of the topic
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "offset" in line]
    assert any("GreaterThanOrEqual(offset," in line and "LessThan(offset," in line for line in pushed), plan


def _outside_codegen(plan: str) -> set[str]:
    import re
    outside = set()
    for line in plan.splitlines()[1:]:
        m = re.match(r"^[\s:+\-]*(\*\(\d+\) )?(\w+)", line)
        if m and not m.group(1):
            outside.add(m.group(2))
    return outside


EXPECTED_OUTSIDE = {"Exchange", "FileScan", "Scan", "Window", "AdaptiveSparkPlan"}


@pytest.mark.parametrize("name", ["parse_log", "parse_rejects", "pv_by_hour", "site_pv_by_hour",
                                  "uv_by_day", "offset_bounds", "encode_user_log"])
def test_row_work_stays_in_whole_stage_codegen(spark, capsys, static_plans, name):
    outside = _outside_codegen(_plan(getattr(q, "q_" + name)(spark, SF), capsys))
    assert outside <= EXPECTED_OUTSIDE, outside


def test_ledger_batch_in_whole_stage_codegen(spark, capsys, static_plans):
    records = q._records(spark, SF).checkpoint(eager=True)
    outside = _outside_codegen(_plan(batch_ledger_rows(records, 0, 0), capsys))
    assert outside <= EXPECTED_OUTSIDE, outside
