"""The shared folder comes from the session's spark.checkpoint.dir."""

import pytest

from tidemark import session


def test_shared_root_is_the_configured_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = session.shared_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    assert session.scratch_path(spark, "x").startswith(root + "/tidemark/")
    # DataFrame.checkpoint() writes under the same shared folder
    assert root.split(":")[-1].rstrip("/") in spark.sparkContext.getCheckpointDir()


def test_cluster_session_without_checkpoint_dir_is_refused(monkeypatch, spark):
    class FakeContext:
        master = "yarn"

        def getConf(self):
            class C:
                def get(self, *_):
                    return None
            return C()

        def getCheckpointDir(self):
            return None

    class FakeSession:
        sparkContext = FakeContext()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSession())


def test_existing_settings_win(spark):
    keys = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.session.timeZone": "Asia/Tokyo"}
    previous = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        again = session.build_session(app_name="again")
        assert {k: again.conf.get(k) for k in keys} == keys
        given = session.build_session(extra={"spark.sql.session.timeZone": "UTC"})
        assert given.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v)


def test_hive_catalog_is_an_option(monkeypatch):
    seen = []
    monkeypatch.setattr(session.SparkSession.Builder, "enableHiveSupport", lambda self: seen.append(1) or self)
    session.build_session()
    assert not seen
    session.build_session(hive=True)
    assert seen


def test_scratch_scope_removes_what_it_owns(spark):
    from tidemark.session import scratch_path, scratch_scope
    from tidemark.sources import fs
    outside = scratch_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark) as scope:
        first, second, last = (scratch_path(spark, n) for n in ("first", "second", "last"))
        for path in (first, second, last):
            spark.range(3).write.parquet(path)
        assert scope.keep_last() == last.rpartition("/")[0]
    assert spark.read.parquet(last).count() == spark.read.parquet(outside).count() == 3
    assert not fs.exists(spark, first) and not fs.exists(spark, second)
    with scratch_scope(spark):
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
    assert not fs.exists(spark, path) and fs.exists(spark, last)
