"""Versioned tables, feed, partitioned Bronze, contracts."""
import datetime as dt

from pyspark.sql import functions as F

import pytest

from refinery.contracts import Contract, ContractError, check, conform, resolve
from refinery.operators.merge import CHANGE_TYPE
from refinery.sources.tables import PartitionedTable, TableError, VersionedTable

DDL = "k long, v string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_and_history(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    assert not t.exists() and t.current_version() is None
    assert t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], DDL)) == 0
    assert t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], DDL)) == 1
    assert t.delete(keys_df=spark.createDataFrame([(1,)], "k long")) == 2
    assert t.current_version() == 2
    assert _rows(t.read(0)) == [(1, "a"), (2, "b")]
    assert _rows(t.read()) == [(2, "B"), (3, "c")]
    ops = sorted((r.version, r.operation, r.num_rows) for r in t.history().collect())
    assert ops == [(0, "WRITE", 2), (1, "MERGE", 3), (2, "DELETE", 2)]


def test_feed_rows_and_range(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], DDL))
    t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], DDL))
    t.delete(condition="k = 1")
    feed = t.read_changes(1, 2).select("k", "v", CHANGE_TYPE, "_commit_version")
    assert _rows(feed) == [(1, "a", "delete", 2), (2, "B", "update_postimage", 1),
                           (2, "b", "update_preimage", 1), (3, "c", "insert", 1)]
    assert t.read_changes(2).count() == 1
    with pytest.raises(TableError):
        t.read_changes(0)


def test_feed_replay_rebuilds_next_version(spark, tmp_root):
    """Applying the feed of version N+1 to snapshot N gives snapshot N+1."""
    from pyspark.sql import functions as F
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(i, f"v{i}") for i in range(20)], DDL))
    t.upsert(spark.createDataFrame([(i, f"w{i}") for i in range(15, 30)], DDL))
    feed = t.read_changes(1, 1)
    gone = feed.where(F.col(CHANGE_TYPE).isin("delete", "update_preimage")).select("k", "v")
    came = feed.where(F.col(CHANGE_TYPE).isin("insert", "update_postimage")).select("k", "v")
    replayed = t.read(0).exceptAll(gone).unionByName(came)
    assert _rows(replayed) == _rows(t.read(1))


def test_overwrite_emits_diff_feed(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], DDL))
    t.overwrite(spark.createDataFrame([(2, "b"), (3, "c")], DDL))
    assert _rows(t.read_changes(1).select("k", CHANGE_TYPE)) == [(1, "delete"), (3, "insert")]


def test_partition_overwrite_is_idempotent_per_day(spark, tmp_root):
    from pyspark.sql import functions as F
    t = PartitionedTable(spark, f"{tmp_root}/b", partition_by=["d"])
    day = lambda d, n: spark.range(n).withColumn("d", F.lit(d).cast("date"))
    t.write(day("2024-01-01", 5))
    t.write(day("2024-01-01", 5))
    t.write(day("2024-01-02", 3))
    counts = sorted((str(r.d), r["count"]) for r in t.read().groupBy("d").count().collect())
    assert counts == [("2024-01-01", 5), ("2024-01-02", 3)]


CONTRACT = {
    "catalog": "{catalog.silver}", "schema": "s", "name": "t",
    "columns": [{"name": "k", "type": "LONG", "nullable": False},
                {"name": "v", "type": "STRING"}, {"name": "n", "type": "INTEGER"}],
    "keys": ["k"],
}


def test_contract_templates_and_schema():
    c = Contract.from_dict(CONTRACT, {"catalog": {"silver": "silver_dev"}})
    assert c.full_name == "silver_dev.s.t"
    assert c.schema.simpleString() == "struct<k:bigint,v:string,n:int>"
    assert resolve("{path.landing}/x", {"path": {"landing": "/l"}}) == "/l/x"


def test_conform_orders_casts_and_refuses(spark):
    c = Contract.from_dict(CONTRACT, {"catalog": {"silver": "x"}})
    df = spark.createDataFrame([("a", 7, 1)], "v string, n long, k long")
    out = conform(df, c)
    assert out.columns == ["k", "v", "n"] and dict(out.dtypes)["n"] == "int"
    with pytest.raises(ContractError):
        conform(spark.createDataFrame([(1,)], "k long"), c)
    bad = spark.createDataFrame([(None, "a", 1)], "k long, v string, n int")
    with pytest.raises(Exception):
        conform(bad, c).collect()


def test_failed_write_leaves_no_version(spark, tmp_root):
    c = Contract.from_dict(CONTRACT, {"catalog": {"silver": "x"}})
    t = VersionedTable(spark, f"{tmp_root}/t", contract=c)
    with pytest.raises(Exception):
        t.overwrite(spark.createDataFrame([(None, "a", 1)], "k long, v string, n int"))
    assert not t.exists()


def test_contract_check_counts(spark):
    c = Contract.from_dict(CONTRACT, {"catalog": {"silver": "x"}})
    df = spark.createDataFrame([(None, "a"), (2, "b"), (None, None)], "k long, v string")
    rows = {r["column"]: r for r in check(df, c).collect()}
    assert rows["k"]["not_null_violations"] == 2
    assert rows["v"]["nulls"] == 1 and rows["v"]["not_null_violations"] == 0
    assert rows["n"]["present"] is False and rows["n"]["nulls"] == 3


def test_rerun_after_lost_commit_replaces_uncommitted_folder(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a")], DDL))
    # a job that died after writing the next snapshot but before its commit row
    spark.createDataFrame([(9, "junk")], DDL).write.parquet(f"{tmp_root}/t/snapshot/_v=1")
    fresh = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    assert fresh.current_version() == 0
    assert fresh.upsert(spark.createDataFrame([(2, "b")], DDL)) == 1
    assert _rows(fresh.read()) == [(1, "a"), (2, "b")]


def test_keyed_overwrite_with_duplicate_keys_is_refused(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a")], DDL))
    with pytest.raises(Exception):
        t.overwrite(spark.createDataFrame([(1, "a"), (1, "b")], DDL))
    assert t.current_version() == 0


def test_corrupt_landing_lines_are_kept_aside(spark, tmp_root):
    from refinery.sources.files import read_jsonl
    spark.createDataFrame([('{"k": 1, "v": "a"}',), ("{not json",), ('{"k": "x", "v": "b"}',)],
                          "value string").coalesce(1).write.text(f"{tmp_root}/landing/a")
    df = read_jsonl(spark, f"{tmp_root}/landing", DDL).cache()
    assert df.where("_corrupt_record IS NULL").count() == 1
    c = Contract.from_dict(CONTRACT, {"catalog": {"silver": "x"}})
    rows = {r["column"]: r for r in check(df, c).collect()}
    assert rows["_corrupt_record"]["cast_failures"] == 2
    df.unpersist()


def test_sql_views_over_versions_and_feed(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], DDL))
    t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], DDL))
    t.create_view("t_now")
    t.create_view("t_v0", 0)
    t.create_changes_view("t_changes", 1)
    got = spark.sql("""
        SELECT 'now' AS v, COUNT(*) AS n FROM t_now
        UNION ALL SELECT 'v0', COUNT(*) FROM t_v0""").collect()
    assert sorted(tuple(r) for r in got) == [("now", 3), ("v0", 2)]
    by_type = spark.sql("SELECT _change_type, COUNT(*) AS n FROM t_changes GROUP BY _change_type")
    assert sorted(tuple(r) for r in by_type.collect()) == [
        ("insert", 1), ("update_postimage", 1), ("update_preimage", 1)]


def test_open_feed_read_ignores_uncommitted_version(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a")], DDL))
    t.upsert(spark.createDataFrame([(2, "b")], DDL))
    # change rows of a version 2 whose commit row was never written
    (t.read_changes(1).withColumn("v", F.lit("zz")).drop("_commit_version")
     .write.parquet(f"{tmp_root}/t/changes/_commit_version=2"))
    assert t.read_changes(1).count() == 1


def test_rerun_replaces_partitions_left_by_a_dead_attempt(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], partition_by=["v"])
    t.overwrite(spark.createDataFrame([(1, "a")], DDL))
    # a dead attempt at version 1 left a partition that the re-run does not write
    spark.createDataFrame([(9,)], "k long").write.parquet(f"{tmp_root}/t/snapshot/_v=1/v=zz")
    fresh = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], partition_by=["v"])
    fresh.upsert(spark.createDataFrame([(2, "b")], DDL))
    assert sorted((r.k, r.v) for r in fresh.read().collect()) == [(1, "a"), (2, "b")]


def test_version_with_no_changes_keeps_the_feed_complete(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a")], DDL))
    t.upsert(spark.createDataFrame([(1, "a")], DDL))        # equal row: no change rows
    assert t.current_version() == 1 and t.read_changes(1).count() == 0
    assert t.feed_complete(1, 1)


def test_first_upsert_refuses_duplicate_keys(spark, tmp_root):
    from refinery.operators.merge import MergeError
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"])
    with pytest.raises(MergeError):
        t.upsert(spark.createDataFrame([(1, "a"), (1, "b")], DDL))


def test_feed_ranges_are_whole_or_refused(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", keys=["k"], change_feed=True)
    t.overwrite(spark.createDataFrame([(1, "a")], DDL))
    blind = VersionedTable(spark, f"{tmp_root}/t", keys=["k"])       # commits without a feed
    blind.upsert(spark.createDataFrame([(2, "b")], DDL))
    t.current_version()
    t.upsert(spark.createDataFrame([(3, "c")], DDL))
    # change rows of a version 3 that was never committed
    t.read_changes(2).drop("_commit_version").write.parquet(f"{tmp_root}/t/changes/_commit_version=3")
    assert t.read_changes(2, 2).count() == 1
    for start, end in ((1, 2), (2, 3), (1, 1), (3, 3)):
        with pytest.raises(TableError):
            t.read_changes(start, end)
    assert t.feed_complete(2, 2) and not t.feed_complete(1, 2)


def test_conform_refuses_loss(spark):
    c = Contract.from_dict(CONTRACT, {"catalog": {"silver": "x"}})
    with pytest.raises(ContractError):      # a column that the contract does not declare
        conform(spark.createDataFrame([(1, "a", 1, 2)], "k long, v string, n int, z int"), c)
    frame = spark.createDataFrame([(1, "a", 2.0)], "k long, v string, n double")
    assert conform(frame, c).collect()[0]["n"] == 2
    with pytest.raises(Exception):
        conform(spark.createDataFrame([(1, "a", 2.7)], "k long, v string, n double"), c).collect()


def test_scratch_folder_must_be_shared_on_a_cluster(spark):
    from refinery import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Cluster:
        conf = Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Cluster())
