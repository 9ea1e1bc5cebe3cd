"""Merges, latest-per-key and change rows."""
import pytest

from refinery.operators import merge as M
from refinery.operators.latest import latest_per_key

DDL = "k long, v string, x double"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", 2.0), (2, "z", 0.0)], DDL)
    got = _rows(latest_per_key(df, ["k"], ["x"]))
    # tie on x=2.0 is broken by the remaining columns, descending
    assert got == [(1, "c", 2.0), (2, "z", 0.0)]


def test_upsert_updates_and_inserts(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], DDL)
    s = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0)], DDL)
    assert _rows(M.upsert_frame(t, s, ["k"])) == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0)]


def test_refuses_duplicate_or_null_keys(spark):
    dup = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], DDL)
    with pytest.raises(M.MergeError):
        M.require_unique_keys(dup, ["k"])
    nul = spark.createDataFrame([(None, "a", 1.0)], DDL)
    with pytest.raises(M.MergeError):
        M.require_unique_keys(nul, ["k"])


def test_delete_by_keys_and_predicate(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0)], DDL)
    keys = spark.createDataFrame([(1,)], "k long")
    assert sorted(r.k for r in M.delete_frame(t, ["k"], keys_df=keys).collect()) == [2, 3]
    # NULL predicate keeps the row
    assert sorted(r.k for r in M.delete_frame(t, condition="v = 'c'").collect()) == [1, 2]


def test_upsert_changes_silent_when_equal(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0)], DDL)
    s = spark.createDataFrame([(1, "a", 1.0), (2, None, 5.0), (3, "n", 3.0)], DDL)
    got = _rows(M.upsert_changes(t, s, ["k"]))
    assert got == [(2, None, 2.0, "update_preimage"), (2, None, 5.0, "update_postimage"),
                   (3, "n", 3.0, "insert")]


def test_diff_changes_with_nulls(spark):
    old = spark.createDataFrame([(1, None, 1.0), (2, "b", 2.0), (3, "c", None)], DDL)
    new = spark.createDataFrame([(1, None, 1.0), (2, "B", 2.0), (4, "d", 4.0)], DDL)
    got = _rows(M.diff_changes(old, new, ["k"]))
    assert got == [(2, "B", 2.0, "update_postimage"), (2, "b", 2.0, "update_preimage"),
                   (3, "c", None, "delete"), (4, "d", 4.0, "insert")]


def test_diff_changes_without_keys_is_multiset(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0)], DDL)
    new = spark.createDataFrame([(1, "a", 1.0)], DDL)
    assert _rows(M.diff_changes(old, new)) == [(1, "a", 1.0, "delete")]


CDC_T = "k long, v string, _seq long, is_deleted boolean"
CDC_C = "k long, v string, op_type string, _seq long"


def _cdc(spark, batches):
    t = spark.createDataFrame([], CDC_T)
    for b in batches:
        t = _materialize(spark, M.cdc_merge_frame(t, spark.createDataFrame(b, CDC_C), ["k"]))
    return _rows(t)


def _materialize(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def test_cdc_soft_delete_and_revive(spark):
    got = _cdc(spark, [[(1, "a", "I", 1), (2, "b", "I", 1)],
                       [(1, "a2", "U", 2), (2, None, "D", 2)],
                       [(2, "b3", "I", 3)]])
    assert got == [(1, "a2", 2, False), (2, "b3", 3, False)]


def test_cdc_delete_keeps_stored_values_when_record_has_only_key(spark):
    got = _cdc(spark, [[(1, "a", "I", 1)], [(1, None, "D", 2)]])
    assert got == [(1, "a", 2, True)]


def test_cdc_order_of_arrival_does_not_matter(spark):
    changes = [(1, "a", "I", 1), (1, "a2", "U", 2), (1, "a2", "D", 3), (2, "b", "I", 1),
               (2, "b2", "U", 2)]
    in_order = _cdc(spark, [changes[:2], changes[2:3], changes[3:]])
    reversed_ = _cdc(spark, [changes[3:], changes[2:3], changes[:2]])
    one_batch = _cdc(spark, [changes])
    assert in_order == reversed_ == one_batch == [(1, "a2", 3, True), (2, "b2", 2, False)]


def test_full_merge_keeps_or_deletes_missing_keys(spark):
    t = spark.createDataFrame([(1, "a", 1.0, None), (5, "e", 5.0, None)],
                              "k long, v string, x double, _silver_modified_at timestamp")
    src = spark.createDataFrame([(1, "a1", 1.0), (1, "a2", 2.0), (2, "b", 2.0)], DDL)
    keep = M.full_merge_frame(t, src, ["k"], "x").drop("_silver_modified_at")
    assert _rows(keep) == [(1, "a2", 2.0), (2, "b", 2.0), (5, "e", 5.0)]
    drop = M.full_merge_frame(t, src, ["k"], "x", delete_missing=True).drop("_silver_modified_at")
    assert _rows(drop) == [(1, "a2", 2.0), (2, "b", 2.0)]


def test_cdc_delete_stamps_deleted_at(spark):
    t = spark.createDataFrame([], "k long, v string, _seq long, is_deleted boolean, "
                                  "deleted_at timestamp")
    ch = spark.createDataFrame([(1, "a", "I", 1, "2024-01-01 00:00:00"),
                                (1, "a", "D", 2, "2024-01-02 00:00:00"),
                                (2, "b", "I", 1, "2024-01-01 00:00:00")],
                               "k long, v string, op_type string, _seq long, ts string")
    out = M.cdc_merge_frame(t, ch, ["k"], time_col="ts")
    got = {r.k: (r.is_deleted, str(r.deleted_at)) for r in out.collect()}
    assert got == {1: (True, "2024-01-02 00:00:00"), 2: (False, "None")}
