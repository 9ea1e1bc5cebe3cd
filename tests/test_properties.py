"""Randomized invariants (hypothesis): feed replay and incremental == full."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.operators import incremental as inc
from refinery.operators import merge as M
from refinery.sources.tables import VersionedTable

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])
DDL = "k long, g string, u int, a double"
STATES = st.sampled_from(["x", "y", "z", None])
ROW = st.tuples(STATES, st.integers(1, 6), st.integers(0, 99999).map(lambda c: c / 100))


def _table(rows):
    return [(k, *r) for k, r in rows.items()]


@SETTINGS
@given(old=st.dictionaries(st.integers(0, 30), ROW, max_size=12),
       new=st.dictionaries(st.integers(0, 30), ROW, max_size=12))
def test_diff_replay_gives_the_new_state(spark, old, new):
    o = spark.createDataFrame(_table(old), DDL)
    n = spark.createDataFrame(_table(new), DDL)
    feed = M.diff_changes(o, n, ["k"])
    gone = feed.where(F.col("_change_type").isin("delete", "update_preimage")).drop("_change_type")
    came = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    replay = o.exceptAll(gone).unionByName(came)
    assert sorted(map(tuple, replay.collect()), key=repr) == sorted(map(tuple, n.collect()), key=repr)


BATCH = st.fixed_dictionaries({
    "upserts": st.dictionaries(st.integers(0, 40), ROW, max_size=8),
    "deletes": st.lists(st.integers(0, 40), max_size=6, unique=True),
})


@SETTINGS
@given(seed=st.dictionaries(st.integers(0, 40), ROW, min_size=1, max_size=15),
       batches=st.lists(BATCH, min_size=1, max_size=3))
def test_incremental_equals_full_for_any_batches(spark, tmp_root, seed, batches):
    import uuid
    root = f"{tmp_root}/{uuid.uuid4().hex[:8]}"
    src = VersionedTable(spark, f"{root}/src", keys=["k"], change_feed=True)
    gold = VersionedTable(spark, f"{root}/gold", keys=["g"])
    ctl = VersionedTable(spark, f"{root}/ctl", keys=["dataset"])
    src.overwrite(spark.createDataFrame(_table(seed), DDL))
    stamp = dt.datetime(2024, 1, 1)

    def check():
        inc.propagate(src, gold, ctl, "t", ["g"], "u", "a", stamp)
        got = gold.read().drop("_recalculado_at")
        full = inc.aggregate_groups(src.read(), ["g"], None, "u", "a").drop("_recalculado_at")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))

    check()
    for b in batches:
        src.upsert(spark.createDataFrame(_table(b["upserts"]), DDL), skip_empty=True)
        src.delete(keys_df=spark.createDataFrame([(k,) for k in b["deletes"]], "k long"),
                   skip_empty=True)
        check()
