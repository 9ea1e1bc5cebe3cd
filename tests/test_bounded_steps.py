"""Landing, ingest and promotion move no more bytes than they need."""
import datetime as dt
import gzip
from pathlib import Path
import zlib

from pyspark.sql import functions as F

from refinery.contracts import Contract
from refinery.operators.latest import latest_per_key
from refinery.operators.merge import newer_rows, upsert_frame
from refinery.plans import roles as R
from refinery.plans.pipeline import SalesPipeline
from refinery.session import settings
from refinery.sources import files
from refinery.sources.files import read_jsonl, write_jsonl
from refinery.sources.tables import VersionedTable

CONTRACT = Contract.from_dict({"name": "t", "schema": "s", "catalog": "c", "keys": ["k"], "columns": [
    {"name": "k", "type": "LONG", "nullable": False}, {"name": "at", "type": "LONG", "nullable": True},
    {"name": "x", "type": "STRING", "nullable": True}]})
DDL = "k long, at long, x string"


def _sale(key, day):
    return (key, 1, 1, 1, 1.0, 10.0, 0.0, 0.0, "R", "F", day)


def test_compact_landing_is_gzip_in_bounded_files_and_reads_the_same(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(files, "COMPACT_ROWS", 10)
    rows = spark.range(0, 35, 1, 1).select("id", F.when(F.col("id") % 2 == 0, F.lit("é\n\"")).alias("x"))
    write_jsonl(rows, f"{tmp_root}/l", compact=True)
    back = read_jsonl(spark, f"{tmp_root}/l", "id long, x string")
    names = back.inputFiles()
    assert len(names) == 4 and all(n.endswith(".json.gz") for n in names)
    assert sorted(back.select("id", "x").collect()) == sorted(rows.collect())


def test_settings_are_put_back_also_after_a_failure(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    try:
        with settings(spark, {key: "3"}):
            assert spark.conf.get(key) == "3"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(key, None) == before


def test_ingest_does_not_sort_rows_by_outcome(spark, tmp_root, monkeypatch):
    p, seen = SalesPipeline(spark, tmp_root), []
    p.land(spark.createDataFrame([_sale(1, "2024-01-01")], R.LANDING_SALES.schema))
    writer = type(spark.range(1).write)
    parquet = writer.parquet

    def spy(self, path, *a, **kw):
        if path.startswith(p.bronze.path):
            seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return parquet(self, path, *a, **kw)
    monkeypatch.setattr(writer, "parquet", spy)
    p.ingest_bronze(dt.datetime(2024, 1, 1), dt.date(2024, 1, 1))
    assert seen == ["8"] and p.bronze.read().count() == 1


def _table(spark, root, rows):
    t = VersionedTable(spark, f"{root}/t", contract=CONTRACT)
    t.overwrite(spark.createDataFrame(rows, DDL))
    return t


def test_full_merge_uses_the_shuffle_of_the_latest_rows(spark, tmp_root, capsys, monkeypatch):
    t = _table(spark, tmp_root, [(1, 1, "a")])
    latest = latest_per_key(spark.createDataFrame([(1, 2, "b"), (2, 1, "c")], DDL), ["k"], ["at"])
    commit = t._commit

    def planned(v, new, *rest):
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            new.explain()
        return commit(v, new, *rest)
    monkeypatch.setattr(t, "_commit", planned)
    t.merge_latest(latest)
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 2, plan    # the table, and the window's
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 2, "b"), (2, 1, "c")]


def test_merge_of_newer_rows_is_the_same_by_one_join(spark, tmp_root):
    stored = [(1, 5, "a"), (2, 5, None), (3, None, "a"), (4, 5, "z")]
    batch = spark.createDataFrame([(1, 4, "b"), (2, 5, "b"), (3, 1, "b"), (5, None, None), (4, None, "b")], DDL)
    t = _table(spark, tmp_root, stored)
    old = t.read()
    fresh = newer_rows(old, batch, ["k"], ["at"])
    expected = sorted(map(str, upsert_frame(old, fresh, ["k"]).collect()))
    assert t.merge_latest(batch, newer=["at", "x"]) == 1
    assert sorted(map(str, t.read().collect())) == expected
    # nothing newer: no version
    assert t.merge_latest(spark.createDataFrame([(1, 4, "b")], DDL), newer=["at", "x"]) == 1
    assert t.current_version() == 1


def test_large_and_small_increments_give_the_same_table(spark, tmp_root, monkeypatch):
    import refinery.plans.pipeline as P
    found = []
    for share in (0.0, 1e9):
        monkeypatch.setattr(P, "LARGE_SHARE", share)
        p = SalesPipeline(spark, f"{tmp_root}/{share}")
        for n, keys in enumerate(([1, 2, 3], [2, 4], [1])):
            day = dt.date(2024, 1, 1 + n)
            p.land(spark.createDataFrame([_sale(k, f"2024-02-0{9 - n}") for k in keys], R.LANDING_SALES.schema), f"d{n}")
            p.bronze_specs[0].source_path = f"{p.landing}/d{n}"
            p.ingest_bronze(dt.datetime(2024, 1, 1 + n), day)
            p.promote_silver(dt.datetime(2024, 1, 1 + n), ingested_since=day)
        found.append((p.silver.current_version(),
                      sorted(map(tuple, p.silver.read().drop("_source_file").collect()))))
    assert found[0] == found[1] and len(found[0][1]) == 4


def test_compact_landing_uses_the_fastest_gzip_level(spark, tmp_root):
    rows = spark.range(0, 20_000, 1, 1).select("id", F.md5(F.col("id").cast("string")).alias("x"),
                                               (F.col("id") % 50).cast("double").alias("q"))
    write_jsonl(rows, f"{tmp_root}/l", compact=True)
    (name,) = spark.read.text(f"{tmp_root}/l").inputFiles()
    packed = Path(name.removeprefix("file://")).read_bytes()
    text = gzip.decompress(packed)
    fast, usual = (len(zlib.compress(text, level)) for level in (1, 6))
    assert abs(len(packed) - fast) < abs(len(packed) - usual), (len(packed), fast, usual)
