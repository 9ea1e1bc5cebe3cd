"""Quality checks (Q1-Q4, Q6), each finding a planted violation."""
from pyspark.sql import functions as F

from refinery.functions.money import cents
from refinery.operators import quality as Q


def test_lifecycle_violations(spark):
    current = spark.createDataFrame(
        [("p1", "nuevo"), ("p2", "pagado"), ("p3", "entregado"), ("p4", "enviado")],
        "pedido_id string, estado string")
    updates = spark.createDataFrame(
        [("p1", "pagado"), ("p2", "nuevo"), ("p3", "cancelado"), ("p4", "entregado")],
        "pedido_id string, estado string")
    bad = Q.transition_violations(updates, current, ["pedido_id"], "estado", Q.ORDER_LIFECYCLE)
    assert sorted(tuple(r) for r in bad.collect()) == [
        ("p2", "pagado", "nuevo"), ("p3", "entregado", "cancelado")]


def test_amount_consistency(spark):
    df = spark.createDataFrame([("v1", 3, 9.99, 29.97), ("v2", 2, 5.00, 10.02)],
                               "venta_id string, cantidad int, precio double, importe double")
    bad = Q.amount_violations(df, ["venta_id"], "cantidad", cents("precio"), "importe")
    assert [r.venta_id for r in bad.collect()] == ["v2"]


def test_batch_conflicts(spark):
    k = "pedido_id string"
    ins = spark.createDataFrame([("n1",), ("p1",)], k)
    upd = spark.createDataFrame([("p2",), ("p3",)], k)
    dele = spark.createDataFrame([("p3",)], k)
    existing = spark.createDataFrame([("p1",), ("p2",), ("p3",)], k)
    got = sorted(tuple(r) for r in Q.batch_conflicts(ins, upd, dele, existing, ["pedido_id"]).collect())
    assert got == [("p1", "insert_existing_key"), ("p3", "update_and_delete")]


def test_duplicates_and_reemissions(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("venta_id"))
    df = df.unionByName(df.limit(10))
    assert Q.duplicate_keys(df, ["venta_id"]).count() == 10
    r = Q.reemission_count(df, ["venta_id"]).collect()[0]
    assert (r.rows, r.keys, r.reemitted) == (110, 100, 10)


def test_layer_counts(spark):
    out = Q.layer_counts({"Bronze": spark.range(525), "Silver": spark.range(500),
                          "Gold": spark.range(249)})
    assert sorted(tuple(r) for r in out.collect()) == [("Bronze", 525), ("Gold", 249),
                                                       ("Silver", 500)]
