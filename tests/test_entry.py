"""The driver contract: entry, queries and oracle keys."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["fecha", "categoria", "canal", "num_ventas", "unidades",
                          "importe_total", "ticket_medio"]


def test_every_library_query_has_an_oracle():
    from refinery.queries import QUERIES
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
