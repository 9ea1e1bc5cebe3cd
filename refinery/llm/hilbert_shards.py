"""Sharding in Hilbert-curve order over several metadata dimensions.

Four dimensions are quantised to 16 steps each: language and source (hash
steps), size (log2 of the text's bytes) and the id's place in the table's id
range. A row's place on the Hilbert curve through this 16^4 grid orders the
table, and the order is cut into runs, so a shard covers a compact box of the
grid: a filter on any of the dimensions meets few shards.

Everything is DataFrame operations. A global row number without a single
task comes from counts per (cell, sub-cell): a sub-cell is a fixed number of
hash steps of the row, so a cell that holds most of the rows is still split.
The table of counts is summed up in blocks of 256 cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refinery.llm.common import let, stored

BITS = 4
DIMS = 4
SHARDS = 24
SUBS = 256              # sub-cells per cell
_PREVIOUS = (W.unboundedPreceding, -1)


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a grid point with integer axes below 2^bits."""
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, s: Column) -> Column:
        """One step of undoing the excess rotations and reflections of an axis."""
        p = s["q"] - 1
        flip = F.get(x, s["i"]).bitwiseAND(s["q"]) != 0
        t = F.get(x, F.lit(0)).bitwiseXOR(F.get(x, s["i"])).bitwiseAND(p)
        return F.transform(x, lambda v, j: (
            F.when((j == 0) & flip, v.bitwiseXOR(p))
            .when((~flip) & ((j == 0) | (j == s["i"])), v.bitwiseXOR(t)).otherwise(v)))

    def number(x: Column) -> Column:
        """Gray code over the axes, then their bits in turn, high bits first."""
        gray = F.transform(x, lambda _, j: F.aggregate(
            F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))
        masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
        places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                           for b in range(bits - 1, -1, -1) for i in range(n)])

        def bit(value: Column, q: Column) -> Column:
            return value.bitwiseAND(q) != 0

        return let(gray, lambda g: let(
            F.aggregate(masks, F.lit(0), lambda t, q: F.when(
                bit(F.get(g, F.lit(n - 1)), q), t.bitwiseXOR(q - 1)).otherwise(t)),
            lambda t: F.aggregate(places, F.lit(0), lambda acc, s: acc * 2 + F.when(
                bit(F.get(g, s["i"]).bitwiseXOR(t), s["q"]), 1).otherwise(0))))

    start = F.array(*[a.cast("int") for a in axes])
    return let(F.aggregate(steps, start, undo), number)


def _quantised(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns as ``row``, with size, checksum, curve cell and sub-cell."""
    top = (1 << BITS) - 1
    ids = docs.agg(F.min(F.col("doc_id").cast("double")).alias("lo"),
                   F.max(F.col("doc_id").cast("double")).alias("hi")).first()
    lo, step = ids["lo"] or 0.0, (((ids["hi"] or 0.0) - (ids["lo"] or 0.0)) + 1) / (top + 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + 8

    def dealt(name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(top + 1)).cast("int")

    def clipped(value: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(top), F.floor(value).cast("int")))

    axes = [dealt("lang"), dealt("source"), clipped(F.log2(size.cast("double")) - 4),
            F.coalesce(clipped((F.col("doc_id").cast("double") - lo) / step), F.lit(0))]
    h = F.xxhash64(F.col("doc_id").cast("long"), F.crc32(text.cast("binary")), size)
    return docs.select(
        F.struct(*carried).alias("row"), size.alias("_size"), F.crc32(text.cast("binary")).alias("_crc"),
        hilbert_index(axes).alias("_cell"), h.alias("_h"),
        F.shiftrightunsigned(h, 64 - SUBS.bit_length() + 1).cast("int").alias("_sub"))


def number_rows(docs: DataFrame, carried: list[str]) -> tuple[DataFrame, int]:
    """(rows with their place _rank in curve order from 0, number of rows)."""
    q = _quantised(docs, carried)
    counts = stored(q.groupBy("_cell", "_sub").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("_block", F.shiftright("_cell", 8)), "hilbert-counts")
    blocks = counts.groupBy("_block").agg(F.sum("n").alias("n"))        # at most 256 rows
    blocks = blocks.select("_block", F.coalesce(F.sum("n").over(
        W.orderBy("_block").rowsBetween(*_PREVIOUS)), F.lit(0)).alias("_base"))
    offsets = (counts.withColumn("_within", F.coalesce(F.sum("n").over(
        W.partitionBy("_block").orderBy("_cell", "_sub").rowsBetween(*_PREVIOUS)), F.lit(0)))
        .join(F.broadcast(blocks), "_block")
        .select("_cell", "_sub", (F.col("_base") + F.col("_within")).alias("_before")))
    order = W.partitionBy("_cell", "_sub").orderBy(
        "_h", "row.doc_id", "_crc", "_size", F.col("row.lang").cast("string"), F.col("row.source").cast("string"))
    ranked = (q.withColumn("_n", F.row_number().over(order)).join(offsets, ["_cell", "_sub"])
              .withColumn("_rank", F.col("_before") + F.col("_n") - 1))
    return ranked, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def shard_columns(docs: DataFrame, carried: list[str], shards: int = SHARDS) -> DataFrame:
    """The carried columns (as ``row``) with _size, _crc, _shard and _slot.

    Run s holds the ranks from ceil(s*N/shards) on: run lengths differ by one at most.
    """
    ranked, n = number_rows(docs, carried)
    shard = F.expr(f"(_rank * {shards}) div {max(n, 1)}").cast("int")
    return (ranked.withColumn("_shard", shard)
            .withColumn("_slot", F.col("_rank") - F.expr(f"(_shard * {n}L + {shards - 1}) div {shards}")))


def hilbert_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: shard counts are at most one apart. size is the text's UTF-8
    bytes plus 8 (null text: 8, checksum of the empty text). Null language, source
    or id take a place of their own on the grid; repeated rows and ties are placed by
    a hash and stay separate rows; an empty table gives no rows; fewer rows than
    shards leave shards empty.
    """
    return shard_columns(docs, ["doc_id", "lang", "source"], shards).select(
        "row.doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The input's columns with shard and slot (columns of these names are replaced).

    Every row is kept: nulls, ties and repeated rows are placed as in :func:`hilbert_shards`;
    an empty table stays empty.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    return shard_columns(docs, kept, shards).select(
        *[F.col("row").getField(c).alias(c) for c in kept], F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write one folder per shard with rows in curve order, for pruning by any dimension."""
    (shard_documents(docs, shards).repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
