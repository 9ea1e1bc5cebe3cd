"""N-gram Jaccard join: a blocked sparse product of the document x n-gram incidence.

Rows of the incidence matrix are documents, columns are 5-word shingles. The
product of the matrix with its transpose counts shared shingles of two
documents; only entries that can reach the threshold are formed:

1. Documents with equal shingle sets are one class (aggregate on a 128-bit set
   key), so copies never meet each other as pairs.
2. Columns are put in one global order, rarest first, by a fixed-size count
   sketch over all documents. Two sets that reach the threshold must share a
   column among the first ``n - ceil(t n) + 1`` of each, so only these entries
   of the matrix are shuffled. The sketch sets the order only; any order gives
   the same links.
3. Star step: in every column block each document is paired with the block's
   smallest document. Overlaps of these pairs are counted exactly, and links
   are joined into components. This is linear in the size of a group.
4. Rest: in blocks that still hold several components, pairs of different
   components within the size-derived bounds (size ratio, shorter prefix of the
   smaller set, position bound on the overlap still possible) are formed and
   counted exactly. A pair inside one component cannot change the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import apart, map_arrow, shingle_sets, stored, summed_arrays, tune
from refinery.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 80          # percent
SKETCH_BITS = 20        # 2^20 counters of 4 bytes: a fixed 4 MB, whatever the input
FILTER_BITS = 23        # bits of the id filter before the text join: a fixed 1 MB


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the sorted shingle set)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), k)
        return pa.record_batch(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                      pa.binary())],
            ["doc_id", "n_shingles", "set_key"])
    return map_arrow(docs, run, "doc_id long, n_shingles long, set_key binary")


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def shingle_sketch(docs: DataFrame, k: int = SHINGLE, bits: int = SKETCH_BITS) -> np.ndarray:
    """Counts of shingles per hash bucket over all documents (summed in two levels, fixed size).

    A count stops at the greatest number of 4 bytes: it only ranks the shingles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            sets = shingle_sets(batch.column("text"), k)
            counts = capped_sum(counts, np.bincount(_bucket(np.concatenate(sets), bits), minlength=1 << bits))
        yield pa.record_batch([pa.array([counts.tobytes()], pa.binary())], ["c"])
    parts = docs.select("text").mapInArrow(run, "c binary").rdd.map(
        lambda r: np.frombuffer(bytes(r[0]), np.uint32))
    found = summed_arrays(parts, capped_sum)
    return np.zeros(1 << bits, np.uint32) if found is None else found


def capped_sum(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of two arrays of counts in 4 bytes; too large ones stop at the greatest number."""
    out = x + y.astype(np.uint32)
    out[out < x] = 0xFFFFFFFF
    return out


def _prefix(n: int, num: int, den: int) -> int:
    """Entries of a set of ``n`` that must meet a partner's, if num/den of it is shared."""
    return n - -(-n * num // den) + 1


def _entries(docs: DataFrame, sketch, k: int, percent: int) -> DataFrame:
    """Prefix entries of the incidence matrix: token, doc_id, n, pos.

    Within a partition only the first document of each shingle set is written
    (bounded memory of sets seen); the rest follow it through their class.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        bits = int(np.log2(len(counts)))
        for batch in batches:
            tok, ids, ns, pos = [], [], [], []
            for d, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), k)):
                n = len(s)
                # a set so small that one more entry is too many links with its equals only
                if d is None or not n or 100 * n < percent * (n + 1):
                    continue
                key = xxhash.xxh3_128_digest(s.tobytes())
                if key in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                p = _prefix(n, percent, 100)
                c = counts[_bucket(s, bits)]
                first = np.lexsort((s, c))[:p]
                tok.append(s[first].view(np.int64))
                ids.append(np.full(p, d, np.int64))
                ns.append(np.full(p, n, np.int32))
                pos.append(np.arange(p, dtype=np.int32))
            if tok:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (tok, ids, ns, pos)],
                                      ["token", "doc_id", "n", "pos"])
    return docs.mapInArrow(run, "token long, doc_id long, n int, pos int")


def _may_link(n: Column, pos: Column, m: Column, at: Column, percent: int) -> Column:
    """Size-derived bounds: the sizes are close enough, and a first shared column at these
    positions leaves room for the overlap that the threshold needs."""
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (F.least(n - pos, m - at) * (100 + percent) >= percent * (n + m)))


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id may be in ``ids`` (a fixed-size bit filter; false hits are harmless)."""
    sc, mask = docs.sparkSession.sparkContext, (1 << FILTER_BITS) - 1

    def slots(x: np.ndarray) -> np.ndarray:
        return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
                ).astype(np.int64) & mask

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            bits[slots(b.column(0).to_numpy())] = True
        yield pa.record_batch([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["b"])
    parts = ids.mapInArrow(build, "b binary").rdd.map(lambda r: np.frombuffer(bytes(r[0]), np.uint8))
    bits = sc.broadcast(summed_arrays(parts, lambda x, y: x | y))       # packed, 8 ids a byte

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = slots(batch.column("doc_id").to_numpy())
        return batch.filter(pa.array((bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))
    return map_arrow(docs.select("doc_id", "text").where("doc_id is not null"), keep,
                     "doc_id long, text string")


def _links(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose shingle sets reach the threshold, counted exactly.

    Rows of the incidence matrix are rebuilt from the texts of the paired
    documents; a row block is one ``a`` with all its partners.
    """
    if pairs.isEmpty():
        return pairs.select("a", "b")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = _only(docs, ids)
    x = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
         .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
         .select("a", "b", "ta", "tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # each distinct left text of the batch is turned into its set once
            enc = batch.column("ta").dictionary_encode()
            left, hit = shingle_sets(enc.dictionary, k), []
            for i, sb in zip(enc.indices.to_pylist(), shingle_sets(batch.column("tb"), k)):
                o = len(np.intersect1d(left[i], sb, assume_unique=True))
                hit.append(o > 0 and 100 * o >= percent * (len(left[i]) + len(sb) - o))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))
    return x.mapInArrow(run, "a long, b long")


def ngram_components(docs: DataFrame, k: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Two documents link when ``100 * intersection >= percent * union`` of their
    sets of distinct ``k``-word shingles (fewer words: the whole sequence as
    one). component_id is the smallest doc_id reachable by links.

    Null or blank texts have n_shingles 0 and link with nothing (component_id is
    the own id). Rows with a null doc_id are counted but link with nothing
    (component_id null). Rows that repeat a doc_id are one document with the
    links of any of its rows. An empty table gives an empty result.
    """
    spark = tune(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    prof = stored(_profile(docs, k), "ngram-profile")
    sets = prof.where("set_key is not null and doc_id is not null")
    copies = stored(sets.groupBy("n_shingles", "set_key")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep"))
                    .where("n > 1").drop("n"), "ngram-copies")
    rep = stored(sets.join(copies, ["n_shingles", "set_key"], "left")
                 .select("doc_id", F.coalesce("rep", "doc_id").alias("rep")), "ngram-classes")
    # a document stands for itself if it is in several classes (repeated id, other text)
    one = (rep.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
           .select("doc_id", F.when(F.col("lo") == F.col("hi"), F.col("lo"))
                   .otherwise(F.col("doc_id")).alias("rep"), (F.col("lo") < F.col("hi")).alias("several")))
    ties = (rep.join(one.where("several").select("doc_id"), "doc_id")
            .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"))
    one = stored(one.drop("several"), "ngram-ids")

    sketch = spark.sparkContext.broadcast(shingle_sketch(docs, k))
    entries = _entries(docs, sketch, k, percent)
    # per block: its smallest document, with that document's set size and position
    entry = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos").cast("long"))
    block = (entries.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("first"),
                                          F.min_by(entry, "doc_id").alias("_e"))
             .where("df > 1").select("token", "first", F.shiftright("_e", 32).cast("int").alias("first_n"),
                                     F.col("_e").bitwiseAND(0xFFFFFFFF).cast("int").alias("first_pos")))
    # entries of blocks with two documents or more, by class
    shared = stored(entries.join(apart(block, "token"), "token").join(one, "doc_id")
                    .select("token", "first", "first_n", "first_pos", F.col("rep").alias("id"), "n", "pos"),
                    "ngram-blocks")
    sketch.unpersist()
    star = (shared.where(_may_link(F.col("n"), F.col("pos"), F.col("first_n"), F.col("first_pos"), percent))
            .select("first", "id").distinct()
            .join(one.select(F.col("doc_id").alias("first"), F.col("rep").alias("a")), "first")
            .select("a", F.col("id").alias("b")).where("a <> b").distinct())
    links = ties.unionByName(_links(stored(star, "ngram-star"), docs, k, percent))
    links = stored(links, "ngram-links")
    comp = stored(connected_components(links), "ngram-components")

    # blocks that still hold several components: pairs within the bounds
    named = (shared.select("token", "id", "n", "pos").distinct()
             .join(comp, F.col("id") == F.col("node"), "left")
             .select("token", "id", "n", "pos", F.coalesce("root", "id").alias("comp")))
    mixed = (named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo < hi").select("token"))
    open_ = stored(named.join(apart(mixed, "token"), "token"), "ngram-open")
    s, t = open_.alias("s"), open_.alias("t")
    n_s, n_t = F.col("s.n"), F.col("t.n")
    rest = (s.join(t, (F.col("s.token") == F.col("t.token")) & (F.col("s.comp") != F.col("t.comp"))
                   & ((n_s < n_t) | ((n_s == n_t) & (F.col("s.id") < F.col("t.id"))))
                   & _may_link(n_s, F.col("s.pos"), n_t, F.col("t.pos"), percent))
            .select(F.least("s.id", "t.id").alias("a"), F.greatest("s.id", "t.id").alias("b"))
            .distinct().join(star, ["a", "b"], "left_anti"))
    rest = stored(rest, "ngram-rest")
    if not rest.isEmpty():
        more = stored(_links(rest, docs, k, percent), "ngram-links")
        if not more.isEmpty():
            # links between components found so far, as links between their roots
            for end in ("a", "b"):
                more = (more.join(comp.select(F.col("node").alias(end), F.col("root").alias("_r")), end, "left")
                        .withColumn(end, F.coalesce("_r", end)).drop("_r"))
            top = stored(connected_components(more), "ngram-roots").select(
                F.col("node").alias("root"), F.col("root").alias("_top"))
            comp = (comp.join(top, "root", "left").select("node", F.coalesce("_top", "root").alias("root"))
                    .unionByName(top.join(comp.select("root"), "root", "left_anti")
                                 .select(F.col("root").alias("node"), F.col("_top").alias("root"))))
    final = (one.join(comp, F.col("rep") == F.col("node"), "left")
             .select("doc_id", F.coalesce("root", "rep").alias("component")))
    return (prof.join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """The documents with one of each component: the row of its smallest doc_id.

    Rows without words or without an id link with nothing and stay. Where ids repeat, rows
    are told apart by id and text (a 64-bit hash): of equal rows one stays, of linked
    texts the one of the smallest id (then hash), and a text that links with none stays
    also if another one has its id. An empty table gives no rows.
    """
    ids = docs.where("doc_id is not null").groupBy("doc_id").count()
    if stored(ids.where("count > 1").select("doc_id"), "ngram-repeated").isEmpty():
        gone = ngram_components(docs, k, percent).where("doc_id <> component_id").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti")
    row = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("text").cast("string")))
    keyed = docs.withColumn("_row", row)
    comp = stored(ngram_components(keyed.select(F.col("_row").alias("doc_id"), "text"), k, percent)
                  .where("doc_id is not null and n_shingles > 0").distinct(), "ngram-rows")
    member = comp.select(F.col("doc_id").alias("_row"), "component_id").join(
        keyed.where("_row is not null").select("_row", "doc_id").distinct(), "_row")
    best = stored(member.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("_b"))
                  .select("_b._row"), "ngram-kept")
    linked = keyed.join(comp.select(F.col("doc_id").alias("_row")), "_row", "left_semi")
    others = keyed.join(comp.select(F.col("doc_id").alias("_row")), "_row", "left_anti")
    kept = linked.join(best, "_row", "left_semi").dropDuplicates(["_row"]).unionByName(others)
    return kept.select(*docs.columns)
