"""MinHash near-duplicates with tensored banding.

Two small collections of minhash groups are computed per document, ``SIDE`` groups of
``GROUP`` minhashes each. Every pair of a group from the first and one from the second
collection is a table key, so 2 x 16 x 3 = 96 minhashes give 256 tables of 6 minhashes
each; computed one by one these would take 1,536. Two sets of similarity J miss every table
with probability ``1 - (1 - (1 - J^3)^16)^2``: 2 in 100,000 at J = 0.8, 4 in a million at 0.82.

1. Documents with equal shingle sets are one class; one document stands for it.
2. A table can only hold two documents if both its groups do. Groups that one document
   alone has are dropped before the product is formed, so a text without relatives
   costs 32 rows instead of 256.
3. Star step: in each table key every document is paired with the smallest one. Linked
   pairs make components. This is linear in the size of a group.
4. Rest: documents of keys that still hold several components. A large family of texts that
   are alike, but mostly not alike enough, fills a key with documents that do not link; of
   these only pairs of different components are formed that also share one of their rarest
   shingles, as sets that reach the threshold must (size-derived prefix and position bounds).
5. A pair whose 96 minhashes agree in fewer than half of the places is dropped (at
   J = 0.8 that happens once in 10^10 pairs); all others are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import apart, map_arrow, shingle_sets, stored, tune
from refinery.llm.components import connected_components
from refinery.llm.ngram_join import _entries as prefix_entries
from refinery.llm.ngram_join import _may_link as may_link
from refinery.llm.ngram_join import _only as only_ids
from refinery.llm.ngram_join import shingle_sketch

SHINGLE = 2
THRESHOLD = 80          # percent
SIDE = 16               # groups in each of the two collections
GROUP = 3               # minhashes in a group
LEAST_AGREE = 48        # of the 96 minhashes, for a pair to be compared in full
BATCH_ROWS = 200        # rows of an Arrow batch: pairs of whole texts travel in them

_rng = np.random.default_rng(20250307)
_XOR = _rng.integers(0, 1 << 64, 2 * SIDE * GROUP, np.uint64)
_MUL = _rng.integers(0, 1 << 63, 2 * SIDE * GROUP, np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x 96) 32-bit minhashes of non-empty sets of 64-bit hashes."""
    out = np.empty((len(sets), len(_XOR)), np.uint32)
    if sets:
        values = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        for j, (x, m) in enumerate(zip(_XOR, _MUL)):
            out[:, j] = np.minimum.reduceat(((values ^ x) * m) >> np.uint64(32), starts)
    return out


def group_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows x 32) keys of the groups; the lowest bit tells the collection."""
    n = 2 * SIDE
    acc = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(signatures), n)).copy()
    grouped = signatures.reshape(len(signatures), n, GROUP).astype(np.uint64)
    for j in range(GROUP):
        acc = (acc ^ grouped[:, :, j]) * _MUL[j]
        acc ^= acc >> np.uint64(29)
    side = (np.arange(n) >= SIDE).astype(np.uint64)
    return ((acc << np.uint64(1)) | side).view(np.int64)


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_key, groups (32 keys), sig (low bytes of the 96 minhashes)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), k)
        full = [s for s in sets if len(s)]
        sigs = minhashes(full)
        low, keys, at = (sigs & np.uint32(0xFF)).astype(np.uint8), group_keys(sigs), 0
        digest, groups, sig = [], [], []
        for s in sets:
            if len(s):
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                groups.append(keys[at])
                sig.append(low[at].tobytes())
                at += 1
            else:
                digest.append(None)
                groups.append(None)
                sig.append(None)
        return pa.record_batch(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
             pa.array(groups, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
            ["doc_id", "n_shingles", "set_key", "groups", "sig"])
    return map_arrow(docs, run, "doc_id long, n_shingles long, set_key binary, groups array<long>, sig binary")


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def table_keys(reps: DataFrame) -> DataFrame:
    """(id, n, key) of every table key of a document whose two groups other documents share.

    ``reps`` holds id, n and groups, one row per class.
    """
    single = reps.select("id", "n", F.explode("groups").alias("g"))
    shared = single.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g")
    # at most 32 groups a document
    per_doc = (single.join(apart(shared, "g"), "g").groupBy("id", "n").agg(F.collect_set("g").alias("gs")))

    def of_side(side: int) -> Column:
        return F.filter("gs", lambda g: g.bitwiseAND(F.lit(1).cast("long")) == side)
    left, right = of_side(0), of_side(1)
    return (per_doc.select("id", "n", F.explode(left).alias("l"), right.alias("rs"))
            .select("id", "n", "l", F.explode("rs").alias("r"))
            .select("id", "n", F.xxhash64("l", "r").alias("key")))


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures agree in ``LEAST_AGREE`` places or more."""
    sigs = reps.select("id", "sig")
    x = (pairs.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
         .join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").select("a", "b", "sa", "sb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                  for c in ("sa", "sb"))
        return batch.select(["a", "b"]).filter(pa.array((sa == sb).sum(1) >= LEAST_AGREE))
    return map_arrow(x, run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    if pairs.isEmpty():
        return pairs
    texts = only_ids(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    x = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
         .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
         .select("a", "b", "ta", "tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once = batch.column("ta").dictionary_encode()       # a text that recurs is cut once
            left, hit = shingle_sets(once.dictionary, k), []
            for i, sb in zip(once.indices.to_pylist(), shingle_sets(batch.column("tb"), k)):
                o = len(np.intersect1d(left[i], sb, assume_unique=True))
                hit.append(o > 0 and 100 * o >= percent * (len(left[i]) + len(sb) - o))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))
    return x.mapInArrow(run, "a long, b long").distinct()


def _rest_pairs(docs: DataFrame, open_: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among the documents ``open_`` (id, comp) whose
    sizes and rarest shingles leave room for a link."""
    if open_.isEmpty():
        return open_.select(F.col("id").alias("a"), F.col("id").alias("b"))
    texts = stored(only_ids(docs, open_.select("id")), "minhash-open-texts")
    order = docs.sparkSession.sparkContext.broadcast(shingle_sketch(texts, k))
    entries = (prefix_entries(texts, order, k, percent).join(open_, F.col("doc_id") == F.col("id"))
               .select("token", "id", "comp", "n", "pos"))
    entries = stored(entries, "minhash-prefixes")
    order.unpersist()
    meeting = (entries.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
               .where("lo < hi").select("token"))
    several = stored(entries.join(apart(meeting, "token"), "token"), "minhash-meeting")
    s, t = several.alias("s"), several.alias("t")
    n, m = F.col("s.n"), F.col("t.n")
    return (s.join(t, (F.col("s.token") == F.col("t.token")) & (F.col("s.comp") != F.col("t.comp"))
                   & ((n < m) | ((n == m) & (F.col("s.id") < F.col("t.id"))))
                   & may_link(n, F.col("s.pos"), m, F.col("t.pos"), percent))
            .select(F.least("s.id", "t.id").alias("a"), F.greatest("s.id", "t.id").alias("b")).distinct())


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of
    distinct ``k``-word shingles (fewer words: the whole sequence as one). component_id is
    the smallest doc_id reachable by links; ``kept`` marks the rows that carry it.

    Null and blank texts have n_shingles 0, link with nothing and are kept. Rows with a
    null doc_id are counted, link with nothing and are kept (component_id null). Rows that
    repeat a doc_id are one document with the links of any of its rows. Other columns are
    left out. An empty table gives an empty result.
    """
    tune(docs.sparkSession).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prof = stored(_signed(docs, k), "minhash-signed")
    sets = prof.where("set_key is not null and doc_id is not null")
    copies = stored(sets.groupBy("n_shingles", "set_key")
                    .agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("rep"))
                    .where("c > 1").drop("c"), "minhash-copies")
    classed = sets.join(copies, ["n_shingles", "set_key"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    # a document of several texts stands for itself and is tied to the class of each
    one = stored(classed.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
                 .select("doc_id", "lo", (F.col("lo") < F.col("hi")).alias("several")), "minhash-ids")
    ties = (classed.select("doc_id", "rep").join(one.where("several").select("doc_id"), "doc_id")
            .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"))
    one = one.select("doc_id", F.when(F.col("several"), F.col("doc_id")).otherwise(F.col("lo")).alias("rep"))

    reps = stored(classed.where("doc_id = rep").dropDuplicates(["doc_id", "n_shingles", "set_key"])
                  .select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "groups", "sig"),
                  "minhash-reps")
    keys = stored(table_keys(reps), "minhash-tables")
    tables = (keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                      F.min_by("n", "id").alias("first_n"))
              .where("first < last").drop("last"))
    shared = stored(keys.join(apart(tables, "key"), "key"), "minhash-shared")
    star = (shared.where((F.col("id") > F.col("first")) & _sizes_allow(F.col("n"), F.col("first_n"), percent))
            .select(F.col("first").alias("a"), F.col("id").alias("b")).distinct())
    star = stored(star, "minhash-star")
    links = ties.unionByName(_confirmed(stored(_agreeing(star, reps), "minhash-agree"), docs, k, percent))
    comp = stored(connected_components(stored(links, "minhash-links")), "minhash-components")

    named = (shared.select("key", "id").join(comp, F.col("id") == F.col("node"), "left")
             .select("key", "id", F.coalesce("root", "id").alias("comp")))
    mixed = (named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo < hi").select("key"))
    open_ = stored(named.join(apart(mixed, "key"), "key").select("id", "comp").distinct(), "minhash-open")
    rest = stored(_rest_pairs(docs, open_, k, percent).join(star, ["a", "b"], "left_anti"), "minhash-rest")
    more = stored(_confirmed(stored(_agreeing(rest, reps), "minhash-agree"), docs, k, percent), "minhash-links")
    if not more.isEmpty():
        # links between components found so far, as links between their roots
        for end in ("a", "b"):
            more = (more.join(comp.select(F.col("node").alias(end), F.col("root").alias("_r")), end, "left")
                    .withColumn(end, F.coalesce("_r", end)).drop("_r"))
        top = stored(connected_components(more), "minhash-roots").select(
            F.col("node").alias("root"), F.col("root").alias("_top"))
        comp = (comp.join(top, "root", "left").select("node", F.coalesce("_top", "root").alias("root"))
                .unionByName(top.join(comp.select("root"), "root", "left_anti")
                             .select(F.col("root").alias("node"), F.col("_top").alias("root"))))
    final = (one.join(comp, F.col("rep") == F.col("node"), "left")
             .select("doc_id", F.coalesce("root", "rep").alias("component")))
    found = F.coalesce("component", "doc_id")
    return (prof.select("doc_id", "n_shingles").join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", found.alias("component_id"),
                    F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept")))
