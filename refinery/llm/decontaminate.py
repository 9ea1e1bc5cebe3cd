"""Benchmark decontamination by SimHash windows of the items' own sizes.

Every document is cut into windows of as many words as a benchmark item has.
A window's fingerprint is a 64-bit SimHash of its distinct 5-word shingles, all of
one weight, so it depends on the window alone. Fingerprints are looked up in a
multi-index: eight blocks of eight bits, each with a table of the items within two
bits of any block value. A fingerprint within ``RADIUS`` = 8 * 3 - 1 bits of an
item's agrees with it up to two bits in some block, so the lookup finds all of them;
the full distance is checked next. Candidates are verified exactly: the weight of the
item's shingles that stand in the best window of the text over the weight of all its
shingles must reach 0.8. A shingle weighs log(1 + items / items that hold it), counted
over the whole benchmark.

A window whose shingles of the benchmark weigh less than 0.8 of the lightest item of
its size matches nothing and is not fingerprinted; this drops no match.

The radius follows from the bound: a window that holds 0.8 of an item of equally heavy,
distinct shingles has a cosine of at least 0.8 with it, about 13 of 64 bits, three
standard deviations below the radius. Where an item's shingles weigh very differently or
repeat often, a matching window's cosine can be lower. Items whose least cosine is below
``LEAST_COSINE`` are ``loose``: fingerprints alone would lose copies, so the shared weight in
the whole text makes them candidates too.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import hash_words, map_arrow, ngram_hashes, stored, text_slices, tune

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Cosine at which 99 of 100 fingerprints lie within the radius (14.7 bits expected, deviation 3.4).
LEAST_COSINE = 0.75
#: Benchmark text that travels to the tasks at a time; a larger benchmark goes in several blocks.
BENCHMARK_BYTES = 4 << 20
#: Windows fingerprinted at a time, and window x item pairs looked up at a time.
WINDOWS, PAIRS = 4096, 2_000_000
_LUT_BITS = 20
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def simhash(v: np.ndarray) -> np.ndarray:
    """Fingerprints from rows of 64 signed sums."""
    return np.where(v > 0, _POWERS, np.uint64(0)).sum(axis=-1, dtype=np.uint64)


def signs(h: np.ndarray) -> np.ndarray:
    """+1/-1 per bit of each hash."""
    return np.where((h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), 1, -1).astype(np.int32)


def blocks_of(f: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(f).view(np.uint8).reshape(-1, BLOCKS)


@dataclass
class _Size:
    """Items of one word count and their multi-index."""
    items: np.ndarray       # positions in Index.items
    prints: np.ndarray
    near: np.ndarray        # BLOCKS x 256 x items: within BLOCK_RADIUS bits
    lightest: float         # least weight of an item


def item_grams(texts: pa.Array, k: int = SHINGLE) -> list[tuple[int, int, np.ndarray]]:
    """(row, words, distinct shingles) of the texts that have words."""
    out = []
    for row, data, off in text_slices(texts):
        h, w = hash_words(data, off)
        for i in range(len(off) - 1):
            words = h[w[i]:w[i + 1]]
            if len(words):
                out.append((row + i, len(words), np.unique(ngram_hashes(words, k))))
    return out


class Index:
    """Shingles, weights, fingerprints and multi-index of a block of benchmark items.

    ``counts``: items of the whole benchmark, its shingles (at least the block's, sorted) and how
    many items hold each; None where the block is all of it.
    """

    def __init__(self, ids: list, texts: pa.Array, k: int = SHINGLE, counts: tuple | None = None):
        self.k = k
        items = item_grams(texts, k)
        self.items = [(ids[row], size) for row, size, _ in items]
        if counts is None:
            every = np.concatenate([g for *_, g in items]) if items else np.zeros(0, np.uint64)
            counts = (len(items), *np.unique(every, return_counts=True))
        total, self.hashes, holders = counts
        # shingles that many items share say less about any of them
        self.weights = np.log1p(total / np.maximum(holders, 1)).astype(np.float32)
        self.lut = np.zeros(1 << _LUT_BITS, bool)
        self.lut[(self.hashes >> np.uint64(64 - _LUT_BITS)).astype(np.int64)] = True
        self.grams = [np.searchsorted(self.hashes, g) for *_, g in items]
        self.total = [float(self.weights[g].sum()) for g in self.grams]
        self.prints = [int(simhash(signs(g).sum(0))) for *_, g in items]
        by_size, of = defaultdict(list), defaultdict(set)
        for n, (_, size) in enumerate(self.items):
            by_size[size].append(n)
            for x in self.grams[n].tolist():
                of[x].add(size)
        self.sizes_of = {x: sorted(s) for x, s in of.items()}       # shingle place -> sizes of its items
        dist = _ONES[np.arange(256)[:, None] ^ np.arange(256)]
        self.sizes = {}
        for size, members in by_size.items():
            f = np.array([self.prints[n] for n in members], np.uint64)
            b = blocks_of(f)
            self.sizes[size] = _Size(np.array(members), f, np.stack(
                [dist[:, b[:, j]] <= BLOCK_RADIUS for j in range(BLOCKS)]), min(self.total[n] for n in members))
        self.widths = sorted({min(k, size) for size in by_size})
        self._loose: dict[float, dict] = {}

    def places(self, g: np.ndarray) -> np.ndarray:
        """Place of each hash among the items' shingles, -1 if in none."""
        out = np.full(len(g), -1, np.int64)
        maybe = np.flatnonzero(self.lut[(g >> np.uint64(64 - _LUT_BITS)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, g[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == g[maybe]
            out[maybe[same]] = at[same]
        return out

    def cosine(self, n: int, least: float) -> float:
        """Least cosine of item ``n`` and a window of its size that holds ``least`` of its weight."""
        light = np.cumsum(np.sort(self.weights[self.grams[n]].astype(np.float64)))
        gone = int(np.searchsorted(light, (1 - least) * light[-1] + 1e-6, "right"))
        size = self.items[n][1]
        return (len(light) - gone) / (len(light) * (size - min(self.k, size) + 1)) ** 0.5

    def loose(self, least: float) -> dict[int, list]:
        """Shingle place -> items whose copies may lie beyond the radius."""
        if least not in self._loose:
            found = defaultdict(list)
            for n, g in enumerate(self.grams):
                if self.cosine(n, least) < LEAST_COSINE:
                    for x in g.tolist():
                        found[x].append(n)
            self._loose[least] = dict(found)
        return self._loose[least]


def _held(place: np.ndarray, at: np.ndarray, index: Index, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight of the distinct shingles at ``at`` that each window of ``m`` shingles holds.

    (starts, weights): a weight holds from its start to the next. A shingle at p counts for
    the starts from p - m + 1 (or, where it occurred before, from behind that occurrence) to
    p; the sum changes only at these ends, so the work follows the shared shingles and not
    the windows.
    """
    at = at[np.lexsort((at, place[at]))]
    kind = place[at]
    before = np.where(np.concatenate(([False], kind[1:] == kind[:-1])), np.concatenate(([0], at[:-1])), -1)
    begin = np.maximum(np.maximum(at - m + 1, before + 1), 0)
    weight = index.weights[kind].astype(np.float64)
    ends, end = np.unique(np.concatenate((begin, at + 1)), return_inverse=True)
    held = np.round(np.cumsum(np.bincount(end, np.concatenate((weight, -weight)))), 9)
    windows = ends <= len(place) - m
    return ends[windows], held[windows]


def _best_window(place: np.ndarray, hits: np.ndarray, index: Index, n: int, m: int) -> tuple[int, float]:
    """First start and similarity of the window of ``m`` shingles that holds most of item ``n``."""
    at = hits[np.isin(place[hits], index.grams[n])]
    if not len(at):
        return 0, 0.0
    starts, held = _held(place, at, index, m)
    best = int(held.argmax())
    return int(starts[best]), min(1.0, float(held[best] / index.total[n]))


def window_prints(g: np.ndarray, first: int, end: int, m: int) -> np.ndarray:
    """Fingerprints of the windows of ``m`` shingles that start at ``first`` to ``end`` - 1.

    Running sums of the signs; of equal shingles in a window the first counts.
    """
    part = g[first:end + m - 1]
    at = np.arange(len(part))
    order = np.argsort(part, kind="stable")
    again = part[order[1:]] == part[order[:-1]]
    before = np.full(len(part), -1)
    before[order[1:][again]] = order[:-1][again]
    begin = np.maximum(np.maximum(at - m + 1, before + 1), 0)
    changes, v = np.concatenate((begin, at + 1)), signs(part)
    order = np.argsort(changes, kind="stable")
    sums = np.cumsum(np.concatenate((v, -v))[order], axis=0, dtype=np.int32)
    return simhash(sums[np.searchsorted(changes[order], np.arange(end - first), "right") - 1])


def _proposed(g: np.ndarray, place: np.ndarray, hits: np.ndarray, index: Index, size: int, m: int,
              least: float = SIMILARITY) -> set:
    """Items of ``size`` words within the radius of a window's fingerprint."""
    s, out = index.sizes[size], set()
    starts, held = _held(place, hits, index, m)
    heavy = held >= least * s.lightest - 1e-4
    upto = np.concatenate((starts[1:], [len(g) - m + 1]))
    # runs of starts that lie close share their running sums
    runs: list[list[int]] = []
    for a, b in zip(starts[heavy].tolist(), upto[heavy].tolist()):
        if runs and a - runs[-1][1] <= m // 2:
            runs[-1][1] = b
        else:
            runs.append([a, b])
    step = max(1, PAIRS // len(s.items))
    for a, b in runs:
        for first in range(a, b, WINDOWS):
            every = np.unique(window_prints(g, first, min(b, first + WINDOWS), m))
            for i in range(0, len(every), step):
                prints = every[i:i + step]
                blocks = blocks_of(prints)
                cand = np.zeros((len(prints), len(s.items)), bool)
                for j in range(BLOCKS):
                    cand |= s.near[j][blocks[:, j]]
                row, col = np.nonzero(cand)
                near = _ONES[blocks_of(prints[row] ^ s.prints[col])].sum(1) <= RADIUS
                out.update(s.items[np.unique(col[near])].tolist())
    return out


def _scan(g: np.ndarray, place: np.ndarray, index: Index, width: int, least: float) -> list:
    """Hits (item, first word, words, distance, similarity) of one text; best window per item."""
    hits = np.flatnonzero(place >= 0)
    kinds = np.unique(place[hits]).tolist()
    # loose items: weight of the distinct shingles that each shares with the whole text
    loose, shared = index.loose(least), defaultdict(float)
    for x in kinds:
        for n in loose.get(x, ()):
            shared[n] += float(index.weights[x])
    extra = defaultdict(set)
    for n, weight in shared.items():
        if weight >= least * index.total[n] - 1e-4:
            extra[index.items[n][1]].add(n)
    found = []
    for size in sorted({s for x in kinds for s in index.sizes_of[x]}):
        m = min(size - width + 1, len(g))
        for n in sorted(_proposed(g, place, hits, index, size, m, least) | extra[size]):
            first, similarity = _best_window(place, hits, index, n, m)
            if similarity >= least - 1e-6:
                f = window_prints(g, first, first + 1, m) ^ np.uint64(index.prints[n])
                found.append((n, first, size, int(_ONES[blocks_of(f)].sum()), similarity))
    return found


def scan_texts(column: pa.Array, index: Index, least: float = SIMILARITY) -> list[tuple[int, list]]:
    """(row, hits) of the texts that have any."""
    out = defaultdict(list)
    for first, data, off in text_slices(column):
        h, w = hash_words(data, off)
        for width in index.widths:
            if len(h) < width:
                continue
            g = ngram_hashes(h, width)
            place = index.places(g)
            at = np.flatnonzero(place >= 0)
            for i in np.unique(np.searchsorted(w, at, "right") - 1).tolist():
                a, b = w[i], w[i + 1] - width + 1       # windows within the text only
                if b > a and (place[a:b] >= 0).any():
                    out[first + i] += _scan(g[a:b], place[a:b], index, width, least)
    return sorted((i, x) for i, x in out.items() if x)


_opened: dict[str, Index] = {}


def opened(block: dict) -> Index:
    """The index of a block, built once in each worker process, which holds one at a time."""
    if block["key"] not in _opened:
        _opened.clear()
        _opened[block["key"]] = Index(block["ids"], block["texts"], counts=block["counts"])
    return _opened[block["key"]]


class Blocks:
    """The benchmark in blocks of bounded text, each with counts over the whole benchmark.

    The driver sees one block at a time: its texts and the counts of its shingles.
    """

    def __init__(self, benchmark: DataFrame, block_bytes: int = BENCHMARK_BYTES):
        b = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("text is not null")
        worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
        size, self.items = b.agg(F.sum(F.octet_length("text")), F.count_if(worded)).first()
        self.n = max(1, -(-(size or 0) // block_bytes))
        self.rows = b.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n)).cast("int"))

        def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
            block = batch.column("block").to_numpy()
            made = item_grams(batch.column("text"))
            g = np.concatenate([x for *_, x in made]) if made else np.zeros(0, np.uint64)
            at = np.repeat([row for row, *_ in made], [len(x) for *_, x in made]).astype(np.int64)
            return pa.record_batch([pa.array(g.view(np.int64)), pa.array(block[at], pa.int32())], ["gram", "block"])
        self.counts = stored(map_arrow(self.rows.select("text", "block"), grams, "gram long, block int")
                             .groupBy("gram").agg(F.count(F.lit(1)).alias("holders"),
                                                  F.collect_set("block").alias("blocks")), "benchmark-shingles")

    def broadcast(self, i: int):
        rows = self.rows.where(F.col("block") == i).select("item_id", "text").toArrow()
        of = self.counts.where(F.array_contains("blocks", i)).select("gram", "holders").toArrow()
        hashes = of.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        return self.rows.sparkSession.sparkContext.broadcast({
            "key": uuid.uuid4().hex, "ids": rows.column("item_id").to_pylist(),
            "texts": rows.column("text").combine_chunks(),
            "counts": (self.items, hashes[order], of.column("holders").to_numpy()[order])})

    def one_by_one(self, step: Callable, name: str) -> list[DataFrame]:
        """``step(block broadcast, results so far)`` per block; all but a single result are written
        before the next block is sent, and the block is given up."""
        out: list[DataFrame] = []
        for i in range(self.n):
            shared = self.broadcast(i)
            made = step(shared, out)
            if self.n > 1:
                made = stored(made, name)
                shared.unpersist()
            out.append(made)
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY,
                 block_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """One row per document row and benchmark item that it holds.

    doc_id, item_id, first_word and n_words of the best window (the first of equal ones),
    bits of its fingerprint that differ, similarity (0.8 to 1). Null and blank texts hold
    nothing; items without words match nothing; an item of fewer than five words is
    one shingle of all its words; repeated rows are reported once each; an empty
    table on either side gives no rows; other columns are not looked at. The result does
    not depend on ``block_bytes``.
    """
    tune(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = ["doc_id", "item_id", "first_word", "n_words", "bits", "similarity"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def scan(shared, _):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            index, ids = opened(shared.value), batch.column("doc_id").to_pylist()
            rows = [(ids[i], index.items[n][0], *rest)
                    for i, hits in scan_texts(batch.column("text"), index, least) for n, *rest in hits]
            return pa.record_batch([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names)
        return map_arrow(texts, run, "doc_id long, item_id long, first_word long, n_words long, "
                                     "bits long, similarity double")
    return reduce(DataFrame.unionAll, Blocks(benchmark, block_bytes).one_by_one(scan, "contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY,
                      block_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """The documents that hold no benchmark item; same columns, nothing is shuffled.

    Each row is judged by its own text, so repeated rows and rows of one id (or a null id) go
    or stay by what they hold. Null and blank texts stay; an empty benchmark keeps every row.
    """
    tune(docs.sparkSession)

    def clean(shared, before):
        def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
            stay = np.ones(batch.num_rows, bool)
            stay[[i for i, _ in scan_texts(batch.column("text"), opened(shared.value), least)]] = False
            return batch.filter(pa.array(stay))
        return map_arrow(before[-1] if before else docs, keep, docs.schema)
    return Blocks(benchmark, block_bytes).one_by_one(clean, "decontaminated")[-1]
