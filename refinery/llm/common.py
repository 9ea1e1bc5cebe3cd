"""Helpers shared by the operators: tables, scratch tables, words and shingles."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.session import work_dir

#: Rows of one Arrow batch: whole documents travel in them, some very long.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a batch of long documents fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, key: str) -> DataFrame:
    """Deal a grouped table out anew before it is joined on its own key.

    Joined straight after its aggregate, both sides of the join would sit in one stage,
    and the runtime could not split the rows of a hot key; with an exchange of its own on
    either side it can.
    """
    return df.repartition(F.xxhash64(key, F.lit("apart")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    A lambda variable holds the evaluated value, so the optimizer cannot copy
    the expression into every place (and every element) that refers to it.
    """
    return F.transform(F.array(value), body)[0]


# ---- words and shingles in numpy ------------------------------------------
# Words are hashed over the bytes of a whole batch: with random 64-bit values
# R[byte] and C = cumsum(R[byte] * P^i), a word at [s, e) has the hash
# (C[e] - C[s]) * P^-s, wherever it stands.

_rng = np.random.default_rng(20240229)
_R = _rng.integers(0, 1 << 64, 256, np.uint64)
_P, _K, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_S = np.uint64(29)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed at a time; a longer single text is one slice. Some arrays of 8 bytes a byte
#: are made of a slice, in every Python worker of an executor.
SLICE = 256 << 10
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        size = max(n, SLICE)
        for name, base in (("p", _P), ("q", _P_INV)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _powers[name] = np.multiply.accumulate(t)
    return _powers["p"], _powers["q"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _K
    x = (x ^ (x >> _S)) * _M
    return x ^ (x >> _S)


def text_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, row offsets into them) of runs of rows; null is empty."""
    arr = column.cast(pa.binary()).fill_null(b"")
    off = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def _spans(data: np.ndarray, off: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words of all rows."""
    sp = space[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:] = sp
    edge[off] = True
    starts = np.flatnonzero(~sp & edge[:-1])
    edge[:-1] = sp
    edge[off] = True
    return starts, np.flatnonzero(~sp & edge[1:]) + 1


def hash_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word with A-Z lower-cased, word offsets per row)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    starts, ends = _spans(data, off, _SPACE)
    p, q = _power_tables(len(data))
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_R[_LOWER[data]] * p[:len(data)], out=c[1:])
    h = _mix((c[ends] - c[starts]) * q[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, off)


_NO_LETTER = np.zeros(256, bool)
_NO_LETTER[:128] = True
_NO_LETTER[65:91] = _NO_LETTER[97:123] = False


def hash_word_prefixes(data: np.ndarray, off: np.ndarray, prefixes: tuple[int, ...]
                       ) -> tuple[np.ndarray, np.ndarray]:
    """(words x (1 + prefixes) hashes, word offsets per row) of runs of letters.

    Bytes from 0x80 count as letters; A-Z and the accented capitals of Latin-1
    are lower-cased. Column 0 is the whole word, the others its byte prefixes.
    """
    if not len(data):
        return np.zeros((0, 1 + len(prefixes)), np.uint64), np.zeros(len(off), np.int64)
    low = _LOWER[data]
    capital = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3))
    low[capital + 1] += 0x20
    starts, ends = _spans(data, off, _NO_LETTER)
    p, q = _power_tables(len(data))
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_R[low] * p[:len(data)], out=c[1:])
    base, scale = c[starts], q[starts]
    out = np.empty((len(starts), 1 + len(prefixes)), np.uint64)
    out[:, 0] = _mix((c[ends] - base) * scale)
    for j, n in enumerate(prefixes, 1):
        out[:, j] = _mix((c[np.minimum(starts + n, ends)] - base) * scale + np.uint64(n))
    return out, np.searchsorted(starts, off)


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash per window of ``k`` words, in text order (fewer words: one hash)."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    acc = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        acc = (acc ^ h[j:j + n]) * _K
        acc ^= acc >> _S
    return acc * _M


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a string column."""
    out = []
    for _, data, off in text_slices(column):
        h, w = hash_words(data, off)
        full = ngram_hashes(h, k) if len(h) >= k else h
        for a, b in zip(w[:-1].tolist(), w[1:].tolist()):
            s = np.sort(full[a:b - k + 1]) if b - a >= k else ngram_hashes(h[a:b], k)
            if len(s) > 1:
                new = s[1:] != s[:-1]
                if not new.all():
                    s = s[np.concatenate(([True], new))]
            out.append(s)
    return out


def binary_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def in_one_task(sample: DataFrame, fit: Callable[[pa.Table], object]):
    """``fit`` of a bounded sample, run in a task: the driver only receives the result.

    The sample's bound is the caller's; a lost executor repeats the task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        made = fit(pa.Table.from_batches(rows)) if rows else None
        yield pa.record_batch([pa.array([pickle.dumps(made)], pa.binary())], ["made"])
    found = sample.repartition(1).mapInArrow(run, "made binary").collect()
    return pickle.loads(found[0][0]) if found else None


def summed_arrays(parts: RDD, combine: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Combine one array of fixed size per partition in two levels; one array reaches the driver."""
    groups = max(1, math.isqrt(parts.getNumPartitions()))
    found = (parts.mapPartitionsWithIndex(lambda i, xs: ((i % groups, x) for x in xs))
             .reduceByKey(combine, groups).map(lambda kv: (0, kv[1])).reduceByKey(combine, 1).values().collect())
    return found[0] if found else None


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str) -> DataFrame:
    """``mapInArrow`` of a per-batch function; empty results are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)
