"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the sum of hashed embeddings of the word and of its byte
prefixes (roots with many endings share the prefixes). Filters of widths 1, 2
and 3 run over the word vectors of the whole text, are rectified and
max-pooled, and a logistic unit scores the pooled values. Weights are trained in
numpy on a bounded sample of labelled rows; scoring runs in Spark tasks over
every text. Filters are linear, so a table of each hash slot's part of every
filter replaces the products when scoring.

Thresholds are chosen from the scores of all labelled rows outside the held-out
part. Rows of the training sample take the score of a model that was trained
without them (one of ``FOLDS``), all others that of the model itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import hash_word_prefixes, in_one_task, map_arrow, stored, text_slices, tune

SLOTS = 1 << 15
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8             # per width
PREFIXES = (4, 5, 6)    # bytes; the whole word is always added
#: Bounds of the training sample: rows per class, and bytes of a training text.
TOXIC_ROWS, CLEAN_ROWS, TRAIN_BYTES = 1500, 2500, 20_000
EPOCHS = 4
#: Models that give the sample's own rows the scores of texts not trained on.
FOLDS = 5
#: Labelled rows of each class that a language needs for a threshold of its own.
LEAST_PER_CLASS = 40
#: Bins of the score histograms, per unit of log odds.
BINS = 64
PREDICT_AT = 0.3
SCORE_SLICE = 1 << 20   # bytes scored at a time


@dataclass
class Model:
    table: np.ndarray           # SLOTS x (filters of all widths and offsets)
    bias: np.ndarray            # per filter
    out: np.ndarray
    out_bias: float
    thresholds: dict            # per language
    constant: float | None = None


def slot_ids(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words x slots ids, word offsets per row); words are runs of letters, lower-cased."""
    h, w = hash_word_prefixes(data, off, PREFIXES)
    return (h >> np.uint64(64 - int(np.log2(SLOTS)))).astype(np.int32), w


def _shift(z: np.ndarray, last: np.ndarray, by: int) -> np.ndarray:
    """Row i of the result is row i+by of the same text, zero beyond its end."""
    if not by:
        return z
    out = np.zeros_like(z)
    out[:-by] = z[by:]
    for j in range(by):
        out[np.maximum(last - j, 0)] = 0
    return out


def _pool(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Maximum over the words of each text, 0 for a text without words; rectified."""
    out = np.zeros((len(w) - 1, z.shape[1]), z.dtype)
    full = np.flatnonzero(w[1:] > w[:-1])
    if len(full):
        out[full] = np.maximum.reduceat(z, w[full], axis=0)
    return np.maximum(out, 0)


def _blocks() -> list[tuple[int, int, slice]]:
    """(width, offset, columns of the table) of every filter part."""
    out, at = [], 0
    for width in WIDTHS:
        for j in range(width):
            out.append((width, j, slice(at, at + FILTERS)))
            at += FILTERS
    return out


def pooled(ids: np.ndarray, w: np.ndarray, model: Model) -> np.ndarray:
    z = np.zeros((len(ids), model.table.shape[1]), np.float32)
    for j in range(ids.shape[1]):
        z += model.table[ids[:, j]]
    last = w[1:][w[1:] > w[:-1]] - 1
    parts = []
    for k, width in enumerate(WIDTHS):
        total = sum(_shift(z[:, c], last, j) for wd, j, c in _blocks() if wd == width)
        parts.append(total + model.bias[k * FILTERS:(k + 1) * FILTERS])
    return _pool(np.concatenate(parts, axis=1), w)


def log_odds_of(ids: np.ndarray, w: np.ndarray, model: Model) -> np.ndarray:
    x = pooled(ids, w, model) @ model.out + model.out_bias
    return np.clip(x.astype(np.float64), -50, 50)


def score(ids: np.ndarray, w: np.ndarray, model: Model) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(w) - 1, model.constant)
    return 1 / (1 + np.exp(-log_odds_of(ids, w, model)))


def _log_odds(ids, w, y, rows, strength=5.0):
    """Shrunk log odds of label 1 given that a slot occurs in the text."""
    n = np.zeros((2, SLOTS))
    for i in rows.tolist():
        u = np.unique(ids[w[i]:w[i + 1]])
        n[y[i], u] += 1
    prior = y[rows].mean()
    p = (n[1] + strength * prior) / (n.sum(0) + strength)
    return np.log(p / (1 - p)) - np.log(prior / (1 - prior))


def train(column: pa.Array, labels: np.ndarray, seed: int = 7) -> tuple[Model, np.ndarray]:
    """Model of texts and 0/1 labels, and the log odds of each text by a model trained without it.

    Each class is dealt into ``FOLDS`` parts; a class of one row has no part to hold back.
    """
    y = np.asarray(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros((SLOTS, 1), np.float32), None, None, 0.0, {},
                     constant=float(y.mean()) * 0.99 if len(y) else 0.0), np.zeros(len(y))
    ids, counts = [], []
    for _, data, off in text_slices(column, SCORE_SLICE):
        i, w = slot_ids(data, off)
        ids.append(i)
        counts.append(np.diff(w))
    joined, ids = ids, np.empty((sum(map(len, ids)), 1 + len(PREFIXES)), np.int32)
    at = 0
    while joined:       # freed one by one: the driver has little memory
        part = joined.pop(0)
        ids[at:at + len(part)] = part
        at += len(part)
    w = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    def rows_of(sel):
        n = w[sel + 1] - w[sel]
        wo = np.concatenate(([0], np.cumsum(n)))
        idx = np.arange(wo[-1]) - np.repeat(wo[:-1], n) + np.repeat(w[sel], n)
        return ids[idx], wo

    model = _fit(ids, w, y, np.arange(len(y)), rows_of, seed)
    rng, fold = np.random.default_rng(seed), np.zeros(len(y), np.int64)
    for label in (0, 1):
        of = rng.permutation(np.flatnonzero(y == label))
        fold[of] = np.arange(len(of)) % FOLDS
    odds = np.zeros(len(y))
    for k in range(FOLDS):
        back, fit = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(back):
            both = len(fit) and y[fit].min() < y[fit].max()
            odds[back] = log_odds_of(*rows_of(back), _fit(ids, w, y, fit, rows_of, seed) if both else model)
    return model, odds


def _fit(ids: np.ndarray, w: np.ndarray, y: np.ndarray, fit: np.ndarray, rows_of: Callable, seed: int) -> Model:
    """Weights from the rows ``fit``, which hold both classes."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.05, (SLOTS, DIM)).astype(np.float32)
    emb[:, 0] = _log_odds(ids, w, y, fit) / 4
    conv = [rng.normal(0, 0.2, (width, DIM, FILTERS)).astype(np.float32) for width in WIDTHS]
    for c in conv:
        c[:, 0, :] = rng.uniform(0.2, 1.0, (len(c), FILTERS)) / len(c)
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    out = np.full(len(bias), 0.1, np.float32)
    params = [*conv, bias, out]
    out_bias = float(np.log(y[fit].mean() / (1 - y[fit].mean())))
    seen = [np.full_like(p, 1e-3) for p in params]
    seen_emb, seen_b, rate = np.full(SLOTS, 1e-3, np.float32), 1e-3, 0.05
    for epoch in range(EPOCHS):
        for at in range(0, len(fit), 64):
            sel = rng.choice(fit, min(64, len(fit)), replace=False)
            bi, bw = rows_of(sel)
            if not len(bi):
                continue
            v = emb[bi].sum(1)
            last = bw[1:][bw[1:] > bw[:-1]] - 1
            full = np.flatnonzero(bw[1:] > bw[:-1])
            pool, best = np.zeros((len(sel), len(bias)), np.float32), []
            for k, c in enumerate(conv):
                z = sum(_shift(v @ c[j], last, j) for j in range(len(c))) + bias[k * FILTERS:(k + 1) * FILTERS]
                where = np.stack([z[bw[i]:bw[i + 1]].argmax(0) + bw[i] for i in full])
                best.append(where)
                pool[full, k * FILTERS:(k + 1) * FILTERS] = z[where, np.arange(FILTERS)]
            act = np.maximum(pool, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ out + out_bias, -30, 30)))
            err = ((p - y[sel]) / len(sel)).astype(np.float32)
            g_pool = (err[:, None] * out) * (pool > 0)
            grads = [np.zeros_like(q) for q in params]
            grads[-1] = act.T @ err + 1e-4 * out
            grads[-2] = g_pool.sum(0)
            touched, moves = [], []
            end = np.repeat(bw[1:][full], FILTERS).reshape(-1, FILTERS)
            for k, c in enumerate(conv):
                g = g_pool[full, k * FILTERS:(k + 1) * FILTERS]
                for j in range(len(c)):
                    pos = best[k] + j
                    gj = np.where(pos < end, g, 0)
                    pos = np.minimum(pos, len(v) - 1)
                    grads[k][j] = np.einsum("if,ifd->df", gj, v[pos])
                    row, col = np.nonzero(gj)
                    touched.append(bi[pos[row, col]].ravel())
                    moves.append(np.repeat(gj[row, col][:, None] * c[j].T[col], bi.shape[1], axis=0))
            for q, g, s in zip(params, grads, seen):
                s += g * g
                q -= rate * g / np.sqrt(s)
            g_b = float(err.sum())
            seen_b += g_b * g_b
            out_bias -= rate * g_b / np.sqrt(seen_b)
            slots, inv = np.unique(np.concatenate(touched), return_inverse=True)
            if len(slots):
                g = np.zeros((len(slots), DIM), np.float32)
                np.add.at(g, inv, np.concatenate(moves))
                seen_emb[slots] += (g * g).mean(1)
                emb[slots] -= rate * g / np.sqrt(seen_emb[slots])[:, None]
    table = np.concatenate([emb @ conv[k][j] for k, width in enumerate(WIDTHS) for j in range(width)], axis=1)
    return Model(np.ascontiguousarray(table), bias, out, out_bias, {})


def _best_cut(bins: list) -> float:
    """Cut (log odds) of highest F1 over (toxic, clean, lowest, highest) of each bin of scores.

    It lies in the middle between the lowest score flagged and the highest left alone.
    """
    bins = sorted(bins, key=lambda b: -b[2])
    t, f = np.cumsum([b[0] for b in bins]), np.cumsum([b[1] for b in bins])
    at = int((2 * t / (t + f + t[-1])).argmax())
    return (bins[at][2] + (bins[at + 1][3] if at + 1 < len(bins) else bins[at][2] - 1)) / 2


def held_out(doc_id):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labels(labels: DataFrame) -> DataFrame:
    """_id and _y of the labelled documents outside the held-out part."""
    return (labels.where("toxic is not null and doc_id is not null")
            .select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_y"))
            .where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
            .withColumn("_y", F.when(F.col("_y") > 0, 1).otherwise(0)))


def fit_weights(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS,
                clean_rows: int = CLEAN_ROWS, train_bytes: int = TRAIN_BYTES) -> tuple[Model, pa.Table]:
    """Train on at most ``toxic_rows`` + ``clean_rows`` labelled rows outside the held-out part.

    The rows are those of smallest id hash per class, so any partitioning of the
    input gives the same sample; texts over ``train_bytes`` bytes are left out of
    training only. A document labelled more than once is toxic if any label says so.
    Returned with the model: _id and _own of the sample, the log odds by a model
    trained without the row.
    """
    lab = _labels(labels)

    def some(y: int, n: int) -> DataFrame:
        return lab.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    sample = some(1, toxic_rows).unionByName(some(0, clean_rows))       # bounded: broadcast
    rows = (docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
            .where("text is not null").where(F.octet_length("text") <= train_bytes)
            .join(F.broadcast(sample), "_id")
            .dropDuplicates(["_id"]).select("_id", "_y", "text"))

    def fit(table: pa.Table) -> tuple[Model, pa.Table]:
        table = table.sort_by("_id")
        model, odds = train(table.column("text").combine_chunks(), table.column("_y").to_numpy())
        return model, pa.table({"_id": table.column("_id"), "_own": pa.array(odds, pa.float64())})
    made = in_one_task(rows, fit)
    return made if made is not None else (train(pa.array([], pa.string()), np.zeros(0))[0], None)


def log_odds(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang and log odds of every row, before calibration; null texts score like empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [log_odds_of(*slot_ids(data, off), shared.value)
             for _, data, off in text_slices(batch.column("text"), SCORE_SLICE)]
        return pa.record_batch([batch.column("doc_id"), batch.column("lang"), pa.array(np.concatenate(x))],
                               ["doc_id", "lang", "odds"])
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.col("lang").cast("string").alias("lang"),
                                 F.col("text").cast("string").alias("text")),
                     run, "doc_id long, lang string, odds double")


def calibrate(scored: DataFrame, labels: DataFrame, model: Model, own: pa.Table) -> Model:
    """The model with its common cut at ``PREDICT_AT`` and the cuts of the languages.

    Counts are of every labelled row of ``scored`` (doc_id, lang, odds) outside the
    held-out part, in histograms per language; the driver receives bins only, of
    languages with enough rows of both classes.
    """
    spark = scored.sparkSession
    known = (scored.withColumnRenamed("doc_id", "_id").join(_labels(labels), "_id")
             .join(F.broadcast(spark.createDataFrame(own)), "_id", "left")
             .withColumn("odds", F.coalesce("_own", "odds")))
    bins = stored(known.groupBy("lang", F.floor(F.col("odds") * BINS).alias("bin"))
                  .agg(F.sum("_y").alias("toxic"), F.sum(1 - F.col("_y")).alias("clean"),
                       F.min("odds").alias("low"), F.max("odds").alias("high")), "toxicity-bins")
    total = [F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.min("low").alias("low"),
             F.max("high").alias("high")]
    every = [tuple(r) for r in bins.groupBy("bin").agg(*total).select("toxic", "clean", "low", "high").collect()]
    if not sum(b[0] for b in every):
        return model
    shift = float(np.log(PREDICT_AT / (1 - PREDICT_AT))) - _best_cut(every)
    enough = (bins.where("lang is not null").groupBy("lang").agg(*total[:2])
              .where((F.col("toxic") >= LEAST_PER_CLASS) & (F.col("clean") >= LEAST_PER_CLASS)).select("lang"))
    parts = {}
    for r in bins.join(enough, "lang").select("lang", "toxic", "clean", "low", "high").collect():
        parts.setdefault(r[0], []).append(tuple(r)[1:])
    return replace(model, out_bias=model.out_bias + shift, thresholds={
        lang: float(1 / (1 + np.exp(-(_best_cut(b) + shift)))) for lang, b in sorted(parts.items())})


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Model:
    """Weights from the bounded sample, thresholds from all labelled rows outside the held-out part."""
    model, own = fit_weights(docs, labels)
    return model if model.constant is not None else calibrate(log_odds(docs, model), labels, model, own)


def threshold_of(model: Model, lang):
    """The language's calibrated threshold (few languages: a fixed, small literal map)."""
    out = F.lit(PREDICT_AT)
    for name, cut in sorted(model.thresholds.items()):
        out = F.when(lang == name, F.lit(cut)).otherwise(out)
    return out


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, threshold, flagged.

    predicted is 1 at a score of 0.3 or more; flagged uses the threshold calibrated
    for the row's language (0.3 where a language has too few labelled rows). Labels,
    language, source and id are no inputs of the score. Null and empty texts get the
    score of a text without words; repeated rows score alike; without labels of both
    classes every score is the share of label 1; an empty table gives no rows.
    """
    tune(docs.sparkSession)
    model, own = fit_weights(docs, labels)
    if model.constant is not None:
        scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                             F.lit(model.constant).alias("score"))
    else:       # every text is scored once; thresholds and result come from the stored numbers
        raw = stored(log_odds(docs, model), "toxicity-odds")
        bias, model = model.out_bias, calibrate(raw, labels, model, own)
        scored = raw.select("doc_id", "lang", (1 / (1 + F.exp(
            -(F.col("odds") + F.lit(float(model.out_bias - bias)))))).alias("score"))
    return (scored
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).alias("predicted"),
                    threshold_of(model, F.col("lang")).alias("threshold"))
            .withColumn("flagged", F.col("score") >= F.col("threshold")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below the threshold of their language; same columns.

    The text passes through the scoring task, so nothing is shuffled. Each row is judged by its
    own text, so repeated rows go or stay together and ids (null ones too) play no part; null and
    empty texts are scored as texts without words; a null language has the common cut. Without
    labels every row stays; an empty table stays empty.
    """
    tune(docs.sparkSession)
    model = fit_toxicity(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        s = np.concatenate([score(*slot_ids(data, off), m)
                            for _, data, off in text_slices(batch.column("text"), SCORE_SLICE)])
        cut = np.array([m.thresholds.get(x, PREDICT_AT) for x in batch.column("lang").to_pylist()])
        return batch.filter(pa.array(s < cut))
    return map_arrow(docs, keep, docs.schema)
