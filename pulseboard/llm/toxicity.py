"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased and padded; the character n-grams of ``SIZES`` are hashed into a table of fixed size, and a text's
features are which entries it holds.  The log-count ratios are counted over all labelled rows; the weights on the scaled
features are then fitted by logistic regression on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import stored, values

BITS = 18
SIZES = (4, 5, 6)
#: Labelled rows, per label, that fit the weights (the ratios are counted on all rows), and their characters per task.
FIT_ROWS = 2500
STEPS = 200
L2 = 1e-3
#: Entries that get a weight: those whose share of rows differs most between the labels, in standard errors.
ENTRIES = 8192
#: Smoothing of the counts.
ALPHA = 1.0
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> np.ndarray:
    """Entries of the table that a text holds, ascending; none for an empty or null text."""
    if not text:
        return np.zeros(0, np.int64)
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    seen = np.zeros(1 << BITS, bool)
    gram = code.copy()
    for n in range(2, max(SIZES) + 1):
        gram = gram[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
        if n in SIZES and len(gram):
            mixed = (gram + np.uint64(n)) * _MULTIPLIER
            seen[((mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIER) >> np.uint64(64 - BITS)] = True
        if not len(gram):
            break
    return np.flatnonzero(seen)


def ratios_of(one: np.ndarray, zero: np.ndarray, n_one: int, n_zero: int) -> np.ndarray:
    """Smoothed log ratio of the entry's shares of rows, 0 for all but the ENTRIES that differ most."""
    p, q = (one + ALPHA) / (n_one + 2 * ALPHA), (zero + ALPHA) / (n_zero + 2 * ALPHA)
    both = (one + zero + 2 * ALPHA) / (n_one + n_zero + 4 * ALPHA)
    z = np.abs(p - q) / np.sqrt(both * (1 - both) + 1e-12)
    ratios = np.log(p / q)
    ratios[np.argsort(-z, kind="stable")[ENTRIES:]] = 0.0
    return ratios


def log_count_ratios(labelled: DataFrame) -> tuple[np.ndarray, int, int]:
    """(ratio per entry, rows with label 1, rows with label 0) over all rows of ``labelled`` (text, label).

    Each task sends two tables of fixed size; they are added by entry range in Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, label in values(batch, "text", "label"):
                counts[label, features(text)] += 1
                rows[label] += 1
        if rows.any():
            at = np.flatnonzero(counts.any(axis=0))
            yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(counts[1, at], rows[1])), pa.array(np.append(counts[0, at], rows[0]))], names=["entry", "one", "zero"])

    summed = labelled.mapInArrow(partial, "entry long, one long, zero long").groupBy("entry").agg(F.sum("one").alias("one"), F.sum("zero").alias("zero"))
    one, zero, n = np.zeros(1 << BITS), np.zeros(1 << BITS), [0, 0]
    table = summed.toArrow()  # at most 2 ** BITS + 1 rows
    entry, a, b = (table.column(c).to_numpy() for c in ("entry", "one", "zero"))
    one[entry[entry >= 0]], zero[entry[entry >= 0]] = a[entry >= 0], b[entry >= 0]
    if len(total := np.flatnonzero(entry < 0)):
        n = [int(a[total[0]]), int(b[total[0]])]
    return ratios_of(one, zero, n[0], n[1]), n[0], n[1]


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights (already times the ratios) and bias of an L2-penalised logistic regression by accelerated gradient descent.

    Rows count such that label 1 has the share ``prior``."""
    entries = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    used, column = np.unique(entries, return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = ratios[used]
    value = scale[column]
    share = labels.mean()
    cost = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    cost /= cost.sum()
    norm = np.sqrt(np.bincount(row, value * value, len(rows)).max() + 1.0)
    w, b = np.zeros(len(used)), np.log(prior / (1 - prior))
    wv, bv, t = w.copy(), b, 1.0
    step = 4.0 / (norm * norm * (cost.max() * len(rows))) * min(50.0, np.sqrt(len(rows)))
    for _ in range(STEPS):
        z = np.bincount(row, value * wv[column], len(rows)) + bv
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * cost
        gw = np.bincount(column, value * g[row], len(used)) + L2 * wv / 10
        w2, b2 = wv - step * gw, bv - step * g.sum() * 4
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wv, bv = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    out = np.zeros(len(ratios))
    out[used] = w * scale
    return out, float(b)


#: Labels up to which they are sent to every task to meet their texts (16 bytes each); beyond, texts are shuffled.
BROADCAST_LABELS = 1_000_000


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """A model from all labelled documents: entries, weights, bias, rows.

    Null labels and ids, and labels without a document, teach nothing; of repeated labels of an id the largest holds; a null text
    is empty.  Without a row of each label the model scores every text with the smoothed share of label 1 (0 without any row).
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("__op_id"), (F.col(f"`{label}`") == 1).cast("int").alias("label")).dropna()
    known = stored(known.groupBy("__op_id").agg(F.max("label").alias("label")), "labels")
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    source = docs.select(F.col(f"`{doc_id}`").alias("__op_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    labelled = source.join(known, "__op_id").select("text", "label", "__op_id").withColumn("__op_th", F.xxhash64("text"))
    ratios, n_one, n_zero = log_count_ratios(labelled.select("text", "label"))
    if not n_one or not n_zero:
        share = (n_one + ALPHA) / (n_one + n_zero + 2 * ALPHA) if n_one + n_zero else 0.0
        return {"entries": np.zeros(0, np.int64), "weights": np.zeros(0), "bias": float(np.log(share / (1 - share))) if share else -np.inf, "rows": n_one + n_zero}
    part = F.when(F.col("label") == 1, FIT_ROWS / n_one).otherwise(FIT_ROWS / n_zero)
    # drawn by id and text, so the rows of one id are drawn apart; equal rows of an id are one row of the sample
    sample = labelled.where(F.pmod(F.xxhash64("__op_id", "__op_th", F.lit("fit")), F.lit(1 << 30)) < part * (1 << 30))
    sample = sample.dropDuplicates(["__op_id", "__op_th"]).select("text", "label")
    wanted = np.flatnonzero(ratios)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = [np.intersect1d(features(t), wanted, True) for t in values(batch, "text")]
            yield pa.record_batch([batch.column("label"), pa.array(entries, pa.list_(pa.int64()))], names=["label", "entries"])

    fit = sample.mapInArrow(held, "label int, entries array<long>").toArrow()  # about 2 FIT_ROWS rows of at most ENTRIES numbers
    order = sorted(zip(fit.column("label").to_pylist(), map(tuple, fit.column("entries").to_pylist()), strict=True))  # the same sums in any order of tasks
    y = np.array([label for label, _ in order], float)
    weights, bias = fit_weights([np.array(e, np.int64) for _, e in order], y, ratios, n_one / (n_one + n_zero)) if 0 < y.sum() < len(y) else (np.zeros(len(ratios)), -np.inf)
    used = np.flatnonzero(weights)
    return {"entries": used, "weights": weights[used], "bias": bias, "rows": n_one + n_zero}


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), score (0 to 1), predicted (score >= 0.5): one row per input row, in one pass.

    Whole texts are scored, in memory of a few numbers per character of one text; a null text scores as an empty one; repeated rows score alike."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"))
    entries, weights, bias = model["entries"], model["weights"], model["bias"]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS)
        table[entries] = weights
        for batch in batches:
            z = np.array([table[features(t)].sum() + bias for t in values(batch, "text")], float)
            s = np.where(np.isneginf(z), 0.0, 1 / (1 + np.exp(-np.clip(z, -500, 500))))
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                  names=["doc_id", "text_hash", "score", "predicted"])

    return source.mapInArrow(rate, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text_hash long, score double, predicted int")
