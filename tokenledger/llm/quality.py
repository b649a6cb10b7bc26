"""Quality classifier: random Fourier features over document statistics.

Each text becomes a fixed vector of statistics in one Arrow pass; those
vectors (not the texts) are written once and joined to the labels.  A ridge
regression on ``D`` random Fourier features (an approximate Gaussian kernel)
is fitted from normal equations: every training partition adds up its own
``Z'Z`` and ``Z'y``, and only those fixed-size sums reach the driver.
Scores of a part of the labelled rows that the ridge has not seen give an
isotonic calibration, fitted over at most ``CALIBRATION_BINS`` bins.

Defined cases: a null text counts as empty and is scored like any other; a
label that is null is ignored; repeated labels of a document all count; with
no labelled rows (or an empty table) every score is 0.5; with labels of one
class the score is that class; rows repeat in the result as in the input;
other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import (LOWER, NOT_SPACE, fold, giving_back, prepare, segment_sum, span_hash, spread_rows, text_chunks,
                                    word_spans, written)

#: The classifier is fitted on at most about this many labelled rows (a hash
#: sample beyond it); scoring always covers every row.
MAX_TRAIN_ROWS = 400_000
FEATURES = 256
GAMMA = 0.08
RIDGE = 1e-3
CALIBRATION_BINS = 1000
THRESHOLD = 0.3
_FIT_PARTITIONS = 16


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _distinct(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and occurrences of the commonest key, for each row."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(r)))
    top = np.zeros(n)
    np.maximum.at(top, r[at], size)
    return np.bincount(r[at], minlength=n).astype(float), top


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of statistics per text."""
    n = len(off) - 1
    size = np.diff(off).astype(float)
    classes = np.zeros((256, 9), dtype=np.uint8)
    classes[97:123, 0] = classes[65:91, 0] = classes[128:, 0] = 1
    classes[65:91, 1] = 1
    classes[48:58, 2] = 1
    classes[[32, 9, 10, 11, 12, 13], 3] = 1
    classes[list(b".,;:?'\"()-"), 4] = 1
    classes[list(b"!"), 5] = 1
    classes[list(b"#$%&*@<>{}[]=+~^\\/_`"), 6] = 1
    classes[list(b"|"), 7] = 1
    classes[10, 8] = 1
    counts = np.stack([segment_sum(classes[:, c][data], off) for c in range(9)], axis=1).astype(float)
    s, e, w = word_spans(data, off, NOT_SPACE)
    rows = np.repeat(np.arange(n), np.diff(w))
    words = np.diff(w).astype(float)
    length = (e - s).astype(float)
    h = span_hash(LOWER[data], s, e)
    distinct, top = _distinct(rows, h, n)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    three = h.copy()
    if len(h) > 2:
        three[2:] = h[2:] + np.uint64(3) * h[1:-1] + np.uint64(7) * h[:-2]
    kinds, _ = _distinct(rows, three, n)
    mean_len = _ratio(segment_sum(length, w), words)
    ends = np.zeros(len(h))
    if len(h):
        ends = classes[data[e - 1], 5:8].any(axis=1).astype(float)
    x = np.column_stack([
        np.log1p(size), np.log1p(words),
        *[_ratio(counts[:, c], size) for c in (0, 2, 3, 4, 5, 6, 7, 8)],
        _ratio(counts[:, 1], counts[:, 0]),
        mean_len, np.sqrt(np.maximum(_ratio(segment_sum(length * length, w), words) - mean_len ** 2, 0)),
        _ratio(distinct, words), _ratio(kinds, words), _ratio(top, words), _ratio(segment_sum(same, w), words),
        _ratio(segment_sum(ends, w), words), np.log1p(_ratio(words, counts[:, 8] + 1)),
    ])
    return x.astype(np.float32)


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, stats array<float>)`` of every row."""
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for rows, data, off in text_chunks(b):
                x = statistics(data, off)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()),
                                                pa.array(x.ravel(), pa.float32()))
                yield pa.RecordBatch.from_arrays([ids.slice(rows.start, rows.stop - rows.start), flat],
                                                 ["doc_id", "stats"])

    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return src.mapInArrow(giving_back(run), "doc_id bigint, stats array<float>")


class Model:
    """Standardisation, random Fourier map, ridge weights, calibration."""

    def __init__(self, mean, std, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, std
        self.w = rng.normal(0.0, np.sqrt(2 * GAMMA), (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.beta = None
        self.knots = None

    def z(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.std, -6, 6)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2 / FEATURES)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.z(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        r = self.raw(x)
        if self.knots is not None:
            r = np.interp(r, *self.knots)
        return np.clip(r, 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points sorted by ``x``: block centres and values."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, w):
        blocks.append([yi, wi, xi * wi])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, m, c = blocks.pop()
            u = blocks[-1]
            u[0], u[1], u[2] = (u[0] * u[1] + v * m) / (u[1] + m), u[1] + m, u[2] + c
    return np.array([c / m for _, m, c in blocks]), np.array([v for v, _, _ in blocks])


def _stack(batch: pa.RecordBatch, i: int = 0) -> np.ndarray:
    col = batch.column(i)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(np.float64)


def training_labels(labels: DataFrame, label: str, train_fold=None, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame | float:
    """``(doc_id, y)`` of at most about ``max_rows`` rows to learn from; a
    constant when there is nothing to learn."""
    lab = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    if train_fold is not None:
        lab = lab.where(train_fold)
    total = lab.agg(F.count("*"), F.min("y"), F.max("y")).first()
    if not total[0]:
        return 0.5
    if total[1] == total[2]:
        return float(total[1])
    part = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000))
    if total[0] > max_rows:
        lab = lab.where(part < int(1_000_000 * max_rows / total[0]))
    return lab


def fit(stats: DataFrame, labels: DataFrame, label: str, train_fold=None, max_rows: int = MAX_TRAIN_ROWS) -> Model | float:
    """Fit on labelled rows; a constant when there is nothing to learn.

    ``train_fold``: boolean column on ``doc_id`` naming the rows to learn from.
    One fifth of them (by hash) calibrates, the rest fits the ridge.
    """
    lab = training_labels(labels, label, train_fold, max_rows)
    return fit_rows(stats.join(lab, "doc_id")) if isinstance(lab, DataFrame) else lab


def fit_rows(known: DataFrame) -> Model | float:
    """Fit on ``(doc_id, stats, y)``."""
    rows = written(known.select(
        "stats", "y", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0).alias("cal")).repartition(_FIT_PARTITIONS), "quality-train")
    width = len(statistics(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0])

    def moments(batches):
        n, s, q = 0, np.zeros(width), np.zeros(width)
        for b in batches:
            x = _stack(b)
            n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([s.tolist()]), pa.array([q.tolist()])], ["n", "s", "q"])

    got = rows.select("stats").mapInArrow(moments, "n double, s array<double>, q array<double>").collect()
    n = sum(r["n"] for r in got)
    if not n:
        return 0.5
    mean = np.sum([r["s"] for r in got], axis=0) / n
    var = np.sum([r["q"] for r in got], axis=0) / n - mean ** 2
    model = Model(mean, np.sqrt(np.maximum(var, 1e-8)))

    def sums(batches):
        a = np.zeros((FEATURES + 1, FEATURES + 1))
        c = np.zeros(FEATURES + 1)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                z = model.z(_stack(part))
                a += z.T @ z
                c += z.T @ part.column(1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([c.tobytes()])], ["a", "c"])

    def solve(frame: DataFrame) -> np.ndarray:
        parts = frame.select("stats", "y").mapInArrow(sums, "a binary, c binary").collect()
        a = sum(np.frombuffer(p["a"]).reshape(FEATURES + 1, -1) for p in parts)
        c = sum(np.frombuffer(p["c"]) for p in parts)
        penalty = np.full(FEATURES + 1, RIDGE * max(a[-1, -1], 1.0) / FEATURES)
        penalty[-1] = 1e-9
        return np.linalg.solve(a + np.diag(penalty), c)

    model.beta = solve(rows.where(~F.col("cal")))

    def raws(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_stack(b))), b.column(1)], ["r", "y"])

    bins = rows.where("cal").select("stats", "y").mapInArrow(raws, "r double, y double").groupBy(
        F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "r")) * (CALIBRATION_BINS / 3)).alias("bin")).agg(
        F.avg("r").alias("x"), F.avg("y").alias("y"), F.count("*").alias("w")).collect()
    if bins:
        bins.sort(key=lambda r: r["x"])
        model.knots = isotonic(*[np.array([float(r[c]) for r in bins]) for c in ("x", "y", "w")])
    return model


def score(stats: DataFrame, model: Model | float) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    if not isinstance(model, Model):
        return stats.select("doc_id", F.lit(float(model)).alias("score"))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(_stack(part, 1)))], ["doc_id", "score"])

    return stats.mapInArrow(giving_back(run), "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document; labels
    with crc32(doc_id) mod 5 = 0 are never read."""
    stats = written(features(docs), "quality-stats")
    model = fit(stats, labels, label, fold(F.col("doc_id"), 5) != 0)
    return score(stats, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose predicted quality is 1, with their own columns.

    Only labelled rows get statistics for the fit; every row is then judged
    where it stands, and only its text and the verdict pass through Python."""
    prepare(docs)
    model = lab = training_labels(labels, label, fold(F.col("doc_id"), 5) != 0)
    if isinstance(lab, DataFrame):
        # at most about MAX_TRAIN_ROWS ids, however often a label repeats: a proven bound
        known = docs.join(F.broadcast(lab.select(F.col("doc_id").alias("__id")).distinct()),
                          F.col("doc_id").cast("bigint") == F.col("__id"), "left_semi")
        model = fit_rows(features(known).join(lab, "doc_id"))
    if not isinstance(model, Model):
        return docs if float(model) >= threshold else docs.where(F.lit(False))

    @F.arrow_udf("boolean")
    def good(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ok = [model.score(statistics(data, off)) >= threshold
                  for _, data, off in text_chunks(pa.RecordBatch.from_arrays([texts], ["text"]))]
            yield pa.array(np.concatenate([np.zeros(0, dtype=bool), *ok]))

    return docs.where(good(F.col("text").cast("string")))
