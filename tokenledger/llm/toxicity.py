"""Toxicity: subsequence string kernel, Nystroem landmarks, linear SVM.

Strings are a text's words (runs of one-letter words count as one string, so
spelt-out insults stay whole).  The kernel compares all subsequences of three
characters that span at most ``SPAN`` characters, weighted ``DECAY`` to the
power of their span, so gaps and inserted characters cost a little instead of
everything; marks and blanks inside a string are skipped, common digit
look-alikes stand for their letters, and both ends of a word are characters of
their own.
Landmarks are whole words and word beginnings whose document frequency best
separates the two labels, none of them much like an earlier one.  A
sentence's kernel with a landmark is the largest over its words (0 below
``FLOOR``); the Nystroem map (inverse square root of the landmarks' own kernel
matrix) turns these into features of a linear SVM with squared hinge loss.  It
is trained on sentences: those of a text with label 0 are labelled 0, of a
text with label 1 those with a positive margin, at least the one with the
largest, are labelled 1, chosen anew in each round.  A text takes the largest margin of its sentences, which a
logistic fit on unseen texts turns into a score.

Learning reads at most about ``MAX_TRAIN_ROWS`` labelled rows (a hash sample
beyond it; their ids are the only broadcast).  Scoring is a narrow pass over
every whole text and sentence; each distinct word of a chunk is compared once.

Defined cases: null or empty texts have no sentences and get the score of zero
features; null labels are ignored; with no labelled rows every score is 0, and
with labels of one class it is that class; rows repeat as in the input; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import LOWER, NOT_SPACE, fold, span_hash, spread_rows, text_chunks, word_spans

MAX_TRAIN_ROWS = 20_000
LANDMARKS = 96
#: Sentences of a training text that are kept (those most like landmarks).
SENTENCES = 6
ROUNDS = 4
MIN_DOCS = 3
#: Least log-likelihood ratio of a landmark (chance gives one in 20,000 strings).
MIN_GAIN = 10.0
DECAY = 0.6
SPAN = 6
#: Words remembered by a worker as like no landmark.
_KNOWN = 1 << 19
_CHUNK = 2 << 20
#: Normalised kernels below this are taken as no likeness.
FLOOR = 0.55
_CANDIDATES = 3000
_ALIKE = 0.8
_EDGE = "\x02"

#: Alphabet of the kernel: a-z, look-alikes as letters, other characters by
#: byte; 0 marks characters that are skipped.
_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[0x80:] = 27 + np.arange(128) % 36
_CODE[ord(_EDGE)] = 63
for _a, _b in zip(b"013457@$", b"oieastas"):
    _CODE[_a] = _CODE[_b]
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _subsequences(codes: np.ndarray, off: np.ndarray):
    """``(string, subsequence, weight)`` arrays of every weighted triple."""
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    end, pos = off[1:][owner], np.arange(len(codes))
    for a, b in _GAPS:
        i = pos[pos + b < end]
        x, y, z = codes[i], codes[i + a], codes[i + b]
        yield owner[i], x * 4096 + y * 64 + z, DECAY ** (b + 1)


def self_kernel(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Kernel of each string with itself."""
    parts = [(o * (1 << 18) + u, np.full(len(o), w)) for o, u, w in _subsequences(codes, off)]
    key, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    total = np.bincount(at, np.concatenate([w for _, w in parts]), minlength=len(key))
    return np.bincount(key >> 18, total * total, minlength=len(off) - 1)


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, with runs of one-character words joined: ``(starts, ends, row offsets)``."""
    s, e, w = word_spans(data, off, NOT_SPACE)
    lone = e - s == 1
    cont = np.zeros(len(s), dtype=bool)
    cont[1:] = lone[1:] & lone[:-1]
    cont[w[:-1][w[:-1] < len(s)]] = False
    first = np.flatnonzero(~cont)
    last = np.append(first[1:], len(s)) - 1 if len(first) else first
    return s[first], e[last], np.searchsorted(first, w)


def _codes(raw: bytes) -> np.ndarray:
    return _CODE[LOWER[np.frombuffer(raw, np.uint8)]]


class Landmarks:
    """Sparse subsequence weights of the landmarks, for many words at once."""

    def __init__(self, words: list[str]):
        self.words = words
        m = len(words)
        raw = [_codes(w.encode()) for w in words]
        codes, off = np.concatenate([np.zeros(0, np.int64), *raw]), np.append(0, np.cumsum([len(c) for c in raw])).astype(np.int64)
        self.norm = np.sqrt(np.maximum(self_kernel(codes, off), 1e-12))
        parts = list(_subsequences(codes, off))
        owner, code = np.concatenate([o for o, _, _ in parts]), np.concatenate([u for _, u, _ in parts])
        key, at = np.unique(code * m + owner, return_inverse=True)
        self.weight = np.bincount(at, np.concatenate([np.full(len(o), w) for o, _, w in parts]), minlength=len(key))
        self.mark = key % max(m, 1)  # each subsequence stands in few landmarks
        seen, first = np.unique(key // max(m, 1), return_index=True)
        self.row = np.full(1 << 18, -1, dtype=np.int32)
        self.row[seen] = np.arange(len(seen))
        self.first = np.append(first, len(key))
        # a word's beginning is compared with landmarks that are beginnings
        self.windows: dict[int, list[int]] = {}
        for t, word in enumerate(words):
            whole = word.endswith(_EDGE)
            self.windows.setdefault(0 if whole else len(raw[t]) + 1, []).append(t)
        self.unlike = np.zeros(0, np.uint64)  # hashes of words met that are like no landmark

    def kernel(self, codes: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Kernel of each string ``codes[off[i]:off[i + 1]]`` with every landmark."""
        n, m = len(off) - 1, len(self.words)
        cells, values = [], []
        for owner, code, weight in _subsequences(codes, off):
            row = self.row[code]
            hit = row >= 0
            row = row[hit]
            count = self.first[row + 1] - self.first[row]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[row], count)
            cells.append(np.repeat(owner[hit], count) * m + self.mark[at])
            values.append(self.weight[at] * weight)
        return np.bincount(np.concatenate(cells), np.concatenate(values), minlength=n * m).reshape(n, m)

    def likeness(self, codes: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Normalised kernel (cosine) of strings with the landmarks, 0 below
        ``FLOOR``; beginnings are compared with the string's beginning."""
        out = np.zeros((len(off) - 1, len(self.words)))
        # a cosine of FLOOR needs this share of a landmark's own kernel
        strong = np.flatnonzero((self.kernel(codes, off) >= FLOOR ** 2 * self.norm ** 2).any(axis=1))
        if not len(strong):
            return out
        for window, marks in self.windows.items():
            size = np.diff(off)[strong]
            size = np.minimum(size, window) if window else size
            at = np.append(0, np.cumsum(size))
            part = codes[np.arange(at[-1]) + np.repeat(off[:-1][strong] - at[:-1], size)]
            own = np.sqrt(np.maximum(self_kernel(part, at), 1e-12))
            out[np.ix_(strong, marks)] = (self.kernel(part, at) / own[:, None] / self.norm[None, :])[:, marks]
        out[out < FLOOR] = 0
        return out

    def sentences(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kernel features (largest over the words) of the sentences that are
        like any landmark, and the text each stands in, in order."""
        s, e, w = units(data, off)
        m = len(self.words)
        if not len(s):
            return np.zeros((0, m)), np.zeros(0, np.int64)
        low = LOWER[data]
        h = span_hash(low, s, e)
        if len(self.unlike):
            at = np.minimum(np.searchsorted(self.unlike, h), len(self.unlike) - 1)
            fresh = self.unlike[at] != h
        else:
            fresh = np.ones(len(h), dtype=bool)
        met, first, which = np.unique(h[fresh], return_index=True, return_inverse=True)
        fresh = np.flatnonzero(fresh)
        first = fresh[first]
        size = (e - s)[first]
        at = np.append(0, np.cumsum(size + 2))
        pos = np.arange(at[-1]) + np.repeat(s[first] - 1 - at[:-1], size + 2)
        codes = _CODE[low[np.clip(pos, 0, len(low) - 1)]]
        codes[at[:-1]] = codes[at[1:] - 1] = _CODE[ord(_EDGE)]
        at = np.append(0, np.cumsum(codes > 0))[at]  # marks and blanks inside a word do not count
        k = self.likeness(codes[codes > 0], at)
        # a sentence ends with a stop mark at a word's end, a line or a text
        new = np.zeros(len(s), dtype=bool)
        new[w[:-1][w[:-1] < len(s)]] = True
        lines = np.append(0, np.cumsum(data == 10))[s]
        new[1:] |= _STOP[data[e[:-1] - 1]] | (lines[1:] != lines[:-1])
        like = k.any(axis=1)
        self.unlike = np.sort(np.concatenate([self.unlike[:0 if len(self.unlike) >= _KNOWN else None], met[~like]]))
        picked = np.flatnonzero(like[which])
        strong, which = fresh[picked], which[picked]
        sentence = np.cumsum(new)[strong]
        cut = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1])) if len(strong) else strong
        if not len(cut):
            return np.zeros((0, m)), np.zeros(0, np.int64)
        return np.maximum.reduceat(k[which], cut, axis=0), np.searchsorted(w, strong[cut], side="right") - 1


def _own(words: list[str]) -> np.ndarray:
    """Normalised kernel of strings with each other."""
    raw = [_codes(x.encode()) for x in words]
    marks = Landmarks(words)
    k = marks.kernel(np.concatenate(raw), np.append(0, np.cumsum([len(x) for x in raw])))
    return k / marks.norm[:, None] / marks.norm[None, :]


def _pick(candidates: list[str], most: int) -> list[str]:
    """The first ``most`` candidates that are not much like an earlier pick."""
    chosen: list[int] = []
    if candidates:
        k = _own(candidates)
        for i in range(len(candidates)):
            if len(chosen) < most and (not chosen or k[i, chosen].max() < _ALIKE):
                chosen.append(i)
    return [candidates[i] for i in chosen]


class Model:
    """Nystroem map, SVM weights and the logistic link."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        k = _own(landmarks.words)
        val, vec = np.linalg.eigh((k + k.T) / 2)
        self.map = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-2))) @ vec.T
        self.w = np.zeros(len(landmarks.words) + 1)
        self.link = (1.0, 0.0)

    def z(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x @ self.map, np.ones((len(x), 1))])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.z(x) @ self.w

    def texts(self, x: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Largest margin over each text's sentences; one like no landmark
        (and an empty text) has the margin of zero features."""
        out = np.full(n, self.w[-1])
        np.maximum.at(out, doc, self.margin(x))
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        a, b = self.link
        return 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))


def _svm(z: np.ndarray, y: np.ndarray, c: float = 1.0) -> np.ndarray:
    """Squared-hinge linear SVM in the primal, by Newton steps on its active set."""
    s = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, len(y) / max(2 * (y > 0).sum(), 1), len(y) / max(2 * (y <= 0).sum(), 1))
    w = np.zeros(z.shape[1])
    reg = np.full(z.shape[1], 1.0)
    reg[-1] = 1e-6
    for _ in range(50):
        on = s * (z @ w) < 1
        za, wa = z[on], c * weight[on]
        new = np.linalg.solve(np.diag(reg) + (za * wa[:, None]).T @ za, (za * wa[:, None]).T @ s[on])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(1 | margin), with smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        r = np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(r * m * m).sum() + 1e-3, (r * m).sum()], [(r * m).sum(), r.sum() + 1e-6]])
        step = np.linalg.solve(h, [((p - t) * m).sum(), (p - t).sum()])
        step = np.clip(step, -2, 2)
        a, b = a - step[0], b - step[1]
    return float(max(a, 1e-3)), float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_fold=None, max_rows: int = MAX_TRAIN_ROWS) -> Model | float:
    """Learn from labelled rows; a constant when there is nothing to separate."""
    lab = labels.select(F.col("doc_id").cast("bigint").alias("__id"), F.col(label).cast("int").alias("y")).where(
        F.col("__id").isNotNull() & F.col("y").isNotNull())
    if train_fold is not None:
        lab = lab.where(train_fold(F.col("__id")))
    total = lab.agg(F.count("*"), F.min("y"), F.max("y")).first()
    if not total[0]:
        return 0.0
    if total[1] == total[2]:
        return float(total[1])
    if total[0] > max_rows:
        lab = lab.where(F.pmod(F.xxhash64("__id", F.lit(23)), F.lit(1_000_000)) < int(1_000_000 * max_rows / total[0]))
    # at most about max_rows rows of two numbers: a proven bound
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")).join(
        F.broadcast(lab), F.col("doc_id") == F.col("__id")).select(
        "y", (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4)) == 0).alias("cal"), "text")
    edge = F.lit(_EDGE)
    split = F.filter(F.split("text", r"[^\p{L}\p{N}@$]+"), lambda w: F.length(w).between(3, 40))
    strings = F.flatten(F.transform(F.array_distinct(split), lambda w: F.array(
        F.concat(edge, w, edge), *[F.concat(edge, F.left(w, F.lit(k))) for k in (4, 5, 6)])))
    words = rows.select("y", F.explode(F.array_distinct(strings)).alias("word"))
    seen = words.groupBy("word").agg(F.sum("y").alias("one"), F.count("*").alias("n"))
    base = rows.agg(F.sum("y"), F.count("*")).first()
    if not base[1] or not base[0] or base[0] == base[1]:
        return float(base[0] > 0) if base[1] else 0.0
    p1, p0 = float(base[0]), float(base[1] - base[0])
    # log-likelihood ratio of the string's labels against the base rate
    p, one, two = p1 / (p0 + p1), F.col("one").cast("double"), (F.col("n") - F.col("one")).cast("double")
    gain = one * F.log(one / (F.col("n") * p)) + F.when(two > 0, two * F.log(two / (F.col("n") * (1 - p)))).otherwise(0.0)
    top = seen.where((one >= MIN_DOCS) & (one > F.col("n") * p)).withColumn("gain", gain).where(F.col("gain") >= MIN_GAIN).orderBy(
        F.col("gain").desc(), F.length("word").desc(), "word").limit(_CANDIDATES).collect()
    chosen = _pick([r["word"] for r in top], LANDMARKS)
    if not chosen:
        return float(p1 / (p0 + p1))
    marks = Landmarks(chosen)

    def run(batches):
        for b in batches:
            for at, data, off in text_chunks(b, chunk_bytes=_CHUNK):
                x, doc = marks.sentences(data, off)
                for i in range(at.stop - at.start):
                    own = x[np.searchsorted(doc, i):np.searchsorted(doc, i, side="right")]
                    own = own[np.argsort(-(own * own).sum(axis=1), kind="stable")[:SENTENCES]].astype(np.float32)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at.start + i, 1), b.column(1).slice(at.start + i, 1),
                                                      pa.array([own.tobytes()], pa.binary())], ["y", "cal", "x"])

    got = spread_rows(rows).mapInArrow(run, "y int, cal boolean, x binary").collect()
    parts = [np.frombuffer(r["x"], np.float32).reshape(-1, len(chosen)) for r in got]
    x, doc = np.concatenate(parts).astype(float), np.repeat(np.arange(len(got)), [len(p) for p in parts])
    y = np.array([r["y"] for r in got])
    cal = np.array([r["cal"] for r in got])
    if len(set(y[~cal])) < 2 or len(set(y[cal])) < 2:
        cal[:] = False
    model = Model(marks)
    z = model.z(x)
    learn, value = ~cal[doc], x.max(axis=1, initial=0.0) - _ALIKE
    for _ in range(ROUNDS):
        # of a text with label 1 its most telling sentence and those on the
        # right side (at first: those that hold a landmark), of the others all
        best = np.full(len(got), -np.inf)
        np.maximum.at(best, doc, value)
        use = learn & ((y[doc] == 0) | (value == best[doc]) | (value > 0))
        if not (y[doc[use]] > 0).any():
            return float(p)
        model.w = _svm(np.vstack([z[use], np.eye(1, z.shape[1], z.shape[1] - 1)]), np.append(y[doc[use]], 0))
        value = z @ model.w
    unseen = cal if cal.any() else ~cal
    margin = model.texts(x, doc, len(got))
    model.link = _logistic(margin[unseen], y[unseen])
    return model


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``(doc_id, score, nearest)`` of every row; ``nearest`` is the landmark
    most like the sentence that decides."""
    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")))
    if not isinstance(model, Model):
        return src.select("doc_id", F.lit(float(model)).alias("score"), F.lit(None).cast("string").alias("nearest"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            for rows, data, off in text_chunks(b, chunk_bytes=_CHUNK):
                n = rows.stop - rows.start
                x, doc = m.landmarks.sentences(data, off)
                margin = m.texts(x, doc, n)
                near: list[str | None] = [None] * n
                for i, v, k in zip(doc.tolist(), m.margin(x), x.argmax(axis=1)):
                    if v == margin[i]:
                        near[i] = m.landmarks.words[k].strip(_EDGE)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(rows.start, n), pa.array(m.probability(margin)),
                                                  pa.array(near, pa.string())], ["doc_id", "score", "nearest"])

    return src.mapInArrow(run, "doc_id bigint, score double, nearest string")


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """The contract of op5: learn from crc32(doc_id) mod 5 other than 0."""
    model = fit(docs, labels, label, lambda c: fold(c, 5) != 0)
    return score(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), "nearest")
