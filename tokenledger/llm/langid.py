"""Language ID by mixture inference over n-gram likelihoods.

Learning counts hashed byte trigrams of words per language: tasks emit one
row per (language, trigram cell) they have seen, summed by a grouped
aggregate over all rows to learn from; the table of at most ``CELLS`` numbers
per language is all that travels.  A document is a mixture of languages:
expectation-maximisation estimates the proportions from the likelihood of each
word under every language, the candidate sets are the 1, 2, 3, ... languages
with the largest proportions, grown until ``PATIENCE`` larger sets in a row bring
no gain, and the set with the best likelihood less a penalty per extra language
is kept, whatever its size.  The prediction is the language with the largest
proportion in that set, which is also the score.  More than ``MAX_LANGUAGES``
languages to learn are an error: the table of a language takes 256 KB.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
with nothing to learn from every text is ``und``; rows with a null lang are
predicted but never learnt from; a null doc_id is in fold 0; ties go to the
language first in order; rows repeat as in the input; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import LOWER, fold, mix64, segment_sum, spread_rows, text_chunks, word_spans, written

CELLS = 1 << 16
MAX_LANGUAGES = 512
PATIENCE = 2
ROUNDS = 8
PENALTY = 3.0
SMOOTH = 0.2
FLOOR = 1e-4

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(cell of each trigram, word offsets into them, row offsets into words)``:
    the trigrams of `` word `` for every run of letters."""
    low = LOWER[data]
    s, e, w = word_spans(low, off, _LETTER)
    n = e - s
    at = np.append(0, np.cumsum(n))
    # one trigram centred on every letter; the neighbours of the ends are blanks
    pos = np.arange(at[-1]) - np.repeat(at[:-1] - s, n)
    mid = low[pos].astype(np.uint64)
    left, right = np.full(len(pos), 32, np.uint64), np.full(len(pos), 32, np.uint64)
    left[1:], right[:-1] = mid[:-1], mid[1:]
    left[at[:-1][n > 0]] = 32
    right[at[1:][n > 0] - 1] = 32
    cell = mix64((left << np.uint64(16)) | (mid << np.uint64(8)) | right) % np.uint64(CELLS)
    return cell.astype(np.int64), at, w


def learn(docs: DataFrame, keep: Column, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """``(languages, log-probability table [CELLS, languages])``."""
    def run(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), dtype=object)
            for rows, data, off in text_chunks(b):
                cell, at, w = trigrams(data, off)
                tri = at[w]
                own = langs[rows]
                row_of = np.repeat(np.arange(len(own)), np.diff(tri))
                for name in set(own):
                    mine = own == name
                    counts = np.bincount(cell[mine[row_of]], minlength=CELLS)
                    seen[name] = seen.get(name, 0) + counts
        for name, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(counts[at], pa.int64())], ["lang", "cell", "n"])

    rows = docs.where(keep & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    table = spread_rows(rows).mapInArrow(run, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = written(table, "language-counts")
    names = [r["lang"] for r in table.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    got = table.toArrow()  # at most CELLS rows of numbers a language
    counts = np.full((CELLS, max(len(names), 1)), SMOOTH)
    column = pc.index_in(got["lang"], pa.array(names, pa.string())).to_numpy()
    counts[got["cell"].to_numpy(), column] += got["n"].to_numpy()
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def mixtures(cell: np.ndarray, at: np.ndarray, w: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Proportions (rows x languages) of the language set kept for each row;
    zero rows for rows without words."""
    size = np.diff(w)
    k = table.shape[1]
    ll = segment_sum(table[cell].astype(np.float64), at)
    top = ll.max(axis=1, initial=-np.inf, keepdims=True) if len(ll) else ll
    like = np.maximum(np.exp(ll - top), FLOOR) if len(ll) else ll
    n = np.maximum(size, 1)[:, None]

    def em(pi: np.ndarray, rounds: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihoods of the texts ``docs`` from the start ``pi``."""
        own = np.repeat(np.arange(len(docs)), size[docs])
        ends = np.append(0, np.cumsum(size[docs]))
        mine = like if len(docs) == len(size) else like[np.repeat(w[:-1][docs] - ends[:-1], size[docs]) + np.arange(ends[-1])]
        for _ in range(rounds):
            r = mine * pi[own]
            r /= r.sum(axis=1, keepdims=True)
            pi = segment_sum(r, ends) / n[docs]
        return pi, segment_sum(np.log((mine * pi[own]).sum(axis=1)), ends)

    live = np.arange(len(size))
    share, _ = em(np.full((len(size), k), 1.0 / k), ROUNDS, live)
    order = np.argsort(-share, axis=1, kind="stable")
    best, since = np.full(len(size), -np.inf), np.zeros(len(size), dtype=np.int64)
    out = np.zeros((len(size), k))
    for m in range(1, k + 1):
        inside = np.zeros((len(live), k))
        np.put_along_axis(inside, order[live, :m], 1.0, axis=1)
        start = np.maximum(share[live], 1e-3) * inside
        start /= start.sum(axis=1, keepdims=True)
        pi, fit = em(start, 0 if m == 1 else ROUNDS // 2, live)
        value = fit - PENALTY * (m - 1) * np.log(n[live, 0] + 1)
        better = value > best[live]
        best[live[better]], out[live[better]] = value[better], pi[better]
        since[live] = np.where(better, 0, since[live] + 1)
        live = live[since[live] < PATIENCE]
        if not len(live):
            break
    out[size == 0] = 0
    return out


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each text has a letter (of any script)."""
    low = LOWER[data]
    found = segment_sum(((low >= 97) & (low < 123)).astype(np.int64), off) > 0
    for i in np.flatnonzero(~found & (np.diff(off) > 0)):
        found[i] = any(c.isalpha() for c in data[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def predict(docs: DataFrame, names: list[str], table: np.ndarray, text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, languages, shares)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for b in batches:
            for rows, data, off in text_chunks(b):
                m = rows.stop - rows.start
                ok = has_letter(data, off) & bool(names)
                pi = mixtures(*trigrams(data, off), shared.value) if names else np.zeros((m, 1))
                ok &= pi.sum(axis=1) > 0
                best = pi.argmax(axis=1)
                kept = [np.flatnonzero(x > 0) if o else [] for x, o in zip(pi, ok)]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(rows.start, m),
                    pa.array([names[k] if o else "und" for k, o in zip(best, ok)], pa.string()),
                    pa.array(np.where(ok, np.clip(pi.max(axis=1), 0, 1), 0.0)),
                    pa.array([[names[k] for k in ks] for ks in kept], pa.list_(pa.string())),
                    pa.array([[float(x[k]) for k in ks] for x, ks in zip(pi, kept)], pa.list_(pa.float64()))],
                    ["doc_id", "lang_pred", "score", "languages", "shares"])

    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text")))
    return src.mapInArrow(run, "doc_id bigint, lang_pred string, score double, languages array<string>, shares array<double>")


def identify(docs: DataFrame) -> DataFrame:
    """The contract of op4: learn from crc32(doc_id) mod 3 other than 1."""
    names, table = learn(docs, fold(F.col("doc_id"), 3) != 1)
    return predict(docs, names, table).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
                                              "lang_pred", "score", "languages", "shares")
