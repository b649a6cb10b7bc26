"""Ranked lexical search: items against all documents by blocked matrix products.

1. Items are read in blocks of at most ``BLOCK_TERMS`` terms (one block at a
   time reaches the driver).  A narrow pass over whole texts keeps, for each
   document, its number of terms and its counts of the block's terms; it is
   written once and gives the corpus statistics (documents, terms, document
   frequencies) by plain aggregates.
2. Items are tiled; a tile's terms are renumbered to a compact vocabulary.
   For tiles of documents the impacts of these terms are laid out densely and
   one float64 matrix product scores all pairs of the two tiles.  Weights and
   impacts are whole numbers; a tile's vocabulary is cut where the largest
   possible sum would pass 2**53, so every partial sum is exact in any order of
   summation, and the parts are added as 64-bit integers.
3. Each task keeps the best documents of every item over its tiles: candidates
   reach the worst kept score or tie with it, and ties go to the smaller
   doc_id, so cutting tiles anywhere gives the same ranking.  Tasks hand over
   at most ``k`` rows an item, ranked in two steps (groups of tasks, then all).

Defined cases: a null text has no terms, such a document or item gives no rows;
rows that repeat a doc_id are ranked one by one, a null doc_id after all others
of the same score; rows that repeat an item_id are ranked one by one; an empty
table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.llm.common import prepare, spread_rows
from tokenledger.session import drop_scratch, materialize

K = 10
#: Terms of all items of a block, with repeats between items: bounds what the driver and a worker hold.
BLOCK_TERMS = 100_000
ITEM_TILE = 32
DOC_TILE = 512
#: Sums of products stay below this, the integers that float64 holds exactly.
EXACT = 1 << 53
#: Largest impact of one term in one document.
IMPACT = 1_000_000
#: Tasks whose results are ranked together in the first step.
TASKS = 256

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of digits, letters and characters from
    U+0080 on, A-Z lower-cased."""
    return _TERM.findall(text.translate(_LOWER))


def _utf8(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


def _blocks(items: DataFrame, block_terms: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """``(item ids, distinct terms)`` of consecutive items."""
    ids, found, size = [], [], 0
    for r in items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator():
        words = sorted(set(terms((r["text"] or "").encode())))
        if not words:
            continue
        if ids and size + len(words) > block_terms:
            yield ids, found
            ids, found, size = [], [], 0
        ids.append(r["item_id"])
        found.append(words)
        size += len(words)
    if ids:
        yield ids, found


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``(doc_id, n, at, tf)``: the number of terms of every whole text, and
    its counts of the terms in ``vocabulary`` (by place there)."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches):
        place = shared.value
        for b in batches:
            texts = _utf8(b.column(1))
            n, at, tf = [], [], []
            for text in texts:
                count = Counter(terms(text))
                n.append(count.total())
                hits = [(place[t], c) for t, c in count.items() if t in place]
                at.append([x for x, _ in hits])
                tf.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(tf, pa.list_(pa.int64()))], ["doc_id", "n", "at", "tf"])

    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return src.mapInArrow(run, "doc_id bigint, n bigint, at array<int>, tf array<bigint>")


class Tiles:
    """Items of a block as compact weight matrices."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, limit: int = EXACT):
        tile, local, owner, self.parts = [], [], [], []
        for a in range(0, len(items), ITEM_TILE):
            rows = items[a:a + ITEM_TILE]
            own = np.unique(np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]))
            own = own[weights[own] > 0]
            bound = np.cumsum(weights[own] * IMPACT)
            while len(own):
                m = max(1, int(np.searchsorted(bound, limit, side="left")))
                part, own, bound = own[:m], own[m:], bound[m:] - bound[m - 1]
                w = np.zeros((len(rows), len(part)))
                for i, r in enumerate(rows):
                    j = np.searchsorted(part, r)
                    j = j[(j < len(part)) & (part[np.minimum(j, len(part) - 1)] == r)]
                    w[i, j] = weights[part[j]]
                owner.append(part)
                local.append(np.arange(len(part)))
                tile.append(np.full(len(part), len(self.parts)))
                self.parts.append((a, w))
        # term -> (part, place there), as one sorted list with offsets
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        self.tile = (np.concatenate(tile) if tile else owner)[order]
        self.local = (np.concatenate(local) if local else owner)[order]
        self.offsets = np.searchsorted(owner[order], np.arange(len(weights) + 1))

    def scores(self, doc: np.ndarray, at: np.ndarray, impact: np.ndarray, n_docs: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(first item, items x documents)`` of one tile of documents; the
        postings are ``impact`` of term ``at`` in document ``doc``."""
        times = self.offsets[at + 1] - self.offsets[at]
        rep = np.repeat(np.arange(len(at)), times)
        spot = np.arange(len(rep)) - np.repeat(np.cumsum(times) - times, times) + self.offsets[at][rep]
        order = np.argsort(self.tile[spot], kind="stable")
        rep, spot = rep[order], spot[order]
        cut = np.searchsorted(self.tile[spot], np.arange(len(self.parts) + 1))
        first, total = -1, None
        for k, (a, w) in enumerate(self.parts):
            x, y = cut[k], cut[k + 1]
            dense = np.zeros((w.shape[1], n_docs))
            dense[self.local[spot[x:y]], doc[rep[x:y]]] = impact[rep[x:y]]
            product = (w @ dense).astype(np.int64)
            if a == first:
                total += product
            else:
                if first >= 0:
                    yield first, total
                first, total = a, product
        if first >= 0:
            yield first, total


class Best:
    """The ``k`` best documents of each item: score descending, doc_id ascending."""

    def __init__(self, n_items: int, k: int):
        self.k, self.kept = k, [(np.zeros(0, np.int64),) * 3 for _ in range(n_items)]
        self.worst = np.ones(n_items, dtype=np.int64)

    def add(self, first: int, scores: np.ndarray, doc: np.ndarray, absent: np.ndarray) -> None:
        item, col = np.nonzero(scores >= self.worst[first:first + len(scores), None])
        for i in np.unique(item):
            c = col[item == i]
            s, g, d = (np.concatenate(z) for z in zip(self.kept[first + i], (scores[i, c], absent[c], doc[c])))
            o = np.lexsort((d, g, -s))[:self.k]
            self.kept[first + i] = s[o], g[o], d[o]
            if len(o) == self.k:
                self.worst[first + i] = s[o[-1]]


def _length_norm(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    if len(n) and int(n.max()) * 90 * docs < 1 << 63:
        return 10 + 90 * docs * n // total
    return np.array([10 + 90 * docs * int(x) // total for x in n], dtype=np.int64)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = found.withColumn("_r", F.row_number().over(Window.partitionBy("item", "tasks").orderBy(*order))).where(F.col("_r") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(posted: DataFrame, ids: list, items: list[list[int]], n_terms: int, k: int) -> DataFrame:
    sc = posted.sparkSession.sparkContext
    total = posted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    docs, length = int(total["docs"] or 0), int(total["terms"] or 0)
    weights = np.zeros(n_terms, dtype=np.int64)
    for r in posted.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("df")).collect():
        weights[r["at"]] = math.floor(1000 * math.log((2 * docs + 2) / (2 * r["df"] + 1)))
    shared = sc.broadcast((ids, items, weights, docs, length))

    def run(batches):
        ids, items, weights, docs, length = shared.value
        tiles, best = Tiles(items, weights), Best(len(items), k)
        for b in batches:
            ident = b.column(0)
            absent = ident.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = ident.fill_null(0).to_numpy()
            norm = _length_norm(b.column(1).to_numpy(), docs, length)
            lists = b.column(2)
            off = lists.offsets.to_numpy()
            at = lists.values.to_numpy().astype(np.int64)
            tf = b.column(3).values.to_numpy()
            for x in range(0, b.num_rows, DOC_TILE):
                y = min(x + DOC_TILE, b.num_rows)
                row = np.repeat(np.arange(y - x), np.diff(off[x:y + 1]))
                t = tf[off[x]:off[y]]
                impact = 1_000_000_000 * t // (1000 * t + 8 * norm[x + row])
                for first, s in tiles.scores(row, at[off[x]:off[y]], impact, y - x):
                    best.add(first, s, doc[x:y], absent[x:y])
        out = [(i, ids[i], None if g else int(d), int(s)) for i, kept in enumerate(best.kept) for s, g, d in zip(*kept)]
        if out:
            item, item_id, d, s = zip(*out)
            group = TaskContext.get().partitionId() // TASKS
            yield pa.RecordBatch.from_arrays([
                pa.array(item, pa.int32()), pa.array([group] * len(out), pa.int32()), pa.array(item_id, pa.int64()),
                pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["item", "tasks", "item_id", "doc_id", "score"])

    found = posted.mapInArrow(run, "item int, tasks int, item_id bigint, doc_id bigint, score bigint")
    return _ranked(found, k)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each
    item with a score above 0."""
    spark = docs.sparkSession
    prepare(docs)
    results = []
    for ids, words in _blocks(items, block_terms):
        vocabulary = sorted(set().union(*words))
        place = {t: i for i, t in enumerate(vocabulary)}
        posted, path = materialize(postings(docs, vocabulary), "llm-postings")
        found = _search_block(posted, ids, [[place[t] for t in w] for w in words], len(vocabulary), k)
        results.append(materialize(found, "llm-ranked")[0])
        drop_scratch(spark, path)
    if not results:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, results)
