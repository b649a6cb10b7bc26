"""Benchmark decontamination with an FM-index per training shard.

The benchmark's windows (13 words, or a whole shorter item) are the phrases.
Each task reads its documents as words and keeps the runs of words that could
hold a phrase at all: words of the benchmark, with neighbours that also stand
side by side there.  That is exact (nothing dropped can be part of a match)
and leaves little of a clean document.  The runs of a shard are indexed:
suffix array, Burrows-Wheeler transform, a wavelet matrix for ranks and every
``SAMPLE``-th suffix position.  All phrases are searched backwards at once,
their occurrences are located by walking to a sampled position, confirmed
word by word, and the hit words of a document are merged into spans.

The phrases travel to the tasks in blocks of at most ``BLOCK_BYTES`` of
benchmark text, so a benchmark of any size has a bounded broadcast; documents
are never shuffled when one block is enough.  With several, the documents are
written once with a number per row, the hits of one block are written before
the next block is read, and they meet again by row number.

Defined cases: null or word-less texts have no words and no hits; null items
and items without words are skipped; items that share an id count once;
repeated documents and documents without id each get their row, whatever the
number of blocks; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenledger.llm.common import (ALNUM, LOWER, free_names, giving_back, span_hash, spread_rows, text_chunks, word_spans, written)

WINDOW = 13
SAMPLE = 8
SHARD_WORDS = 1 << 19
SHARD_ROWS = 1 << 14
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 16 << 20

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("word_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("byte_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType()))])
_SPANS = pa.list_(pa.list_(pa.int64()))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative ids by prefix doubling."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    k = 1
    order = np.argsort(rank, kind="stable")
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:max(n - k, 0)] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        step = np.zeros(n, dtype=np.int64)
        step[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step)
        if not n or rank[order[-1]] == n - 1:
            return order
        k *= 2


class WaveletMatrix:
    """Rank of any symbol in a sequence, vectorised over queries."""

    def __init__(self, s: np.ndarray):
        self.levels = max(1, int(s.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for lv in range(self.levels - 1, -1, -1):
            bit = (s >> lv) & 1
            ones = np.zeros(len(s) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(s) - int(ones[-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``c`` before position ``i``."""
        lo = np.zeros_like(i)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (c >> (self.levels - 1 - k)) & 1
            a, b = ones[lo], ones[i]
            lo = np.where(bit == 1, zeros + a, lo - a)
            i = np.where(bit == 1, zeros + b, i - b)
        return i - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        """Symbol at position ``i``."""
        c = np.zeros_like(i)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[i + 1] - ones[i]
            c = (c << 1) | bit
            i = np.where(bit == 1, zeros + ones[i], i - ones[i])
        return c


class FMIndex:
    """FM-index of a sequence of non-negative ids (0 separates runs).  Inside,
    ids are shifted by one, so that 0 ends the text once."""

    def __init__(self, s: np.ndarray):
        s = np.append(np.asarray(s, dtype=np.int64) + 1, 0)
        sa = suffix_array(s)
        self.n = len(s)
        self.bwt = WaveletMatrix(s[sa - 1])
        self.first = np.zeros(int(s.max()) + 2, dtype=np.int64)
        np.cumsum(np.bincount(s), out=self.first[1:])
        kept = sa % SAMPLE == 0
        self.is_sampled = kept
        self.sample_rank = np.append(0, np.cumsum(kept))
        self.samples = sa[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of right-aligned phrases (rows of ids) by backward search."""
        q = len(phrases)
        lo, hi = np.zeros(q, np.int64), np.full(q, self.n, np.int64)
        top = len(self.first) - 1
        for k in range(phrases.shape[1]):
            c = phrases[:, phrases.shape[1] - 1 - k].astype(np.int64) + 1
            on = np.flatnonzero((k < lengths) & (hi > lo))
            if not len(on):
                break
            known = c[on] < top
            hi[on[~known]] = lo[on[~known]] = 0
            on = on[known]
            base = self.first[c[on]]
            a, b = self.bwt.rank(c[on], lo[on]), self.bwt.rank(c[on], hi[on])
            lo[on], hi[on] = base + a, base + b
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to a sampled one."""
        row, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
        while True:
            on = np.flatnonzero(~self.is_sampled[row])
            if not len(on):
                break
            c = self.bwt.access(row[on])
            row[on] = self.first[c] + self.bwt.rank(c, row[on])
            steps[on] += 1
        return self.samples[self.sample_rank[row]] + steps


class Phrases:
    """Windows of a block of benchmark items as ids of their words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        texts = pa.RecordBatch.from_arrays([pa.array([t for _, t in items], pa.string())], ["text"])
        words: list[list[bytes]] = []
        hashes = []
        for _, data, off in text_chunks(texts, chunk_bytes=1 << 40, chunk_rows=1 << 40):
            low = LOWER[data]
            s, e, w = word_spans(low, off, ALNUM)
            hashes, raw = span_hash(low, s, e), low.tobytes()
            spelled = [raw[a:b] for a, b in zip(s.tolist(), e.tolist())]
            words = [spelled[a:b] for a, b in zip(w[:-1], w[1:])]
        self.vocab = np.unique(np.asarray(hashes, dtype=np.uint64))
        ids = (np.searchsorted(self.vocab, np.asarray(hashes, np.uint64)) + 1).astype(np.int64)
        self.spelling: dict[int, bytes] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        pairs = set()
        at = 0
        for (item, _), ws in zip(items, words):
            own = ids[at:at + len(ws)].tolist()
            at += len(ws)
            for i, b in zip(own, ws):
                if self.spelling.setdefault(i, b) != b:
                    raise RuntimeError("two benchmark words share a hash")
            pairs.update(zip(own, own[1:]))
            for k in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(tuple(own[k:k + window]), set()).add(item)
        self.pairs = np.array(sorted(a * (len(self.vocab) + 1) + b for a, b in pairs), dtype=np.int64)
        self.items = [sorted(v) for v in found.values()]
        self.lengths = np.array([len(k) for k in found], dtype=np.int64)
        self.ids = np.zeros((len(found), window), dtype=np.int64)
        for row, k in zip(self.ids, found):
            row[window - len(k):] = k
        self.shortest = int(self.lengths.min(initial=window))

    def word_ids(self, h: np.ndarray) -> np.ndarray:
        """Benchmark id of each word hash, 0 if it is no benchmark word."""
        if not len(self.vocab):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        return np.where(self.vocab[at] == h, at + 1, 0)

    def runs(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(starts, ends)`` of word runs that could hold a phrase."""
        n = len(ids)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        joined = np.zeros(n, dtype=bool)  # word i continues word i - 1
        cand = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
        key = ids[cand] * (len(self.vocab) + 1) + ids[cand + 1]
        if len(self.pairs) and len(cand):
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[cand[self.pairs[at] == key] + 1] = True
        joined[offsets[:-1][offsets[:-1] < n]] = False
        start = np.flatnonzero((ids > 0) & ~joined)
        stop = np.ones(n, dtype=bool)
        stop[:-1] = ~joined[1:]
        end = np.flatnonzero((ids > 0) & stop) + 1
        ok = end - start >= self.shortest
        return start[ok], end[ok]


def _merge(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


class _Shard:
    """Rows of a shard with their candidate runs; ``flush`` searches them."""

    def __init__(self, phrases: Phrases):
        self.p = phrases
        self.clear()

    def clear(self):
        self.ids, self.n_words = [], []
        self.run_ids, self.run_row, self.run_word, self.run_bytes, self.run_spelled = [], [], [], [], []
        self.words = 0

    def add(self, doc_ids: list, data: np.ndarray, off: np.ndarray) -> None:
        low = LOWER[data]
        s, e, w = word_spans(low, off, ALNUM)
        ids = self.p.word_ids(span_hash(low, s, e))
        base = len(self.ids)
        self.ids += doc_ids
        self.n_words += np.diff(w).tolist()
        for a, b in zip(*self.p.runs(ids, w)):
            row = int(np.searchsorted(w, a, side="right")) - 1
            self.run_ids.append(ids[a:b])
            self.run_row.append(base + row)
            self.run_word.append(int(a - w[row]))
            self.run_bytes.append((s[a:b] - off[row], e[a:b] - off[row]))
            self.run_spelled.append([low[x:y].tobytes() for x, y in zip(s[a:b], e[a:b])])
            self.words += int(b - a) + 1

    def flush(self) -> pa.RecordBatch:
        n = len(self.ids)
        hits: dict[int, list] = {}
        items: dict[int, set] = {}
        if self.run_ids:
            text = np.concatenate([np.append(x, 0) for x in self.run_ids])
            at = np.cumsum([0] + [len(x) + 1 for x in self.run_ids])
            index = FMIndex(text)
            lo, hi = index.search(self.p.ids, self.p.lengths)
            which = np.repeat(np.arange(len(lo)), hi - lo)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
            pos = index.locate(rows)
            run = np.searchsorted(at, pos, side="right") - 1
            for q, r, k in zip(which.tolist(), run.tolist(), (pos - at[run]).tolist()):
                m = int(self.p.lengths[q])
                spelled = self.run_spelled[r][k:k + m]
                if any(self.p.spelling[int(i)] != b for i, b in zip(self.run_ids[r][k:k + m], spelled)):
                    continue  # another word with the hash of a benchmark word
                row = self.run_row[r]
                first, last = self.run_bytes[r]
                hits.setdefault(row, []).append((self.run_word[r] + k, self.run_word[r] + k + m, int(first[k]), int(last[k + m - 1])))
                items.setdefault(row, set()).update(self.p.items[q])
        spans, cuts = [[] for _ in range(n)], [[] for _ in range(n)]
        for row, found in hits.items():
            f = np.array(found)
            spans[row], cuts[row] = _merge(f[:, 0], f[:, 1]), _merge(f[:, 2], f[:, 3])
        out = pa.RecordBatch.from_arrays([
            pa.array(self.ids, pa.int64()), pa.array(self.n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(cuts, _SPANS),
            pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string()))], [f.name for f in SCHEMA])
        self.clear()
        return out


class _Blocks:
    """The benchmark in blocks of bounded size; each is read to the driver
    when the iteration comes to it."""

    def __init__(self, benchmark: DataFrame, block_bytes: int):
        self.rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where(
            "i is not null and t is not null").distinct()
        size = self.rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        self.n = max(1, -(-size // block_bytes))

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[list[tuple[str, str]]]:
        for b in range(self.n):
            yield [(r["i"], r["t"]) for r in self.rows.where(F.pmod(F.xxhash64("i"), F.lit(self.n)) == b).collect()]


def _blocks(benchmark: DataFrame, block_bytes: int) -> _Blocks:
    return _Blocks(benchmark, block_bytes)


def _search(src: DataFrame, shared) -> DataFrame:
    """Spans of the broadcast phrases in every row of ``src`` (an id, text)."""
    def run(batches):
        shard = _Shard(shared.value)
        for b in batches:
            for rows, data, off in text_chunks(b):
                shard.add(b.column(0).slice(rows.start, rows.stop - rows.start).to_pylist(), data, off)
                if shard.words >= SHARD_WORDS or len(shard.ids) >= SHARD_ROWS:
                    yield shard.flush()
        if shard.ids:
            yield shard.flush()

    return src.mapInArrow(giving_back(run), SCHEMA)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written once with a number per row, ``__row``."""
    return written(spread_rows(docs).withColumn("__row", F.monotonically_increasing_id()), "decontaminate-rows")


def _merged_spans(rows: DataFrame, blocks: _Blocks, window: int) -> DataFrame:
    """The columns of ``find_spans`` by ``__row``: each block's hits are written
    before the next block is read, then merged row by row."""
    src, every = rows.select("__row", "text"), None
    for block in blocks:
        shared = src.sparkSession.sparkContext.broadcast(Phrases(block, window))
        found = _search(src, shared)  # the first block's rows also bring n_words of rows without hits
        found = written(found if every is None else found.where(F.size("items") > 0), "decontaminate-spans")
        shared.destroy()
        every = found if every is None else every.union(found)

    def join_spans(name: str):
        merged = F.aggregate(F.array_sort(F.flatten(F.collect_list(name))), F.array().cast("array<array<bigint>>"),
                             lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(F.element_at(acc, -1), -1) >= x[0]),
                                                   F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.array(
                                                       F.element_at(acc, -1)[0], F.greatest(F.element_at(F.element_at(acc, -1), -1), x[1])))))
                             .otherwise(F.concat(acc, F.array(x))))
        return merged.alias(name)

    return every.groupBy(F.col("doc_id").alias("__row")).agg(
        F.max("n_words").alias("n_words"), join_spans("word_spans"), join_spans("byte_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_words, word_spans, byte_spans, items)`` per document: hit
    spans ``[from, to)`` in words and in UTF-8 bytes, and the items found."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = _blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        return _search(spread_rows(src), src.sparkSession.sparkContext.broadcast(Phrases(next(iter(blocks)), window)))
    rows = _numbered(src)
    return rows.select("__row", "doc_id").join(_merged_spans(rows, blocks, window), "__row").select(SCHEMA.names)


def _is_contaminated(n_hit, n_words):
    """The contract's rule, on columns or on numbers."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def _n_hit() -> Column:
    return F.aggregate("word_spans", F.lit(0).cast("bigint"), lambda a, x: a + x[1] - x[0])


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The contract's digest of ``find_spans`` per document."""
    return find_spans(docs, benchmark, block_bytes=block_bytes).select(
        "doc_id", "n_words", _n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")).withColumn(
        "contaminated", _is_contaminated(F.col("n_hit"), F.col("n_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without its contaminated rows.  Every row is judged by its own
    text, whether its doc_id is null, repeated or neither."""
    blocks = _blocks(benchmark, block_bytes)
    if len(blocks) > 1:
        own = free_names(docs, "__given_row")[0]  # a column of the caller's that has this name
        rows = _numbered(docs.withColumnRenamed("__row", own))
        bad = _merged_spans(rows, blocks, WINDOW).where(_is_contaminated(_n_hit(), F.col("n_words"))).select("__row")
        return rows.join(bad, "__row", "left_anti").drop("__row").withColumnRenamed(own, "__row").select(docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(Phrases(next(iter(blocks))))

    def run(batches):
        shard, held, size = _Shard(shared.value), [], 0

        def clean():
            found = shard.flush()
            n_hit = np.array([sum(b - a for a, b in spans) for spans in found.column("word_spans").to_pylist()], np.int64)
            ok, at = ~_is_contaminated(n_hit, found.column("n_words").to_numpy()), 0
            for part in held:
                yield part.filter(pa.array(ok[at:at + len(part)]))
                at += len(part)

        for b in batches:
            texts = pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("text"))], ["text"])
            for rows, data, off in text_chunks(texts):
                n = rows.stop - rows.start
                shard.add([None] * n, data, off)
                held.append(b.slice(rows.start, n))
                size += len(data)
                if shard.words >= SHARD_WORDS or len(shard.ids) >= SHARD_ROWS or size >= SHARD_BYTES:
                    yield from clean()
                    held, size = [], 0
        if held:
            yield from clean()

    return spread_rows(docs).mapInArrow(giving_back(run), docs.schema)


def remove_spans(text: str, byte_spans: list[list[int]]) -> str:
    """``text`` without the given byte spans."""
    raw, out, at = text.encode(), [], 0
    for a, b in byte_spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()


