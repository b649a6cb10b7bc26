"""Repeated-passage removal with a run-length index (r-index).

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
earlier in the corpus.  Equal strings must meet in one task without comparing
all texts, so texts are routed by content:

1. Every ``LENGTH``-byte string picks an anchor: the ``GRAM``-byte string
   inside it with the smallest hash.  Consecutive strings with one anchor form
   a segment (about 35 strings).  Tasks hash their segments; of equal ones
   within a task only the first goes on, so a passage shared by a third of the
   corpus costs one row per task.  Anchors that are frequent in a bounded
   sample are picked last, which keeps common phrases in differing contexts
   from gathering in one task; this moves load only, never results.
2. By anchor, equal segments are settled at once: all but the earliest are
   removed whole.  Only where an anchor stands in several different segments,
   one copy of each is cut from its text.  An anchor with more than ``HOT``
   segments is cut again by anchors of ``LONG_GRAM`` bytes.
3. The cut segments of a group of anchors are indexed in corpus order: suffix
   array, Burrows-Wheeler transform kept as runs, suffix positions sampled at
   both ends of every run, and for each class of suffixes that share
   ``LENGTH`` bytes its first occurrence.  Each segment is streamed backwards
   through the runs, carrying its matching statistics; a string is a repeat
   when its statistic reaches ``LENGTH`` and the first occurrence of its class
   lies before itself.
4. Removal spans are gathered by document and applied to the text.

Defined cases: null and shorter texts keep all their bytes; matches never
cross documents; rows that repeat a doc_id are one document and should hold
one text (spans are clipped to each row's text); a row with null doc_id is
never matched or changed; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import mix64, span_hash, spread_rows, text_chunks, written

LENGTH = 100
GRAM = 32
LONG_GRAM = 80
HOT = 5000
SAMPLE_ROWS = 5000
_FREQUENT = 12
_FLUSH = 1 << 20
_BLOCK = 1 << 23  # positions of one pass over a text
_LOW = np.uint64((1 << 24) - 1)
_TEXT_PER_BUCKET = 32 << 20
_CUT_PER_TASK = 1 << 20


# ------------------------------------------------------------ segments

class Frequent:
    """A set of anchors, tested through a bitmap first."""

    def __init__(self, anchors: np.ndarray):
        self.anchors = np.unique(np.asarray(anchors, dtype=np.uint64))
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.anchors & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = self.bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            k = np.minimum(np.searchsorted(self.anchors, h[at]), len(self.anchors) - 1)
            out[at] = self.anchors[k] == h[at]
        return out


def segments(data: np.ndarray, off: np.ndarray, gram: int = GRAM, frequent: Frequent | None = None,
             length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``(row, start, size, anchor, hash)`` of all segments: bytes
    ``start:start + size`` of the row hold all its strings with that anchor."""
    parts = []
    for b0 in range(0, max(len(data) - length + 1, 0), _BLOCK):
        sub = data[b0:b0 + _BLOCK + length - 1]
        n = len(sub) - length + 1
        at = np.arange(len(sub) - gram + 1)
        h = span_hash(sub, at, at + gram)
        key = ((h >> np.uint64(1)) & ~_LOW) | at.astype(np.uint64)
        if frequent is not None:
            key |= frequent(h).astype(np.uint64) << np.uint64(63)
        width, step = length - gram + 1, 1
        while 2 * step <= width:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        rest = width - step
        key = np.minimum(key[:len(key) - rest], key[rest:])[:n]
        anchor = (key & _LOW).astype(np.int64)
        start = np.arange(n) + b0
        row = np.searchsorted(off, start, side="right") - 1
        ok = start + length <= off[row + 1]
        first = ok.copy()
        first[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        s = np.flatnonzero(first)
        if not len(s):
            continue
        last = np.zeros(n, dtype=bool)
        last[-1] = ok[-1]
        last[:-1] = ok[:-1] & (~ok[1:] | first[1:])
        e = np.flatnonzero(last) + length
        parts.append((row[s], s + b0 - off[row[s]], e - s, h[anchor[s]], span_hash(sub, s, e)))
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _merged(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans per document, sorted."""
    if not len(doc):
        return doc, a, b
    o = np.lexsort((a, doc))
    doc, a, b = doc[o], a[o], b[o]
    group = np.cumsum(np.append(True, doc[1:] != doc[:-1]))
    shift = group.astype(np.int64) * (int(b.max()) + 2)
    reach = np.maximum.accumulate(b + shift)
    new = np.append(True, (a + shift)[1:] > reach[:-1])
    s = np.flatnonzero(new)
    return doc[s], a[s], (reach - shift)[np.append(s[1:], len(doc)) - 1]


def _by_document(doc: np.ndarray, *cols: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Rows of int64 columns packed per document."""
    o = np.argsort(doc, kind="stable")
    doc = doc[o]
    table = np.column_stack([c[o].astype(np.int64) for c in cols])
    s = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    return doc[s].tolist(), [x.tobytes() for x in np.split(table, s[1:])] if len(s) else []


def _settle(doc: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray, h: np.ndarray):
    """Of equal segments, the earliest (a mask over the sorted rows) and the
    spans of the others: ``(order, kept, hits)``."""
    o = np.lexsort((start, doc, h, anchor))
    doc, start, size, anchor, h = doc[o], start[o], size[o], anchor[o], h[o]
    new = np.append(True, (h[1:] != h[:-1]) | (anchor[1:] != anchor[:-1])) if len(h) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    hit = ~new & ((doc != doc[lead]) | (start != start[lead]))
    return o, new, _merged(doc[hit], start[hit], start[hit] + size[hit])


_FOUND = "bucket int, kind int, doc_id bigint, n bigint, data binary"
_HIT, _CUT = 1, 2


def _rows(bucket, kind, doc, n, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(doc, pa.int64()),
                                       pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["bucket", "kind", "doc_id", "n", "data"])


def _hit_rows(hits, buckets: int) -> pa.RecordBatch:
    ids, packed = _by_document(*hits)
    return _rows([d % buckets for d in ids], [_HIT] * len(ids), ids, [0] * len(ids), packed)


def _routed(docs: DataFrame, buckets: int, frequent: Frequent) -> DataFrame:
    """Packed segments by anchor bucket (kind 0), and spans settled in the task."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def flush(parts):
        doc, start, size, anchor, h = (np.concatenate(x) for x in zip(*parts))
        o, keep, hits = _settle(doc, start, size, anchor, h)
        yield _hit_rows(hits, buckets)
        o = o[keep]
        bucket = (mix64(anchor[o]) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        o, bucket = o[by], bucket[by]
        at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        packed = []
        for i in np.split(o, at[1:]):
            packed.append(b"".join((anchor[i].tobytes(), h[i].tobytes(), doc[i].tobytes(),
                                    start[i].astype(np.int32).tobytes(), size[i].astype(np.int32).tobytes())))
        yield _rows(bucket[at].tolist(), [0] * len(at), [None] * len(at), [0] * len(at), packed)

    def run(batches):
        parts, held = [], 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for rows, data, off in text_chunks(b):
                row, start, size, anchor, h = segments(data, off, frequent=shared.value)
                if len(row):
                    parts.append((ids[rows][row].astype(np.int64), start, size, anchor, h))
                    held += len(row)
                if held >= _FLUSH:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)

    return docs.mapInArrow(run, _FOUND)


def _met(routed: DataFrame, buckets: int) -> DataFrame:
    """Spans of equal segments, and one copy to cut of every different segment
    whose anchor has several."""
    def run(table):
        kind = table["kind"].to_numpy()
        out = [table.filter(pa.array(kind == _HIT))]
        cols = [[], [], [], [], []]
        for raw in table.filter(pa.array(kind == 0))["data"].to_pylist():
            n = len(raw) // 32
            at = 0
            for c, t in zip(cols, (np.uint64, np.uint64, np.int64, np.int32, np.int32)):
                c.append(np.frombuffer(raw, t, n, at))
                at += n * np.dtype(t).itemsize
        if cols[0]:
            anchor, h, doc, start, size = (np.concatenate(c) for c in cols)
            start, size = start.astype(np.int64), size.astype(np.int64)
            o, keep, hits = _settle(doc, start, size, anchor, h)
            out.append(pa.Table.from_batches([_hit_rows(hits, buckets)]))
            o = o[keep]
            a = anchor[o]
            _, inverse, count = np.unique(a, return_inverse=True, return_counts=True)
            many = count[inverse]
            cut = o[many > 1]
            if len(cut):
                hot = (many[many > 1] > HOT).astype(np.int64)
                ids, packed = _by_document(doc[cut], start[cut], size[cut], anchor[cut].view(np.int64), hot)
                total = [int(np.frombuffer(p, np.int64).reshape(-1, 4)[:, 1].sum()) for p in packed]
                out.append(pa.Table.from_batches([_rows([d % buckets for d in ids], [_CUT] * len(ids), ids, total, packed)]))
        return pa.concat_tables(out)

    return routed.groupBy("bucket").applyInArrow(run, _FOUND)


# ------------------------------------------------------------ run-length index

def suffix_array(t: np.ndarray, stop: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffix array of symbols 0..256, where every 0 ends a string and counts
    as a symbol of its own (earlier ones smaller); also the ranks by the first
    ``k`` symbols for each ``k`` up to ``stop`` that was passed.  Prefix
    doubling from seven packed symbols, sorting only what is still tied."""
    n = len(t)
    padded = np.append(t.astype(np.int64), np.zeros(7, np.int64))
    key, inside = np.zeros(n, np.int64), np.ones(n, dtype=bool)
    for j in range(7):
        symbol = padded[j:j + n] * inside
        key = key * 257 + symbol
        inside &= symbol != 0
    order = np.argsort(key, kind="stable")
    new = np.append(True, (key[order][1:] != key[order][:-1]) | ~inside[order][1:])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, k = {}, 7
    while True:
        if k <= stop:
            ranks[k] = rank.copy()
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            return order, ranks
        p = order[tied]
        key = rank[p] * (n + 1) + rank[p + k]
        o = np.argsort(key)
        key = key[o]
        order[tied] = p[o]
        fresh = np.append(True, key[1:] != key[:-1])
        new[tied] = fresh
        rank[order[tied]] = np.maximum.accumulate(np.where(fresh, tied, 0))
        k *= 2


class RunIndex:
    """Run-compressed BWT of byte strings (in corpus order), with suffix
    positions sampled at both ends of every run, and the classes of suffixes
    that share ``length`` bytes with the first occurrence of each."""

    def __init__(self, strings: list[bytes], length: int = LENGTH):
        self.length = length
        size = np.array([len(s) for s in strings], dtype=np.int64)
        self.start = np.append(0, np.cumsum(size + 1))[:-1]  # of each string in the text
        raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.text = raw.astype(np.int16) + 1
        self.text[self.start + size] = 0
        sa, ranks = suffix_array(self.text, length)
        k = max(ranks)  # the largest power of two within the length
        bwt = self.text[sa - 1]
        self.runs = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))
        self.heads = bwt[self.runs].astype(np.int64)
        ends = np.append(self.runs[1:], len(bwt))
        run_size = ends - self.runs
        by = np.argsort(self.heads, kind="stable")
        self.by_symbol = by  # runs of each symbol, in order; searched by (symbol, run)
        self.by_key = self.heads[by] * (len(self.runs) + 1) + by
        self.symbol_at = np.searchsorted(self.heads[by], np.arange(258))
        total = np.append(0, np.cumsum(np.bincount(bwt, minlength=258)))[:-1]
        through = np.append(0, np.cumsum(run_size[by]))
        self.target = np.empty(len(by), dtype=np.int64)  # LF of each run's first row
        self.target[by] = total[self.heads[by]] + through[:-1] - through[self.symbol_at[self.heads[by]]]
        self.sample_first, self.sample_last, self.last_row = sa[self.runs], sa[ends - 1], ends - 1
        far = np.append(sa + length - k, 0)[:-1]
        inside = sa + length <= len(self.text)
        tail = np.where(inside, ranks[k][np.minimum(far, len(self.text) - 1)], -1)
        head = ranks[k][sa]
        new = np.append(True, (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]) | ~inside[1:])
        self.classes = np.flatnonzero(new)
        self.class_first = np.minimum.reduceat(sa, self.classes)

    def first_occurrence(self, rows: np.ndarray) -> np.ndarray:
        """First text position whose ``length`` bytes equal the row's."""
        return self.class_first[np.searchsorted(self.classes, rows, side="right") - 1]

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common bytes of the suffixes at ``a`` and ``b``, at most ``most``."""
        span = np.arange(self.length)
        end = len(self.text) - 1
        x, y = self.text[np.minimum(a[:, None] + span, end)], self.text[np.minimum(b[:, None] + span, end)]
        differ = (x != y) | (x == 0)
        return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), self.length), most)

    def matching_statistics(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every position of every string, concatenated: ``(row, size,
        position)`` of the longest match of what follows it, sizes capped at
        ``length``.  All strings are streamed backwards together, one symbol a
        step: rows that agree step by LF, others jump to the nearer run of the
        symbol, where the sampled position gives the match's new length."""
        size = np.array([len(s) for s in strings], dtype=np.int64)
        off = np.append(0, np.cumsum(size))
        data = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        out = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        row, match, pos = (np.zeros(len(size), np.int64) for _ in range(3))
        for step in range(1, int(size.max(initial=0)) + 1):
            on = np.flatnonzero(size >= step)
            c = data[off[on + 1] - step]
            r, m, p = row[on], match[on], pos[on]
            run = np.searchsorted(self.runs, r, side="right") - 1
            lo, hi = self.symbol_at[c], self.symbol_at[c + 1]
            jump = np.flatnonzero((self.heads[run] != c) | (m == 0))
            if len(jump):
                runs_of = self.by_symbol
                k = np.searchsorted(self.by_key, c[jump] * (len(self.runs) + 1) + run[jump])
                up, down = k - 1 >= lo[jump], k < hi[jump]
                u = runs_of[np.clip(k - 1, 0, len(runs_of) - 1)]
                d = runs_of[np.clip(k, 0, len(runs_of) - 1)]
                cu = np.where(up, self._common(p[jump], self.sample_last[u], m[jump]), -1)
                cd = np.where(down, self._common(p[jump], self.sample_first[d], m[jump]), -1)
                above = cu >= cd
                run[jump] = np.where(above, u, d)
                r[jump] = np.where(above, self.last_row[u], self.runs[d])
                p[jump] = np.where(above, self.sample_last[u], self.sample_first[d])
                m[jump] = np.maximum(cu, cd)
            known = m >= 0
            r = np.where(known, self.target[run] + r - self.runs[run], 0)
            m = np.where(known, np.minimum(m + 1, self.length), 0)
            p = np.where(known, p - 1, 0)
            row[on], match[on], pos[on] = r, m, p
            for o, v in zip(out, (r, m, p)):
                o[off[on + 1] - step] = v
        return out


def repeats(strings: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """``(string, from, to)``: spans of strings (in corpus order) covered by
    ``length`` bytes that start earlier in this list."""
    index = RunIndex(strings, length)
    row, match, _ = index.matching_statistics(strings)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    which = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    hit = match == length
    hit[hit] = index.first_occurrence(row[hit]) < (index.start[which] + at)[hit]
    s, a, b = _merged(which[hit], at[hit], at[hit] + length)
    return list(zip(s.tolist(), a.tolist(), b.tolist()))


# ------------------------------------------------------------ the operator

def _cut(docs: DataFrame, found: DataFrame, tasks: int) -> DataFrame:
    """The requested segments' bytes, packed by group of anchors."""
    wanted = found.where(f"kind = {_CUT}").groupBy("doc_id").agg(F.collect_list("data").alias("data")).withColumnRenamed("doc_id", "__id")
    rows = docs.join(wanted, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "data")

    def pack(held):
        task, doc, start, pieces = zip(*held)
        o = np.argsort(np.array(task), kind="stable")
        task = np.array(task)[o]
        cuts = np.flatnonzero(np.append(True, task[1:] != task[:-1]))
        data = []
        for part in np.split(o, cuts[1:]):
            text = [pieces[i] for i in part]
            data.append(np.array([len(part)], np.int64).tobytes() + np.array(
                [(doc[i], start[i], len(pieces[i])) for i in part], np.int64).tobytes() + b"".join(text))
        yield pa.RecordBatch.from_arrays([pa.array(task[cuts].astype(np.int32)), pa.array(data, pa.binary())], ["task", "data"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for doc, text, data in zip(*(c.to_pylist() for c in b.columns)):
                raw = text.encode()
                want = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in data])
                group = (mix64(want[:, 2].view(np.uint64)) % np.uint64(tasks)).astype(np.int64)
                for (start, n, _, hot), g in zip(want.tolist(), group.tolist()):
                    piece = raw[start:start + n]
                    if hot:
                        arr = np.frombuffer(piece, np.uint8)
                        _, s, z, a, _ = segments(arr, np.array([0, len(arr)]), LONG_GRAM)
                        key = (mix64(a) % np.uint64(tasks)).astype(np.int64)
                        held += [(k, doc, start + x, piece[x:x + y]) for k, x, y in zip(key.tolist(), s.tolist(), z.tolist())]
                    else:
                        held.append((g, doc, start, piece))
                    size += n + 32
                if size > (16 << 20):
                    yield from pack(held)
                    held, size = [], 0
        if held:
            yield from pack(held)

    return rows.mapInArrow(run, "task int, data binary")


def _indexed(cut: DataFrame) -> DataFrame:
    """Spans of repeats inside each group of cut segments."""
    def run(table):
        keys, texts = [], []
        for raw in table["data"].to_pylist():
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            head = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(-1, 3)
            at = 8 + 24 * n + np.append(0, np.cumsum(head[:, 2]))
            keys.append(head[:, :2])
            texts += [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        key = np.concatenate(keys)
        o = np.lexsort((key[:, 1], key[:, 0]))
        o = o[np.append(True, (key[o][1:] != key[o][:-1]).any(axis=1))]  # a repeated row is cut once
        key = key[o]
        got = np.array(repeats([texts[i] for i in o]), dtype=np.int64).reshape(-1, 3)
        doc, base = key[got[:, 0], 0], key[got[:, 0], 1]
        return pa.Table.from_batches([_hit_rows(_merged(doc, base + got[:, 1], base + got[:, 2]), 1)])

    return cut.groupBy("task").applyInArrow(run, _FOUND)


def _frequent(docs: DataFrame, rows: int) -> Frequent:
    """Anchors that stand in many different segments of a bounded hash sample."""
    if rows > SAMPLE_ROWS:
        docs = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1_000_000)) < int(1_000_000 * SAMPLE_ROWS / rows))

    def run(batches):
        for b in batches:
            for _, data, off in text_chunks(b):
                _, _, _, anchor, h = segments(data, off)
                _, i = np.unique(h, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[i].view(np.int64)), pa.array(h[i].view(np.int64))], ["anchor", "h"])

    got = docs.mapInArrow(run, "anchor bigint, h bigint").groupBy("anchor").agg(
        F.count_distinct("h").alias("n")).where(F.col("n") >= _FREQUENT).orderBy(F.col("n").desc(), "anchor").limit(100_000).collect()
    return Frequent(np.array([r["anchor"] for r in got], dtype=np.int64).view(np.uint64))


def removal_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: packed int64 pairs ``[from, to)`` in UTF-8 bytes,
    possibly overlapping, of every document that has a repeat."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    buckets = max(8, -(-(size or 0) // _TEXT_PER_BUCKET))
    found = written(_met(_routed(spread_rows(docs), buckets, _frequent(docs, rows)), buckets), "segments")
    total = found.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-total // _CUT_PER_TASK))
    more = _indexed(_cut(docs, found, tasks))
    return found.where(f"kind = {_HIT}").unionByName(more).groupBy("doc_id").agg(F.collect_list("data").alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_text)`` of every row:
    ``kept_text`` holds the remaining bytes (binary, as cuts may split a character)."""
    spans = removal_spans(docs).withColumnRenamed("doc_id", "__id")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        spans, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "spans")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = []
                for doc, text, packed in zip(*(c.to_pylist() for c in part.columns)):
                    raw = (text or "").encode()
                    if not packed:
                        out.append((doc, len(raw), 0, 0, raw))
                        continue
                    s = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in packed])
                    _, a, e = _merged(np.zeros(len(s), np.int64), s[:, 0], np.minimum(s[:, 1], len(raw)))
                    kept, last = [], 0
                    for x, y in zip(a.tolist(), e.tolist()):
                        kept.append(raw[last:x])
                        last = y
                    kept = b"".join([*kept, raw[last:]])
                    out.append((doc, len(raw), len(raw) - len(kept), len(a), kept))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text"])

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_text binary")


def digest(docs: DataFrame) -> DataFrame:
    """The contract of op2."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The rule itself, for tests on small inputs."""
    seen: set[bytes] = set()
    out = {}
    for doc in sorted(texts):
        raw = (texts[doc] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
