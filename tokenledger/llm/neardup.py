"""Near-duplicates: banded MinHash candidates, odd-sketch screening, exact links.

1. One Arrow pass turns each text into its set of 5-word shingles and keeps
   only fixed-size parts: set size, a 128-bit digest of the set, ``BANDS``
   band keys and an odd sketch (the MinHash samples folded into a parity
   bitmap; the population count of two bitmaps' XOR estimates how many samples
   differ).  Documents with equal sets form a class by the digest, and only
   the smallest id of a class goes on, so a group of exact copies costs one
   row per task.
2. Every band bucket links its members to its smallest member (a star, never
   all pairs).  Pairs whose sketches cannot belong to a similarity of 0.75 are
   dropped, the others are confirmed on the full shingle sets of both texts,
   and the confirmed links are contracted to components by alternating large
   and small stars, written between rounds.
3. A bucket whose members then still lie in several components may hide
   further links.  Its members outside its largest component are compared, on
   full sets, with that component and with each other: both sides are cut into
   blocks of at most about ``BLOCK`` rows, every task holds one block of each,
   and only links that join further components leave it.  Pairs inside one
   component need no test, as they cannot change the result.

A link of similarity 0.75 misses all bands with probability 5e-6, and the
sketch screen drops it with one below 1e-6; above 0.75 both fall quickly.

Defined cases: a text without words, or null, has an empty set and links with
nothing; with fewer than five words the whole sequence is the one shingle;
rows that share a doc_id stand for one document, which links where any of its
texts does; a null doc_id keeps its row, with a null component; repeated rows
repeat in the result; other columns pass through or are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from tokenledger.llm.common import (LOWER, NOT_SPACE, free_names, giving_back, mix64, span_hash, spread_rows, text_chunks, word_spans, written)

WORDS = 5
BANDS, BAND_ROWS = 32, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 1024
#: Estimates below this are dropped before the exact test: about six standard
#: deviations under a similarity of 0.75.
SCREEN = 0.53
#: Rows, and shingles in all, of a block of stage 3.
BLOCK = 1000
BLOCK_SHINGLES = 1 << 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MUL = mix64(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix64(np.arange(1001, SAMPLES + 1001, dtype=np.uint64))


def shingle_hashes(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and their row offsets."""
    s, e, w = word_spans(data, off, NOT_SPACE)
    n = np.diff(w)
    h = span_hash(LOWER[data], s, e)
    rows = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(h)) - w[rows]
    take = np.minimum(n, words)[rows]  # shingle length in this row
    start = np.flatnonzero(at + take <= n[rows])
    acc = np.zeros(len(start), dtype=np.uint64)
    for k in range(words):
        part = k < take[start]
        acc[part] = mix64(acc[part] * _PRIME + h[start[part] + k])
    r = rows[start]
    order = np.lexsort((acc, r))
    r, acc = r[order], acc[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (acc[1:] != acc[:-1])
    r, acc = r[new], acc[new]
    return acc, np.searchsorted(r, np.arange(len(n) + 1))


def minhash(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima per row (rows must not be empty)."""
    out = np.empty((len(off) - 1, SAMPLES), dtype=np.uint64)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat(h * _MUL[i] + _ADD[i], off[:-1])
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    out = np.empty((len(samples), BANDS), dtype=np.uint64)
    for j in range(BANDS):
        acc = np.full(len(samples), j + 1, dtype=np.uint64)
        for v in samples[:, j * BAND_ROWS:(j + 1) * BAND_ROWS].T:
            acc = mix64(acc * _PRIME + v)
        out[:, j] = acc
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows x SKETCH_BITS / 8 bytes) of the samples."""
    n = len(samples)
    bit = (mix64(samples + _ADD[None, :] * _PRIME) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flat = (np.arange(n)[:, None] * SKETCH_BITS + bit).ravel()
    return np.packbits((np.bincount(flat, minlength=n * SKETCH_BITS) & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)


def odd_similarity(differing_bits: np.ndarray) -> np.ndarray:
    """Similarity estimate from the population count of two sketches' XOR."""
    x = np.minimum(differing_bits, SKETCH_BITS // 2 - 1) / SKETCH_BITS
    differ = -SKETCH_BITS / 2 * np.log1p(-2 * x)
    return 1 - differ / (2 * SAMPLES)


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, k1, k2, bands, sketch)`` of every row."""
    def run(batches):
        for b in batches:
            for rows, data, off in text_chunks(b):
                h, so = shingle_hashes(data, off)
                n = np.diff(so)
                some = np.flatnonzero(n)
                k1 = np.zeros(len(n), np.uint64)
                k2 = np.zeros(len(n), np.uint64)
                keys = np.zeros((len(n), BANDS), np.uint64)
                sketch = np.zeros((len(n), SKETCH_BITS // 8), np.uint8)
                if len(some):
                    at = np.append(so[:-1][some], len(h))
                    k1[some] = np.add.reduceat(mix64(h + _PRIME), at[:-1])
                    k2[some] = np.add.reduceat(mix64(h ^ _PRIME), at[:-1])
                    m = minhash(h, at)
                    keys[some], sketch[some] = band_keys(m), odd_sketch(m)
                lists = np.append(0, np.cumsum(np.where(n > 0, BANDS, 0)))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(rows.start, len(n)), pa.array(n.astype(np.int64)),
                    pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(keys[n > 0].ravel().view(np.int64))),
                    pa.array([x.tobytes() if c else None for x, c in zip(sketch, n)], pa.binary())],
                    ["doc_id", "n", "k1", "k2", "bands", "sketch"])

    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return src.mapInArrow(giving_back(run), "doc_id bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>, sketch binary")


def _screened(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``(a, b)`` pairs whose sketches allow a similarity of 0.75."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
                ok = odd_similarity(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)) >= SCREEN
                yield b.select([0, 1]).filter(pa.array(ok))

    one = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    two = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(giving_back(run), "a bigint, b bigint")


def _confirmed(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``(a, b, linked)``: the exact test on full shingle sets."""
    percent = round(similarity * 100)

    def run(batches):
        for b in batches:
            at = 0
            both = sum(b.column(i).nbytes for i in (2, 3))
            step = max(1, int(b.num_rows * (4 << 20) / max(both, 1)))
            while at < b.num_rows:
                part = b.slice(at, step)
                at += step
                sets = []
                for i in (2, 3):
                    col = pa.RecordBatch.from_arrays([part.column(i)], ["text"])
                    got = [shingle_hashes(d, o) for _, d, o in text_chunks(col, chunk_bytes=1 << 40, chunk_rows=1 << 40)]
                    sets.append(got[0])
                rows = np.concatenate([np.repeat(np.arange(part.num_rows), np.diff(o)) for _, o in sets])
                h = np.concatenate([x for x, _ in sets])
                order = np.lexsort((h, rows))
                r, h = rows[order], h[order]
                same = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
                inter = np.bincount(r[1:][same], minlength=part.num_rows)
                union = sum(np.diff(o) for _, o in sets) - inter
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(100 * inter >= percent * union)],
                                                 ["a", "b", "linked"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(
        run, "a bigint, b bigint, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for the nodes of ``edges(a, b)``: comp is the smallest
    node reachable.  Alternating large and small stars; every round is a
    partial aggregate and a join on the node, written once."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    state = None
    while True:
        both = e.union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").where("u <> v").distinct(), "stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select("v", "v").distinct())


def _labels(members: DataFrame, comps: DataFrame) -> DataFrame:
    return members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _arenas(buckets: DataFrame, comps: DataFrame, sizes: DataFrame) -> DataFrame:
    """What is left to compare, as rows ``(arena, block, part, node, comp,
    probe)``: the members of mixed buckets outside the bucket's largest
    component (probes) meet that component and each other."""
    lab = _labels(buckets, comps)
    mixed = lab.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key")
    big = comps.groupBy("comp").agg(F.count("*").alias("members"))
    lab = written(lab.join(mixed, "key").join(big, "comp", "left").select("key", "node", "comp", F.coalesce("members", F.lit(1)).alias("members")), "mixed")
    main = lab.groupBy("key").agg(F.max(F.struct("members", (-F.col("comp")).alias("low"))).alias("m")).select(
        "key", (-F.col("m.low")).alias("arena"))
    probes = written(lab.join(main, "key").where("comp <> arena").select("arena", "node", "comp").distinct().join(sizes, "node"), "probes")
    arenas = probes.select(F.col("arena").alias("comp")).distinct()
    held = _labels(sizes, comps).join(arenas, "comp").select(F.col("comp").alias("arena"), "node", "comp", "n")
    every = held.unionByName(probes.select("arena", "node", "comp", "n")).distinct()

    def count(rows: DataFrame, name: str) -> DataFrame:
        need = F.greatest(F.count("*") / F.lit(float(BLOCK)), F.sum("n") / F.lit(float(BLOCK_SHINGLES)))
        return rows.groupBy("arena").agg(F.greatest(F.ceil(need), F.lit(1)).cast("int").alias(name))

    shape = written(count(every, "blocks").join(count(probes, "parts"), "arena"), "shape")
    deal = lambda seed, k: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(k)).cast("int")
    upto = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    one = every.join(shape, "arena").select("arena", deal(1, "blocks").alias("block"), upto("parts").alias("part"),
                                            "node", "comp", F.lit(False).alias("probe"))
    two = probes.join(shape, "arena").select("arena", upto("blocks").alias("block"), deal(2, "parts").alias("part"),
                                             "node", "comp", F.lit(True).alias("probe"))
    return written(one.unionByName(two), "arenas")


def _rest(arenas: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Confirmed links ``(a, b)`` across components inside the blocks: exact
    tests by an inverted index of the block's shingles, of which only those
    that join further components leave the task."""
    percent = round(similarity * 100)

    def run(table):
        found_a, found_b = [], []
        arena, node, comp, probe = (table[c].to_numpy() for c in ("arena", "node", "comp", "probe"))
        text = pa.RecordBatch.from_arrays([table["text"].combine_chunks()], ["text"])
        parts = [shingle_hashes(d, o) for _, d, o in text_chunks(text)]
        sizes = np.concatenate([np.diff(o) for _, o in parts])
        h = np.concatenate([x for x, _ in parts])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        # arenas of a task are kept apart by a hash of shingle and arena
        h = mix64(h + mix64(arena.view(np.uint64))[owner] * _PRIME)
        at = np.append(0, np.cumsum(sizes))
        mine = ~probe[owner]
        order = np.argsort(h[mine], kind="stable")
        index, posting = h[mine][order], owner[mine][order]
        root = {int(c): int(c) for c in set(comp.tolist())}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for i in np.flatnonzero(probe):
            own = h[at[i]:at[i + 1]]
            lo, hi = np.searchsorted(index, own, "left"), np.searchsorted(index, own, "right")
            n = hi - lo
            if not n.any():
                continue
            where = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            other, inter = np.unique(posting[where], return_counts=True)
            hit = other[100 * inter >= percent * (sizes[i] + sizes[other] - inter)]
            for j in hit[comp[hit] != comp[i]]:
                x, y = find(int(comp[i])), find(int(comp[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found_a.append(int(node[i]))
                    found_b.append(int(node[j]))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    # small arenas share tasks of about BLOCK / 2 rows
    bins = max(1, arenas.count() // (BLOCK // 2))
    small = F.when((F.col("blocks") == 1) & (F.col("parts") == 1), F.pmod(F.xxhash64("arena"), F.lit(bins))).otherwise(F.col("arena"))
    counted = arenas.groupBy("arena").agg((F.max("block") + 1).alias("blocks"), (F.max("part") + 1).alias("parts"))
    rows = arenas.join(counted, "arena").withColumn("bin", small).withColumn("alone", (F.col("blocks") > 1) | (F.col("parts") > 1))
    return rows.join(texts, "node").select("bin", "alone", "block", "part", "arena", "node", "comp", "probe", "text").groupBy(
        "bin", "alone", "block", "part").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row."""
    sig = written(signatures(docs), "signatures")
    full = sig.where("n > 0 and doc_id is not null")
    classes = full.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    classes = written(classes, "classes")
    reps = full.join(classes.withColumnRenamed("node", "doc_id"), ["k1", "k2", "doc_id"]).withColumnRenamed("doc_id", "node")
    member = reps.select("node", F.explode("bands").alias("key"))
    crowd = member.groupBy("key").agg(F.min("node").alias("c"), F.max("node").alias("d")).where("c <> d")
    buckets = written(member.join(crowd.select("key", F.col("c").alias("center")), "key").distinct(), "buckets")
    near = buckets.select("node").distinct()
    sketches = written(reps.select("node", "n", "sketch").join(near, "node"), "sketches")
    texts = written(docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").join(near, "node"), "texts")
    pairs = buckets.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    tested = written(_confirmed(_screened(pairs, sketches), texts, similarity), "tested")
    edges = tested.where("linked").select("a", "b")
    comps = components(edges)
    arenas = _arenas(buckets.select("key", "node"), comps, sketches.select("node", "n").distinct())
    found = written(_rest(arenas, texts, similarity), "found")
    if not found.isEmpty():
        comps = components(edges.union(found))
    final = _labels(classes, comps).groupBy("k1", "k2").agg(F.min("comp").alias("comp"))
    out = sig.join(final, ["k1", "k2"], "left")
    comp = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """One document of each near-duplicate group (the smallest doc_id), with
    the input's own columns.  Rows that repeat a kept doc_id are one document
    and stay as they are."""
    name = free_names(docs, "__gone")[0]
    gone = near_duplicates(docs, similarity).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == F.col(name), "left_anti")
