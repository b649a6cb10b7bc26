"""op11 to op13 on odd rows, empty tables, clashing columns and against brute force."""

import hashlib
import math
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenledger.llm import bpe, negatives, search

from conftest import ROWS, SF0001, SF001, clashing, rows_of


# ----------------------------------------------------------------------- op11

def ranked_plainly(docs, items, k=10):
    """Every document scored for every item, one by one."""
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = lambda t: pattern.findall((t or "").translate(lower))
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * c.total() * n_docs) // total
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "three four FIVE six"), (2, None), (3, ""), (None, "seven ünï text"), (4, "word"), (4, "word"), (5, "!? ."), (6, "absent")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_search_odd_rows(spark, odd, items, monkeypatch):
    want = ranked_plainly([(r[0], r[1]) for r in ROWS], ITEMS)
    cols = ["item_id", "rank", "doc_id", "score"]
    assert rows_of(search.search(odd, items), *cols) == want
    assert rows_of(search.search(clashing(odd).repartition(3), clashing(items), block_terms=3), *cols) == want
    monkeypatch.setattr(search, "TASKS", 1)
    assert rows_of(search.search(odd.repartition(5), items), *cols) == want


def test_search_ties_and_k(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (50, "same"), (50, "same"), (60, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    items = spark.createDataFrame([(7, "words same"), (8, "here " * 50)], "item_id bigint, text string")
    for k in (1, 3, 10, 60):
        assert rows_of(search.search(df, items, k=k), "item_id", "rank", "doc_id", "score") == ranked_plainly(
            docs, [(7, "words same"), (8, "here " * 50)], k)


def test_search_empty(spark, odd, empty, items):
    assert search.search(empty, items).collect() == []
    assert search.search(odd, items.limit(0)).collect() == []


def test_search_brute_force_on_a_table(spark):
    docs, bench = spark.read.parquet(f"{SF0001}/documents.parquet"), spark.read.parquet(f"{SF0001}/benchmark.parquet")
    want = ranked_plainly([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    got = search.search(docs.repartition(7), bench, block_terms=300)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == want and len(want) > 300


def test_tiles_stay_exact_below_the_limit():
    rng = np.random.default_rng(5)
    weights = rng.integers(0, 40_000, 300)
    items = [sorted(rng.choice(300, 60, replace=False).tolist()) for _ in range(70)]
    limit = 40_000 * search.IMPACT * 4
    tiles = search.Tiles(items, weights, limit)
    assert len(tiles.parts) > 20 and all((w.sum(1) * search.IMPACT < limit).all() for _, w in tiles.parts)
    doc, at = np.divmod(np.sort(rng.choice(40 * 300, 3000, replace=False)), 300)
    impact = rng.integers(1, search.IMPACT, 3000)
    got = np.concatenate([s for _, s in tiles.scores(doc, at, impact, 40)])
    want = np.zeros((70, 40), dtype=np.int64)
    for i, r in enumerate(items):
        for d, t, x in zip(doc, at, impact):
            if t in r:
                want[i, d] += weights[t] * x
    assert (got == want).all()


# ----------------------------------------------------------------------- op12

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def encoded_by_library(library, text):
    e = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(e, skip_special_tokens=False)
    return (len(e), hashlib.sha256(np.array(e, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


TEXTS = ["", " ", "a<|endoftext|>b<|endoftext|>", "<|endoftext|>", "<|endoftext|", "aaaaaaaaaaaaa", "   \n\n  x", "it's I'LL we've",
         "\x00\x01\x7f", "日本語 한국어 עברית العربية", "🙂👩‍👩‍👧", "  　x \u0085", "ﬁ½²³①Ⅷ", "é́é", "x" * 3001, "ab" * 2000,
         "1234567890 12345", "�￾", "a\r\n\tb"]


def test_bpe_equals_the_library(spark, library, odd):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted(((d, *encoded_by_library(library, t)) for d, t in rows), key=repr)
    assert rows_of(bpe.round_trip(df), *cols) == want
    assert rows_of(bpe.round_trip(clashing(df).repartition(3)), *cols) == want
    assert rows_of(bpe.round_trip(odd), *cols) == sorted(((r[0], *encoded_by_library(library, r[1])) for r in ROWS), key=repr)


def test_bpe_encode_and_decode_tables(spark, library, odd, empty):
    ids = bpe.encode(odd)
    assert rows_of(ids, "doc_id", "ids") == sorted(
        ((r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS), key=repr)
    assert rows_of(bpe.decode(ids), "doc_id", "text") == sorted(((r[0], r[1] or "") for r in ROWS), key=repr)
    some = spark.createDataFrame([(1, [464, 999_999, 50256]), (2, None), (3, []), (4, [168, 120])], "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in bpe.decode(clashing(some.withColumnRenamed("ids", "i")).drop("ids").withColumnRenamed("i", "ids")).collect()}
    assert got == {i: library.decode([x for x in v or [] if x < 50257], skip_special_tokens=False)
                   for i, v in [(1, [464, 50256]), (2, []), (3, []), (4, [168, 120])]}
    for f in (bpe.encode, bpe.round_trip):
        assert f(empty).collect() == []
    assert bpe.decode(ids.limit(0)).collect() == []


def test_bpe_random_words_and_whole_table(spark, library):
    rng = np.random.default_rng(11)
    alphabet = list("ab cdetsrn  '\n.1A") + ["é", "ß", "語", "한", "　"]
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 60)))) for _ in range(20_000)]
    index = bpe.PairIndex(bpe.default_vocabulary())
    got = [np.frombuffer(x, "<u4").tolist() for x in index.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = sorted(((r["doc_id"], *encoded_by_library(library, r["text"])) for r in docs.collect()), key=repr)
    assert rows_of(bpe.round_trip(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_bpe_characters_cut_alike(library):
    """Every character of the fast cutter behaves as in the library's."""
    index = bpe.PairIndex(bpe.default_vocabulary())
    probes = [p for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000 and bpe._AGREED.match(c)
              for p in (f"a{c}1!", f"{c}{c} {c}x", f" {c}  {c}'s")]
    assert len(probes) > 90_000
    for p in probes:
        assert index.pattern.findall(p) == [p[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(p)], p


def test_bpe_words_are_forgotten_without_effect(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    index = bpe.PairIndex(bpe.default_vocabulary())
    for texts in (["one two three four<|endoftext|>"], ["four five six"], ["one <|endoftext|>"]):
        assert [np.frombuffer(x, "<u4").tolist() for x in index.encode(texts)] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


# ----------------------------------------------------------------------- op13

def mined_plainly(rows):
    part = []
    for i, (v, e, label) in enumerate(rows):
        if v is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        part.append((i, v, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for i, v, label, e in part:
        if v % 50:
            continue
        near = sorted((-sum(a * b for a, b in zip(e, f)), w, j, m) for j, w, m, f in part if j != i)
        for s, w, j, _ in [x for x in near if x[3] == label][:5]:
            hits = [x for x in near if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(v, w, r, x[1], -s, -x[0]) for r, x in enumerate(hits, 1)]
    return sorted(out, key=repr)


COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def floats(rows):
    return [(v, None if e is None else [None if x is None else float(np.float32(x)) for x in e], l) for v, e, l in rows]


@pytest.mark.parametrize("fanout,leaf_rows", [(None, None), (4, 8), (2, 1)])
def test_negatives_equal_brute_force(spark, fanout, leaf_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = floats([(i, (centres[i % 6] + rng.normal(size=8) * 0.6).tolist(), int(rng.integers(0, 4))) for i in range(600)])
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(150)]  # copies of one vector: ties, one crowded leaf
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = rows_of(negatives.hard_negatives(df, fanout=fanout, leaf_rows=leaf_rows), *COLS)
    assert got == mined_plainly(rows) and len(got) > 100


def test_negatives_blocks_and_task_groups(spark, monkeypatch):
    df = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    want = mined_plainly([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "TASKS", 1)
    monkeypatch.setattr(negatives, "TILE", 7)
    monkeypatch.setattr(negatives, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(negatives, "SAMPLE", 60)
    assert rows_of(negatives.hard_negatives(df, leaf_rows=20), *COLS) == want


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = floats([(0, [1, 2], 1), (0, [1, 2], 1), (50, [1, 1], 1), (7, [1, 1.5], 0), (14, [0.5, 1], 0), (1, [2, 2], 2), (2, [1, nan], 1),
                   (3, [inf, 1], 1), (4, [1, None], 1), (5, None, 1), (6, [1, 1], None), (None, [1, 1], 1), (8, [], 1), (9, [1], 1),
                   (10, [0.7, 0.9], 2), (10, [0.7, 0.9], 2), (100, [-1, -1], 2), (150, [], 3), (12, [1, 1, 0], 2), (-50, [0.2, 0.3], 1)])
    df = spark.createDataFrame(rows, SCHEMA)
    want = mined_plainly(rows)
    assert rows_of(negatives.hard_negatives(df), *COLS) == want and want
    assert rows_of(negatives.hard_negatives(clashing(df.withColumn("tasks", F.lit(1))).repartition(3), fanout=2, leaf_rows=1), *COLS) == want
    assert negatives.hard_negatives(df.limit(0)).collect() == []
    assert negatives.hard_negatives(df.where("embedding is null")).collect() == []


def test_negatives_large_components_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = floats([(i, (rng.normal(size=4) * 1e6).tolist(), i % 3) for i in range(200)])
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(negatives.hard_negatives(df, fanout=3, leaf_rows=10), *COLS) == mined_plainly(rows)


def test_subtrees_are_passed_over():
    """Annuli around clustered anchors leave most leaves out, and none with a wanted row."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 100
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 5)
    tree = negatives.Tree(x[:1000], 4000, 8, 100)
    leaf = tree.leaves(x)
    ranges, norms = {}, {}
    for k in np.unique(leaf):
        part = x[leaf == k]
        norms[k] = ((part * part).sum(1).min(), (part * part).sum(1).max())
        for node, branch in tree.paths[k]:
            d = negatives.distances(part, tree.nodes[node].points)
            old = ranges.get((node, branch), (np.inf, -np.inf))
            ranges[node, branch] = np.minimum(old[0], d.min(0)), np.maximum(old[1], d.max(0))
    probe = negatives.Probe(x[:50], tree, ranges, norms)
    s = x[:50] @ x.T
    high = s.max(1)
    low = 0.97 * high
    concerned = 0
    for k in np.unique(leaf):
        alive = probe.concerned(k, low, high)
        concerned += len(alive)
        wanted = ((s[:, leaf == k] >= low[:, None]) & (s[:, leaf == k] <= high[:, None])).any(1)
        assert set(np.flatnonzero(wanted)) <= set(alive)
    assert concerned < 0.35 * 50 * len(np.unique(leaf))
