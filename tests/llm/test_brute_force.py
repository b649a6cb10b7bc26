"""Operators against brute-force versions on whole small tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenledger.llm import (common, decontaminate, fingerprint, linededup, neardup, packing, queries, repeats, tokencount)
from tokenledger.sources.tables import table

from conftest import DOCS, SF0001, SF001


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF0001, "documents").collect()}


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t, n=5):
    w = words(t)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_op1_equals_the_unigram_tokenizer(spark, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers
    pieces = tokencount.read_pieces(tokencount.default_model())
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(split=False, prepend_scheme="always")
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op1_token_counts(spark, SF0001).collect()}
    assert got == {d: len(t.encode(x, add_special_tokens=False).ids) for d, x in texts.items()}
    count, rng = tokencount.Counter(pieces), random.Random(3)
    for _ in range(2000):
        s = "".join(rng.choice("abe  thi\n.,▁é漢🙂<0x41s>的人ing") for _ in range(rng.randint(0, 40)))
        assert count(s)[1] == len(t.encode(s, add_special_tokens=False).ids), repr(s)


def test_op1_ties_take_the_longest_last_piece():
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁", -1.0), ("a▁b", -9.0)]
    count = tokencount.Counter(pieces)
    assert count.viterbi("ab") == (-2.0, 1)
    assert count.viterbi("aba") == (-3.0, 2)
    assert count("a b")[1] == 4  # a piece with U+2581 inside: texts stay whole


@pytest.mark.parametrize("seed", range(6))
def test_op2_random_corpora(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(150, 900))) for _ in range(4)]
    rows = []
    for i in range(40):
        a, b = rng.choice(base), rng.choice(base)
        s = a[rng.randint(0, 60):rng.randint(60, 900)] + b[:rng.randint(0, 300)]
        if rng.random() < 0.5 and len(s) > 5:
            k = rng.randrange(len(s))
            s = s[:k] + rng.choice("xyz") + s[k + 1:]
        rows.append((i * 3 - 5, s if rng.random() < 0.95 else None, "en", "s", 0))
    rows.append((400, "ab" * 300, "en", "s", 0))
    df = spark.createDataFrame(rng.sample(rows, len(rows)), DOCS)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.digest(df).collect()}
    assert got == repeats.brute_force({r[0]: r[1] for r in rows})


def test_op2_hot_anchors_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    rng = random.Random(11)
    p = "".join(rng.choice("abcdefgh ") for _ in range(130))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(80)) + p[:rng.randint(60, 130)] + "".join(
        rng.choice("xyz") for _ in range(60)), "en", "s", 0) for i in range(30)]
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.digest(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == repeats.brute_force({r[0]: r[1] for r in rows})


def test_op2_documents(spark, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op2_suffix_array_dedup(spark, SF0001).collect()}
    assert got == repeats.brute_force(texts)


def test_op2_matching_statistics_of_foreign_strings():
    rng = random.Random(2)
    strs = [bytes(rng.choice(b"abc") for _ in range(rng.randint(20, 90))) for _ in range(10)]
    index = repeats.RunIndex(strs, 20)
    for t in [bytes(rng.choice(b"abcd") for _ in range(30)) + rng.choice(strs)[:25] for _ in range(5)]:
        row, size, _ = index.matching_statistics([t])
        for i in range(len(t)):
            want = max((n for n in range(min(20, len(t) - i) + 1) if any(t[i:i + n] in s for s in strs)), default=0)
            assert size[i] == want
            if want == 20:
                first = min(a + s.find(t[i:i + 20]) for a, s in zip(index.start, strs) if t[i:i + 20] in s)
                assert index.first_occurrence(row[i:i + 1])[0] == first


def test_op2_blocks_of_one_text_agree(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    off = np.array([0, 2000, 2050, 5000])
    whole = repeats.segments(data, off)
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    parts = repeats.segments(data, off)

    def strings(seg):
        return sorted((r, p) for r, s, n in zip(*seg[:3]) for p in range(s, s + n - repeats.LENGTH + 1))

    assert strings(whole) == strings(parts) == sorted(
        (r, p) for r in range(3) for p in range(off[r + 1] - off[r] - repeats.LENGTH + 1))


def test_op3_tokens_and_plan(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_vocabulary())
    rows = queries.op3_best_fit_packing(spark, SF0001).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for d, x in texts.items():
        ids = np.array(t.encode(x, add_special_tokens=False).ids + [0], dtype="<u4")
        got = sorted(by[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in got] == list(range(len(got))) and sum(r["length"] for r in got) == len(ids)
        for r in got:
            assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        assert len(ids) <= 2048 or all(r["length"] == 2048 for r in got[1:])
    ends = collections.Counter()
    for r in rows:
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048
    assert len(ends) <= 1.02 * -(-sum(ends.values()) // 2048) + 1


def test_op3_encoder_on_other_scripts():
    enc = packing.Encoder(packing.default_vocabulary())
    for s in ("", "plain text", "tail <|endoftext|> x", "日本語 🙂", "a\u0085b\x1cc", "Ünï  ß\n\n", "　x"):
        assert enc(s) == enc.exact.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize("rows", [packing.BROADCAST_ROWS, 0])
def test_op3_one_length_in_many_tasks(spark, monkeypatch, rows):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", rows)  # 0: the small tables are joined by shuffle
    docs = spark.range(900).repartition(7).selectExpr("id % 50 AS doc_id", "if(id % 3 = 0, 'one', repeat('a word ', int(id))) AS text")
    got = packing.pack(docs).collect()
    want = packing.token_pieces(docs).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, got)) == sorted(map(key, want))
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for slots in by.values():
        at = 0
        for off, n in sorted(slots):
            assert off == at
            at += n
        assert at <= packing.CAPACITY
    plan = packing.plan_slots(collections.Counter(r["length"] for r in want))
    assert len(by) == max(first + hi - lo for _, lo, hi, first, _ in plan)


@pytest.mark.parametrize("seed", range(20))
def test_op3_plan_equals_piecewise_best_fit(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 37, 100])
    hist = collections.Counter(rng.randint(1, cap) for _ in range(rng.randint(1, 300)))
    plan = packing.plan_slots(dict(hist), cap)
    bins, taken = collections.defaultdict(list), collections.defaultdict(set)
    for length, lo, hi, first, off in plan:
        for k in range(hi - lo):
            bins[first + k].append((off, length))
            assert lo + k not in taken[length]
            taken[length].add(lo + k)
    assert {n: len(v) for n, v in taken.items()} == dict(hist)
    split, width = packing.bucketed(plan, hist)
    assert len(split) <= 3 * len(plan) + len(hist)
    for length, n in hist.items():
        for rank in range(n):
            assert sum(x == length and k == rank // width[length] and lo <= rank < hi for x, k, lo, hi, _, _ in split) == 1
    for slots in bins.values():
        at = 0
        for off, n in sorted(slots):
            assert off == at
            at += n
        assert at <= cap
    rooms = []  # one piece at a time, longest first, tightest bin
    for n in sorted(hist.elements(), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(cap - n)
    assert len(bins) == len(rooms)


def test_op6_rule(spark):
    rows = [(i, "\n".join(["menu", f"own {i}", "  menu ", "" if i % 2 else "shared"]), "en", "big", 0) for i in range(40)]
    rows += [(100 + i, "menu\nx", "en", "small", 0) for i in range(5)] + [(200, None, "en", "big", 0), (201, "menu", "en", None, 0)]
    got = {r["doc_id"]: (r["text"], r["__lines"], r["__dropped"]) for r in linededup.drop_boilerplate(
        spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0] == ("own 0", 4, 3) and got[1] == ("own 1\n", 4, 2)
    assert got[100] == ("menu\nx", 2, 0) and got[200] == (None, 0, 0) and got[201][0] == "menu"


def test_op6_stays_native(spark):
    text = linededup.drop_boilerplate(table(spark, SF0001, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("op", list(queries.ORACLE))
def test_sql(spark, op):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = queries.QUERIES[op](spark, SF001)
    want = con.sql(queries.ORACLE[op])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want.select(*[f'"{c}"' for c in cols]).fetchall())


def test_op7_edits_and_likeness(spark, texts):
    ids = sorted(texts, reverse=True)
    nxt = {d: ids[(i + 1) % len(ids)] for i, d in enumerate(ids)}
    err = []
    for r in queries.op7_document_fingerprints(spark, SF0001).collect():
        t, n = texts[r["doc_id"]], texts[nxt[r["doc_id"]]]
        k = len(t) // 3
        edited = t[:len(t) - k] + n[:k]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
        a, b, c = (shingles(x.lower()) for x in (t, edited, n))
        err.append((abs(r["near_edited"] - len(a & b) / max(1, min(len(a), len(b)))),
                    abs(r["near_next"] - len(a & c) / max(1, min(len(a), len(c))))))
    err = np.array(err)
    assert err.mean(axis=0).max() < 0.05 and err.max() < 0.45


def test_op7_next_document_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", 2)
    ids = [5, 6, 1000, 1001, 1002, 7, -40, 2 ** 40, 8]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id bigint, text string")
    got = {r["doc_id"]: r["next_text"] for r in fingerprint.with_next(df, ["text"]).collect()}
    down = sorted(ids, reverse=True)
    assert got == {d: f"text {down[(i + 1) % len(down)]}" for i, d in enumerate(down)}


def test_op7_sketches_merge_and_stay_native(spark):
    rng = random.Random(4)
    long_ = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(4000))
    part = " ".join(long_.split()[1000:1200])
    df = spark.createDataFrame([(1, long_, part)], "doc_id bigint, a string, b string")
    df = fingerprint.with_sketch(fingerprint.with_sketch(df, "a", "x"), "b", "y")
    out = fingerprint.with_likeness(df, "x", "y", "near")
    assert abs(out.first()["near"] - 1.0) < 1e-9  # all sampled shingles of the part stand in the long text
    plan = queries.op7_document_fingerprints(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op8_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(5)
    s = rng.integers(1, 5, 400)
    s[50:60] = s[90:100] = [4, 4, 1, 2, 3, 1, 1, 2, 4, 3]
    s[200] = 0
    index = decontaminate.FMIndex(s)
    for m in (1, 2, 3, 5, 10):
        ph = np.array([s[i:i + m] for i in range(0, 390, 7) if 0 not in s[i:i + m]])
        lo, hi = index.search(np.hstack([np.zeros((len(ph), 13 - m), int), ph]), np.full(len(ph), m))
        for p, a, b in zip(ph, lo, hi):
            want = [i for i in range(len(s) - m + 1) if (s[i:i + m] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want
    lo, hi = index.search(np.array([[9]]), np.array([1]))
    assert hi[0] == lo[0]


def test_op8_blocks_of_items_agree(spark):
    docs, bench = table(spark, SF0001, "documents"), table(spark, SF0001, "benchmark")
    a = decontaminate.find_spans(docs, bench)
    b = decontaminate.find_spans(docs, bench, block_bytes=2000)
    assert len(decontaminate._blocks(bench, 2000)) > 1
    key = lambda r: r[0]
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_op8_spans_cut_the_text(spark):
    item = " ".join(f"item{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"clean start {item.upper()} clean end"), (2, "nothing here")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_spans(docs, bench).collect()}
    assert got[1]["word_spans"] == [[2, 22]] and got[1]["items"] == ["7"] and got[2]["word_spans"] == []
    text = docs.where("doc_id = 1").first()["text"]
    assert decontaminate.remove_spans(text, got[1]["byte_spans"]) == "clean start  clean end"
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()] == [2]


def components(texts, percent=75):
    sets = {d: shingles(t) for d, t in texts.items()}
    where = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for d, s in sets.items():
        for e, inter in collections.Counter(e for x in s for e in where[x] if e > d).items():
            if 100 * inter >= percent * (len(s) + len(sets[e]) - inter):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_op10_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op10_minhash_near_dedup(spark, SF001).collect()}
    assert got == components(texts)


@pytest.mark.parametrize("block", [1000, 7])
def test_op10_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(6)
    base = [f"w{rng.randrange(500)}" for _ in range(90)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        rows.append((1000 - i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df).collect()}
    assert got == components(dict(rows))


def test_op10_chain_of_copies(spark):
    rng = random.Random(9)
    w = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
    rows = []
    for i in range(25):
        rows.append((i * 7 % 25, " ".join(w)))
        w = w[1:] + [f"n{i}"]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["component_id"] for r in neardup.near_duplicates(df).collect()} == {0}


def test_op10_odd_sketch_estimates():
    rng = np.random.default_rng(3)
    for j in (0.6, 0.75, 0.9):
        common_, own = rng.integers(0, 2 ** 63, int(2000 * j)), rng.integers(0, 2 ** 63, 2 * int(1000 * (1 - j)))
        a = np.unique(np.concatenate([common_, own[:len(own) // 2]])).astype(np.uint64)
        b = np.unique(np.concatenate([common_, own[len(own) // 2:]])).astype(np.uint64)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        m = neardup.minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        s = neardup.odd_sketch(m)
        est = neardup.odd_similarity(np.bitwise_count(s[0] ^ s[1]).sum()[None])[0]
        assert abs(est - true) < 0.15


def test_hash_of_a_span_ignores_its_place():
    data = np.frombuffer(b"abc xabc  abd", np.uint8)
    h = common.span_hash(data, np.array([0, 5, 10, 0]), np.array([3, 8, 13, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def test_op7_far_ids_do_not_crowd_a_range(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", 10)
    ids = [*range(300), 1 << 62, -(1 << 62), *range(10**9, 10**9 + 40)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(None, "none")], "doc_id bigint, text string")
    borders = fingerprint._borders(docs)
    cells = docs.select("doc_id", fingerprint._cell(borders).alias("cell"))
    assert cells.groupBy("cell").count().agg(F.max("count")).first()[0] <= 20
    for r in cells.collect():
        assert r["cell"] == (-1 if r["doc_id"] is None else sum(b <= r["doc_id"] for b in borders))
    want = sorted(ids, reverse=True) + [None]
    follow = dict(zip(want, want[1:] + want[:1]))
    for r in fingerprint.with_next(docs, ["doc_id", "text"]).collect():
        assert r["next_doc_id"] == follow[r["doc_id"]]
