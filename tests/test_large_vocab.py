"""Vocabularies of any size: join path = regex path, ids, growth, loaders."""

import random

import pytest
from pyspark.sql import functions as F

from tokenledger.functions.tokens import token_string_ids
from tokenledger.functions.vocab import trie_pattern
from tokenledger.operators import match
from tokenledger.operators import vocab as V
from tokenledger.operators.vocab import BoltOn, LargeBoltOn, bolt_on, build_vocab, extend_vocab
from tokenledger.sources import fixtures as fx
from tokenledger.sources.loaders import read_corpus, read_vocab
from tokenledger.sources.rules import reference_rules
from tokenledger.session import scratch_path

import checker

PARTS = ["a", "é", "我", "们", "する", "データ", "x.y", "o", "the", " ", "是", "ab", "ba"]


def generated(n, seed=5):
    rng = random.Random(seed)
    terms = {}
    while len(terms) < n:
        terms.setdefault("".join(rng.choice(PARTS) for _ in range(rng.randint(2, 6))), None)
    return list(terms)


def vocab_frame(spark, terms):
    rows = [(0, i, t, "x") for i, t in enumerate(terms)]
    return build_vocab(spark.createDataFrame(rows, fx.VOCAB_IN_SCHEMA), 336)


def texts(spark, n=40, seed=9):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 700 if i < 2 else 60)))) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None), (n + 1, "")], "doc_id bigint, text string")


def both(spark, vocab, rules):
    t = texts(spark)
    small = BoltOn(tuple(rules), tuple((r["term"], r["token_id"]) for r in vocab.orderBy("token_id").collect()))
    large = LargeBoltOn(tuple(rules), vocab)
    out = []
    for b in (small, large):
        ids = {r["doc_id"]: r["ids"] for r in b.with_token_string(t, ["doc_id"]).select(
            "doc_id", token_string_ids("token_string").alias("ids")).collect()}
        terms = {}
        for r in b.matched(t, ["doc_id"]).collect():
            terms.setdefault((r["doc_id"], r["term"]), 0)
            terms[r["doc_id"], r["term"]] += 1
        out.append((ids, terms))
    return t, out


@pytest.mark.parametrize("n", [437, 2000])
def test_join_path_equals_regex_path(spark, n):
    rules = reference_rules("heavy")
    vocab = build_vocab(fx.vocab_input(spark), 336) if n == 437 else vocab_frame(spark, generated(n))
    t, (small, large) = both(spark, vocab, rules)
    assert small == large
    voc = {r["term"].encode(): r["token_id"] for r in vocab.collect()}
    for r in t.where("text is not null").limit(15).collect():
        assert large[0][r["doc_id"]] == checker.bolt_encode(r["text"], voc, [(x.left, x.right, x.new_id) for x in rules])


@pytest.mark.parametrize("n", [20_000, 100_000])
def test_large_vocabularies_match_the_checker(spark, n, monkeypatch):
    if n == 100_000:
        monkeypatch.setattr(match, "BROADCAST_ENTRIES", 10)  # shuffled join
    rules = reference_rules("heavy")
    vocab = vocab_frame(spark, generated(n))
    b = bolt_on(vocab, rules)
    assert isinstance(b, LargeBoltOn)
    t = texts(spark, 12)
    got = {r["doc_id"]: r["ids"] for r in b.with_token_string(t, ["doc_id"]).select(
        "doc_id", token_string_ids("token_string").alias("ids")).collect()}
    voc = {r["term"].encode(): r["token_id"] for r in vocab.collect()}
    for r in t.collect():
        want = None if r["text"] is None else checker.bolt_encode(
            r["text"], voc, [(x.left, x.right, x.new_id) for x in rules])
        assert got[r["doc_id"]] == want
    counts = {r["doc_id"]: r["n"] for r in b.with_counts(t, ["doc_id"], out="n").collect()}
    assert counts == {k: None if v is None else len(v) for k, v in got.items()}


def test_repeated_and_null_keys_stay_apart(spark):
    """Rows that share a key, or have none, are texts of their own."""
    rules = reference_rules("heavy")
    vocab = build_vocab(fx.vocab_input(spark), 336)
    rows = [(1, "我们 the data"), (1, "je suis plus grand que lui, mais il est dans la commerce"), (1, None), (None, "する"), (None, ""),
            (None, "comme 我们"), (2, ""), (2, "comme")]
    t = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_row", F.lit("own")).drop("_row")
    small, large = BoltOn.from_vocab(vocab, rules), LargeBoltOn(tuple(rules), vocab)
    tokens = lambda b: sorted(map(repr, b.with_token_string(t, ["doc_id"]).select("doc_id", "token_string").collect()))
    assert tokens(small) == tokens(large) and len(tokens(large)) == len(rows)
    counts = lambda b: sorted(map(repr, b.with_counts(t, ["doc_id"], out="n").select("doc_id", "n").collect()))
    assert counts(small) == counts(large)
    terms = lambda b: sorted(map(repr, b.matched(t, ["doc_id"]).collect()))
    assert terms(small) == terms(large) and len(terms(large)) > 8


@pytest.mark.parametrize("n", [437, 20_000])
def test_few_rows_besides_the_real_candidates(spark, n):
    """Positions are filtered in the row: what is exploded is nearly what stands there."""
    vocab = build_vocab(fx.vocab_input(spark), 336) if n == 437 else vocab_frame(spark, generated(n))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("doc_id", "text")
    t = docs.unionByName(texts(spark, 20))
    rows = match.numbered(t, ["doc_id"], "text")
    terms = vocab.select("term", "token_id")
    spots = match.candidates(rows, terms, vocab.count())
    made, real = spots.count(), spots.join(terms, "term").count()
    chars = t.agg(F.sum(F.char_length("text"))).first()[0]
    want = 0
    known = {r["term"] for r in terms.collect()}
    longest = max(map(len, known))
    for r in t.where("text is not null").collect():
        s = r["text"]
        want += sum(s[i:i + k] in known for i in range(len(s)) for k in range(1, min(longest, len(s) - i) + 1))
    assert real == want > 0
    assert made <= 1.1 * real + 0.002 * chars


def test_bloom_filter_misses_nothing(spark):
    values = spark.range(3000).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("v"))
    test = match.bloom(values, "v", 3000)
    assert values.where(~test(F.xxhash64("v"))).count() == 0
    other = spark.range(3000, 43000).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("v"))
    assert other.where(test(F.xxhash64("v"))).count() < 0.02 * 40_000


def test_bolt_on_picks_the_path(spark):
    vocab = build_vocab(fx.vocab_input(spark), 336)
    assert isinstance(bolt_on(vocab, reference_rules("heavy")), BoltOn)
    assert isinstance(bolt_on(vocab, reference_rules("heavy"), regex_entries=100), LargeBoltOn)


def test_ids_follow_list_order_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "_RANK_BLOCK", 7)
    terms = generated(60)
    got = [r["term"] for r in vocab_frame(spark, terms + terms[:5]).orderBy("token_id").collect()]
    assert got == [t for t in terms if len(t.encode()) > 1]


def test_extending_a_vocabulary_skips_known_terms(spark):
    groups = dict(fx.VOCAB_GROUPS)
    table, counts = None, []
    for label in ("ZH-char", "KO-char", "ZH-char", "FR-accent"):
        batch = spark.createDataFrame([(0, i, t, label) for i, t in enumerate(groups[label])], fx.VOCAB_IN_SCHEMA)
        new = build_vocab(batch, 336) if table is None else extend_vocab(table, batch)
        counts.append(new.count())
        table = new if table is None else table.unionByName(new)
    want = checker.vocab([groups["ZH-char"], groups["KO-char"], groups["FR-accent"]], 336)
    assert {r["term"].encode(): r["token_id"] for r in table.collect()} == want
    assert counts[2] == 0 and sum(counts) == len(want)


def test_very_long_entry(spark):
    term = "é" * 5000
    pat = trie_pattern([term, "é" * 3])
    df = spark.createDataFrame([(term + "éé",)], "t string")
    got = df.select(F.regexp_extract_all("t", F.lit(pat), 0).alias("m")).first()["m"]
    assert got == [term]


def test_loaders_round_trip(spark):
    vin = fx.vocab_input(spark)
    for fmt in ("parquet", "csv", "json"):
        path = scratch_path(spark, f"vocab-{fmt}")
        w = vin.write
        (w.option("header", True).option("escape", '"') if fmt == "csv" else w).format(fmt).save(path)
        assert sorted(map(tuple, read_vocab(spark, path, fmt).collect())) == sorted(map(tuple, vin.collect()))
    docs = spark.createDataFrame([(7, "the cat"), (8, "a dog")], "id bigint, body string")
    for fmt in ("parquet", "json"):
        path = scratch_path(spark, f"corpus-{fmt}")
        docs.write.format(fmt).save(path)
        got = read_corpus(spark, path, fmt, text="body", doc_ord="id", source="s", weight=3).orderBy("doc_ord").collect()
        assert [(r["source"], r["doc_ord"], r["weight"], r["text"]) for r in got] == [("s", 7, 3, "the cat"), ("s", 8, 3, "a dog")]
    path = scratch_path(spark, "corpus-text")
    docs.select("body").coalesce(1).write.text(path)
    assert sorted(r["text"] for r in read_corpus(spark, path, "text").collect()) == ["a dog", "the cat"]
    with pytest.raises(ValueError):
        read_corpus(spark, path, "xml")
