"""Randomised agreement between the Spark operators and the tiny checker."""

import random

from pyspark.sql import functions as F

from tokenledger.functions.text import utf8_bytes, words
from tokenledger.functions.tokens import encode_ids, token_count
from tokenledger.functions.vocab import trie_pattern, flat_pattern
from tokenledger.operators import encode as enc
from tokenledger.operators.train import Candidate, select_batch, train_bpe
from tokenledger.operators.vocab import BoltOn, build_vocab
from tokenledger.operators.words import word_table
from tokenledger.sources.fixtures import CORPUS_SCHEMA, VOCAB_IN_SCHEMA
from tokenledger.sources.rules import reference_rules

import checker

ALPHABET = ["a", "b", "ab", "aaaa", "\u00e9", "\u65e5\u672c", "\u3000", " ", "\u001c", "\u00a0",
            "\t", "\n", "\U0001F600", "x", "\u30e6\u30fc\u30b6\u30fc", "comme", "\u200b", "\u0085"]


def rand_text(rng, n=12):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, n)))


def test_whitespace_split_matches_python(spark):
    rng = random.Random(1)
    texts = [rand_text(rng) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: r["w"] for r in df.select("id", words("t").alias("w")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == t.split(), repr(t)


def test_bytes_and_encode_match_checker(spark):
    rng = random.Random(2)
    rules = reference_rules("heavy")
    texts = [rand_text(rng, 20) for _ in range(300)] + ["aaaaa", "", "\x00a\x00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = df.select("id", utf8_bytes("t").alias("b"), encode_ids("t", rules).alias("ids"),
                     token_count("t", rules).alias("n")).collect()
    for r in rows:
        t = texts[r["id"]]
        assert r["b"] == list(t.encode("utf-8"))
        assert r["ids"] == checker.encode(t, [(x.left, x.right, x.new_id) for x in rules])
        assert r["n"] == len(r["ids"])


def test_dedup_encode_equals_direct(spark):
    rng = random.Random(3)
    rules = reference_rules("heavy")
    rows = [(rng.choice(["x", "y"]), rand_text(rng, 30)) for _ in range(200)]
    df = spark.createDataFrame(rows, "lang string, text string")
    a = sorted(map(tuple, enc.tokens_by_key(df, rules, ["lang"]).collect()))
    b = sorted(map(tuple, enc.tokens_by_key_dedup(df, rules, ["lang"]).collect()))
    assert a == b


def test_bolt_on_matches_checker(spark):
    rng = random.Random(4)
    rules = reference_rules("heavy")
    groups = [["ab", "aaaa", "é", "日本", "本", "comme", "commerce", "x.y", "mot de passe", "ユー"],
              ["a", "", "é", "ザー", "\U0001F600", "a a"]]
    vin = spark.createDataFrame([(g, i, t, f"L{g}") for g, terms in enumerate(groups)
                                 for i, t in enumerate(terms)], VOCAB_IN_SCHEMA)
    bolt = BoltOn.from_vocab(build_vocab(vin, 336), rules)
    voc = checker.vocab(groups, 336)
    assert dict((t.encode(), i) for t, i in bolt.entries) == voc
    texts = [rand_text(rng, 20) for _ in range(300)] + ["commerce", "xzy x.y", "mot de passe!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    triples = [(x.left, x.right, x.new_id) for x in rules]
    for r in df.select("id", bolt.ids("t").alias("ids"), bolt.token_count("t").alias("n")).collect():
        want = checker.bolt_encode(texts[r["id"]], voc, triples)
        assert r["ids"] == want, repr(texts[r["id"]])
        assert r["n"] == len(want)


def test_trie_and_flat_patterns_agree(spark):
    terms = ["ab", "abc", "abcd", "b", "bc", "x.y", "a b", "日本", "日"]
    df = spark.createDataFrame([("abcabcdxabcex.yxzy a b日本日",)], "t string")
    r = df.select(F.regexp_extract_all("t", F.lit(trie_pattern(terms)), 0).alias("a"),
                  F.regexp_extract_all("t", F.lit(flat_pattern(terms)), 0).alias("b")).first()
    assert r["a"] == r["b"] == ["abc", "abcd", "abc", "x.y", "a b", "日本", "日"]


def test_batched_training_equals_one_by_one_and_checker(spark):
    rng = random.Random(5)
    for trial in range(3):
        texts = [(" ".join(rng.choice(["aab", "abab", "aaaa", "ba", "bb", "abc", "日本", "cab"])
                           for _ in range(rng.randint(3, 12))), rng.randint(1, 3))
                 for _ in range(rng.randint(1, 3))]
        df = spark.createDataFrame([("s", i, 0, w, t) for i, (t, w) in enumerate(texts)], CORPUS_SCHEMA)
        wt = word_table(df, ["source_ord", "doc_ord"])
        batched = train_bpe(wt, 12, fetch=4)
        single = train_bpe(wt, 12, batched=False)
        want = checker.train(texts, 12)
        got = [(r.left, r.right, r.new_id, r.n) for r in batched.rules]
        assert got == want, (trial, texts)
        assert single.rules == batched.rules


def test_weights_equal_replication(spark):
    text = "abab aab ba abab cab"
    weighted = spark.createDataFrame([("s", 0, 0, 3, text)], CORPUS_SCHEMA)
    copied = spark.createDataFrame([("s", 0, i, 1, text) for i in range(3)], CORPUS_SCHEMA)
    a = train_bpe(word_table(weighted, ["source_ord", "doc_ord"]), 6).rules
    b = train_bpe(word_table(copied, ["source_ord", "doc_ord"]), 6).rules
    assert a == b


def test_select_batch_rules():
    c = Candidate
    # pairs that share no token, strictly falling counts: one batch
    assert select_batch([c(1, 2, 9), c(3, 4, 8), c(5, 6, 7), c(9, 1, 1)], 10, False) == \
        [c(1, 2, 9), c(3, 4, 8), c(5, 6, 7)]
    # same-side sharing is allowed: (1,2) and (1,4) cannot take each other's tokens
    assert select_batch([c(1, 2, 9), c(1, 4, 8), c(3, 2, 7), c(8, 9, 1)], 10, False) == \
        [c(1, 2, 9), c(1, 4, 8), c(3, 2, 7)]
    # opposite-side sharing ends the prefix; a generator tying the last count cuts back
    assert select_batch([c(1, 2, 9), c(3, 4, 8), c(4, 7, 8)], 10, False) == [c(1, 2, 9)]
    assert select_batch([c(1, 2, 9), c(3, 4, 8), c(2, 7, 5), c(8, 9, 1)], 10, False) == \
        [c(1, 2, 9), c(3, 4, 8)]
    # a self-pair first goes alone; later it ends the prefix
    assert select_batch([c(1, 1, 9), c(3, 4, 8), c(5, 6, 1)], 10, True) == [c(1, 1, 9)]
    assert select_batch([c(1, 2, 9), c(3, 3, 8), c(5, 6, 1)], 10, True) == [c(1, 2, 9)]
    # unknown pairs beyond a partial list bound the batch; a complete list does not
    assert select_batch([c(1, 2, 9), c(3, 4, 9)], 10, False) == [c(1, 2, 9)]
    assert select_batch([c(1, 2, 9), c(3, 4, 9)], 10, True) == [c(1, 2, 9), c(3, 4, 9)]
    assert select_batch([c(1, 2, 9), c(3, 4, 8)], 1, True) == [c(1, 2, 9)]


def _python_batched(corpus, num_merges, fetch):
    """The batching rule driven by exact Python counts (no Spark)."""
    seqs = [(list(w.encode("utf-8")), wt) for text, wt in corpus for w in text.split()]
    rules, new = [], 256
    while len(rules) < num_merges:
        counts, first = {}, {}
        for wi, (seq, wt) in enumerate(seqs):
            for i, p in enumerate(zip(seq, seq[1:])):
                counts[p] = counts.get(p, 0) + wt
                first.setdefault(p, (wi, i))
        ranked = sorted((p for p in counts if counts[p] >= 2), key=lambda p: (-counts[p], first[p]))
        if not ranked:
            break
        top = [Candidate(a, b, counts[(a, b)]) for a, b in ranked[:fetch]]
        batch = select_batch(top, num_merges - len(rules), complete=len(ranked) <= fetch)
        for cand in batch:
            seqs = [(checker.merge(seq, cand.left, cand.right, new), wt) for seq, wt in seqs]
            rules.append((cand.left, cand.right, new, cand.n))
            new += 1
    return rules


def test_batching_rule_equals_one_by_one_on_many_corpora():
    rng = random.Random(11)
    pieces = ["ab", "ba", "abab", "aab", "abb", "bba", "cab", "abc", "aaaa", "bbb", "ca", "ac",
              "xyz", "zyx", "\u65e5\u672c", "\u00e9t\u00e9"]
    for trial in range(400):
        corpus = [(" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))), rng.randint(1, 4))
                  for _ in range(rng.randint(1, 4))]
        merges = rng.randint(1, 25)
        fetch = rng.choice([2, 3, 4, 8, 64])
        assert _python_batched(corpus, merges, fetch) == checker.train(corpus, merges), (trial, corpus)


def test_dispatched_trie_equals_flat_alternation_on_wide_vocabularies(spark):
    rng = random.Random(21)
    alphabet = list("abcdefghijklmnop") + [chr(c) for c in range(0x3041, 0x3061)] + \
        [chr(c) for c in range(0x4E00, 0x4E20)] + ["é", "è", "\U0001F600", ".", " ", "-"]
    terms = {"".join(rng.choice(alphabet) for _ in range(rng.randint(2, 5))) for _ in range(300)}
    terms |= {t[:2] for t in list(terms)[:60]}  # shared prefixes: optional continuations
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = df.select("id", F.regexp_extract_all("t", F.lit(trie_pattern(terms)), 0).alias("a"),
                    F.regexp_extract_all("t", F.lit(flat_pattern(terms)), 0).alias("b")).collect()
    for r in got:
        assert r["a"] == r["b"], texts[r["id"]]
