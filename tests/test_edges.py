"""Crafted edge inputs (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from tokenledger.functions.text import words
from tokenledger.functions.tokens import apply_rules, encode_ids, token_count, id_to_char, char_to_id
from tokenledger.operators.pairs import pair_counts
from tokenledger.operators.train import Rule, train_bpe
from tokenledger.operators.vocab import BoltOn, build_vocab
from tokenledger.operators.words import word_table
from tokenledger.plans import reports
from tokenledger.sources.fixtures import CORPUS_SCHEMA, VOCAB_IN_SCHEMA


def _one(spark, col, text):
    return spark.createDataFrame([(text,)], "t string").select(col.alias("x")).first()["x"]


def test_merge_is_left_to_right_non_overlapping(spark):
    rules = [Rule(0, 97, 97, 256, 0)]
    assert _one(spark, encode_ids("t", rules), "aaaaa") == [256, 256, 97]
    df = spark.createDataFrame([("aaaaa", 1, 0)], "tok string, freq long, first long")
    assert pair_counts(df, shift=4).first()["n"] == 4


def test_whitespace_classes(spark):
    text = "a\u3000b\u00a0c\u0085d\u001ce\tf\ng\u200bh"
    assert _one(spark, words("t"), text) == ["a", "b", "c", "d", "e", "f", "g\u200bh"]


def test_encode_runs_over_whole_text(spark):
    # U+3000 is E3 80 80: a rule may join it with the character before it,
    # so whitespace other than ASCII must not cut the text before encoding.
    rules = [Rule(0, 165, 227, 256, 0)]
    text = "\u65e5\u3000\u672c"
    assert _one(spark, encode_ids("t", rules), text) == [230, 151, 256, 128, 128, 230, 156, 172]


def test_empty_whitespace_null(spark):
    rules = [Rule(0, 104, 101, 256, 0)]
    df = spark.createDataFrame([("",), (" \t\n",), (None,)], "t string")
    got = [r["n"] for r in df.select(token_count("t", rules).alias("n")).collect()]
    assert got == [0, 3, None]


def test_no_repeated_pair_and_zero_merges(spark):
    df = spark.createDataFrame([("s", 0, 0, 1, "abc xyz")], CORPUS_SCHEMA)
    wt = word_table(df, ["source_ord", "doc_ord"])
    assert train_bpe(wt, 10).rules == []
    assert train_bpe(wt, 0).rules == []


def test_vocab_edge_list(spark):
    terms = ["a", "", "é", "é", "x.y", "mot de passe"]
    vin = spark.createDataFrame([(0, i, t, "L") for i, t in enumerate(terms)], VOCAB_IN_SCHEMA)
    v = build_vocab(vin, 300)
    assert [(r["term"], r["token_id"]) for r in v.orderBy("token_id").collect()] == \
        [("é", 300), ("x.y", 301), ("mot de passe", 302)]
    bolt = BoltOn.from_vocab(v, [])
    assert _one(spark, bolt.matches("t"), "xzy x.y mot de passe") == ["x.y", "mot de passe"]


def test_comme_inside_commerce(spark):
    vin = spark.createDataFrame([(0, 0, "comme", "FR")], VOCAB_IN_SCHEMA)
    bolt = BoltOn.from_vocab(build_vocab(vin, 300), [])
    assert _one(spark, bolt.ids("t"), "commerce") == [300, 114, 99, 101]


def test_first_label_wins(spark):
    vin = spark.createDataFrame([(0, 0, "ab", "first"), (1, 0, "ab", "second"), (1, 1, "cd", "second")],
                                VOCAB_IN_SCHEMA)
    rows = build_vocab(vin, 500).orderBy("token_id").collect()
    assert [(r["term"], r["label"], r["token_id"]) for r in rows] == [("ab", "first", 500), ("cd", "second", 501)]


def test_bolt_on_can_raise_count(spark):
    rules = [Rule(0, 97, 98, 256, 0), Rule(1, 256, 99, 257, 0)]  # abc -> one token
    vin = spark.createDataFrame([(0, 0, "bc", "X")], VOCAB_IN_SCHEMA)
    bolt = BoltOn.from_vocab(build_vocab(vin, 258), rules)
    assert _one(spark, token_count("t", rules), "abc") == 1
    assert _one(spark, bolt.token_count("t"), "abc") == 2
    df = spark.createDataFrame([("xx", 1, 2, 1.0, 2.0)], "lang string, b long, a long, db double, da double")
    red = reports.bolt_reduction(df.select("lang", F.col("b").alias("t")),
                                 df.select("lang", F.col("a").alias("t")), "t", baseline="xx").first()
    assert red["reduction"] == -1 and red["reduction_pct"] is None


def test_nul_byte_and_token_chars(spark):
    assert _one(spark, encode_ids("t", []), "a\x00b") == [97, 0, 98]
    for i in (0, 255, 0xD7FF, 0xD800, 0xE000, 100000):
        assert char_to_id(id_to_char(i)) == i
    rules = [Rule(0, 97, 98, 0xD800, 0)]
    assert _one(spark, encode_ids("t", rules), "abab") == [0xD800, 0xD800]


def test_long_rule_list_uses_fold(spark):
    # more rules than the nested-replace limit: same result through aggregate()
    rules = [Rule(0, 97, 97, 256, 0)] + [Rule(i, 300 + i, 301 + i, 1000 + i, 0) for i in range(1, 260)]
    assert _one(spark, encode_ids("t", rules), "aaaaa") == [256, 256, 97]
    assert _one(spark, apply_rules(F.lit("aaaa"), rules), "") == id_to_char(256) * 2


def test_text_holding_the_barrier_character(spark):
    from tokenledger.functions.vocab import BARRIER
    vin = spark.createDataFrame([(0, 0, "ab", "X")], VOCAB_IN_SCHEMA)
    rules = [Rule(0, 99, 100, 400, 0)]
    bolt = BoltOn.from_vocab(build_vocab(vin, 500), rules)
    text = "xab" + BARRIER + "cdab"
    assert _one(spark, bolt.ids("t"), text) == [120, 500, 244, 143, 191, 189, 400, 500]
    assert _one(spark, bolt.token_count("t"), text) == 8
    assert _one(spark, bolt.token_count("t"), "xabcdab") == 4


def test_rules_parquet_round_trip(spark):
    from tokenledger.operators.train import rules_df
    from tokenledger.session import drop_scratch, scratch_path
    from tokenledger.sources.rules import read_rules, reference_rules, write_rules
    rules = reference_rules("balanced_zh")
    path = scratch_path(spark, "rules-io")
    write_rules(rules_df(spark, rules), path)
    try:
        assert read_rules(spark, path) == rules
    finally:
        drop_scratch(spark, path)
