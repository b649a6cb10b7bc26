"""One automaton for all variants: the same counts, ids and matches as the regex path."""

import random

import pytest
from pyspark.sql import functions as F

from tokenledger.functions.tokens import token_string_ids, token_string_to_ids
from tokenledger.functions.vocab import BARRIER
from tokenledger.operators import scan as sc
from tokenledger.operators.vocab import BoltOn, build_vocab
from tokenledger.plans import queries as Q
from tokenledger.sources import fixtures as fx
from tokenledger.sources.rules import reference_rules

import checker
from conftest import SF0001
from test_large_vocab import generated, texts, vocab_frame


def rules():
    return reference_rules("heavy")


def test_scanner_equals_the_checker():
    rng = random.Random(4)
    triples = [(r.left, r.right, r.new_id) for r in rules()]
    alphabet = ["a", "é", "我", "们", "the", " ", "x", BARRIER, "aa", "\n"]
    for _ in range(40):
        terms = list(dict.fromkeys("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 9))))
        terms = [t for t in terms if len(t.encode()) > 1]
        parts = [[(t, 336 + i) for i, t in enumerate(terms) if rng.random() < p] for p in (1, 0.5, 0.3)]
        scan = sc.Scanner(parts, rules())
        for _ in range(10):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
            want = [checker.bolt_encode(text, {t.encode(): i for t, i in p}, triples) for p in parts]
            assert scan.counts(text) == [len(checker.encode(text, triples)), *map(len, want)]
            assert [token_string_to_ids(scan.token_string(text, v)) for v in range(3)] == want


@pytest.mark.parametrize("n", [437, 20_000])
def test_scan_equals_the_regex_path(spark, n):
    vocab = build_vocab(fx.vocab_input(spark), 336) if n == 437 else vocab_frame(spark, generated(n))
    t = texts(spark).union(spark.createDataFrame([(1, "the 我们 data"), (None, "是是"), (None, None)], "doc_id bigint, text string"))
    scan = sc.scan_of(vocab, rules())
    ids = sorted(map(repr, scan.with_token_string(t, out="t").select("doc_id", token_string_ids("t").alias("ids")).collect()))
    counts = sorted(map(repr, scan.with_counts(t, out="n").select("doc_id", "n").collect()))
    if n == 437:
        small = BoltOn.from_vocab(vocab, rules())
        assert ids == sorted(map(repr, t.select("doc_id", small.ids("text").alias("ids")).collect()))
        assert counts == sorted(map(repr, t.select("doc_id", F.col("doc_id").isNull().alias("x"), small.token_count("text").cast(
            "bigint").alias("n")).select("doc_id", "n").collect()))
        assert sorted(map(tuple, scan.matched(t.where("doc_id is not null"), ["doc_id"]).collect())) == sorted(
            map(tuple, small.matched(t.where("doc_id is not null"), ["doc_id"]).collect()))
    else:
        voc = {r["term"].encode(): r["token_id"] for r in vocab.collect()}
        triples = [(x.left, x.right, x.new_id) for x in rules()]
        want = [(r["doc_id"], None if r["text"] is None else checker.bolt_encode(r["text"], voc, triples)) for r in t.limit(14).collect()]
        got = scan.with_token_string(t.limit(14), out="t").select("doc_id", token_string_ids("t").alias("ids")).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_scan_serves_all_variants(spark, monkeypatch):
    scan = sc.Scanner([[("ab", 300), ("abc", 301)], [("ab", 300)], [("abc", 300)], []], rules())
    calls = []
    real = sc.Scanner.found
    monkeypatch.setattr(sc.Scanner, "found", lambda self, t: calls.append(t) or real(self, t))
    # base a b c; longest entry; the shorter one and c; longest; none
    assert scan.counts("abc") == [3, 1, 2, 1, 3] and calls == ["abc"]
    text = Q.QUERIES["variant_counts"](spark, SF0001)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan parquet") == 1 and text.count("MapInArrow") == 1 and "regexp" not in text


def test_keeps_columns_and_rejects_what_it_cannot_hold(spark, monkeypatch):
    df = spark.createDataFrame([(1, "ab", "x", 5)], "id int, text string, base string, _m int")
    scan = sc.VariantScan((), {"v": (("ab", 300),), "w": ()})
    assert scan.counts(df.drop("base")).collect()[0].asDict() == {"id": 1, "text": "ab", "_m": 5, "base": 2, "v": 1, "w": 2}
    assert scan.counts(df).collect()[0]["base"] == 2 and scan.counts(df.limit(0)).collect() == []
    monkeypatch.setattr(sc, "SCAN_ENTRIES", 0)
    with pytest.raises(ValueError):
        sc.VariantScan((), {"v": (("ab", 300),)})
    with pytest.raises(ValueError):
        sc.scan_of(spark.createDataFrame([("ab", 300)], "term string, token_id int"), rules())


def test_large_vocabulary_on_a_stream(spark, tmp_path):
    """20,000 entries on a file stream, stopped and started again, equal the batch."""
    from tokenledger.streaming import encode_stream as es

    scan = sc.scan_of(vocab_frame(spark, generated(20_000)), rules())
    t = texts(spark, 30).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("bigint"))
    for i in range(2):
        t.where(f"doc_id % 2 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = es.stream_bolt_tokens(es.read_documents_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1), scan)
        es.write_available(stream, str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "bolt_tokens")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, scan.with_counts(t).select("doc_id", "bolt_tokens").collect()))


def test_used_ids_by_bitmaps(spark):
    """Distinct ids over many tasks, also beyond one bitmap, equal a plain count."""
    far = (("the", 40_000), ("我们", 70_000), ("data", 70_001))
    scan = sc.VariantScan(tuple(rules()), {"far": far, "none": (), "one": (("the", 400),)})
    t = texts(spark).union(spark.createDataFrame([(None, "the data"), (1, "我们 the")], "doc_id bigint, text string")).repartition(5)
    want = {"base": set(), "far": set(), "none": set(), "one": set()}
    plain = sc.Scanner(list(scan.variants.values()), rules())
    for r in t.where("text <> ''").collect():
        for name, s in zip(want, plain.token_strings(r["text"])):
            want[name].update(s)
        assert plain.token_strings(r["text"])[1:] == [plain.token_string(r["text"], v) for v in range(3)]
    out = scan.used_ids(t)
    assert {r["variant"]: r["used_ids"] for r in out.collect()} == {k: len(v) for k, v in want.items()}
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    assert scan.used_ids(t.limit(0)).collect() == [] and scan.used_ids(t.where("text is null")).collect() == []
    assert "Generate" not in Q.QUERIES["vocab_growth"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
