"""The tokenizer called from SQL."""

import random

import pytest

from tokenledger import sql
from tokenledger.functions.tokens import encode_ids
from tokenledger.functions.vocab import BARRIER
from tokenledger.operators.train import Rule
from tokenledger.operators.vocab import BoltOn, build_vocab
from tokenledger.sources import fixtures as fx
from tokenledger.sources.rules import reference_rules

from test_properties import rand_text


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(8)
    rows = [(i, rand_text(rng, 20)) for i in range(200)] + [(200, None), (201, ""), (202, f"comme {BARRIER} 我们"), (203, "it's \\ 'q' \x00")]
    rows += [(300 + i, t) for i, (_, t) in enumerate(fx.PARALLEL)] if hasattr(fx, "PARALLEL") else []
    df = spark.createDataFrame(rows, "id int, body string")
    df.createOrReplaceTempView("texts")
    sql.register(spark, reference_rules("heavy"), build_vocab(fx.vocab_input(spark), 336))
    return df


def test_tokens_and_ids(spark, texts):
    rules = reference_rules("heavy")
    got = spark.sql("SELECT id, bpe_tokens(body) AS n, bpe_ids(body) AS ids FROM texts")
    want = {r["id"]: r["ids"] for r in texts.select("id", encode_ids("body", rules).alias("ids")).collect()}
    assert {r["id"]: r["ids"] for r in got.collect()} == want
    assert {r["id"]: r["n"] for r in got.collect()} == {k: None if v is None else len(v) for k, v in want.items()}


def test_vocabulary_functions(spark, texts):
    bolt = BoltOn.from_vocab(build_vocab(fx.vocab_input(spark), 336), reference_rules("heavy"))
    got = spark.sql("SELECT id, bolt_tokens(body) AS n FROM texts").collect()
    want = texts.select("id", bolt.token_count("body").alias("n")).collect()
    assert sorted(map(repr, [(r["id"], r["n"]) for r in got])) == sorted(map(repr, [(r["id"], r["n"]) for r in want]))
    rows = spark.sql("SELECT id, m.pos, m.term FROM texts, LATERAL bolt_matches(body) AS m").collect()
    matched = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["pos"])):
        matched.setdefault(r["id"], []).append(r["term"])
    assert matched == {r["id"]: r["m"] for r in texts.select("id", bolt.matches("body").alias("m")).collect() if r["m"]}
    assert spark.sql("SELECT count(*) AS n FROM bolt_vocab()").first()["n"] == 437


def test_rules_as_a_table(spark, texts):
    rows = spark.sql("SELECT rank, bpe_label(left_id) AS l, bpe_label(right_id) AS r, new_id, n FROM bpe_rules() ORDER BY rank").collect()
    assert len(rows) == 80 and tuple(rows[0]) == (0, "h", "e", 256, 93) and rows[1]["r"] == "[256]"
    totals = spark.sql("SELECT sum(bpe_tokens(body)) AS t FROM texts WHERE bpe_tokens(body) > 3 GROUP BY id % 2").collect()
    assert len(totals) == 2


def test_the_plan_is_native(spark, texts):
    plan = spark.sql("SELECT id, bpe_tokens(body), bolt_tokens(body) FROM texts WHERE id < 5")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_empty_and_other_names(spark, texts):
    sql.register_rules(spark, [], "raw")
    sql.register_vocabulary(spark, [("comme", 300)], [], "one")
    r = spark.sql("SELECT raw_tokens('é') AS a, one_tokens('comme!') AS b, bpe_tokens('the') AS c").first()
    assert tuple(r)[:2] == (2, 2) and r["c"] < 3
    assert spark.sql("SELECT * FROM raw_rules()").collect() == []
    with pytest.raises(ValueError):
        sql.register_rules(spark, [Rule(i, 1000, 1001, 2000 + i, 1) for i in range(201)])
