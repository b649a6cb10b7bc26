"""Stored segment counts: totals equal a plain encode, only unseen segments are encoded."""

import pytest
from pyspark.sql import functions as F

from tokenledger.operators import encode as enc
from tokenledger.operators.segment_store import SegmentStore
from tokenledger.operators.train import Rule
from tokenledger.sources import tables as tb
from tokenledger.sources.rules import reference_rules

from conftest import SF0001


def totals(df):
    return sorted(map(repr, df.collect()))


def test_a_grown_input_encodes_only_new_segments(spark, tmp_path):
    rules = reference_rules("heavy")
    docs = tb.documents(spark, SF0001)
    old, every = docs.where("doc_id % 3 <> 0"), docs
    store = SegmentStore(spark, str(tmp_path), rules, buckets=4)
    distinct = lambda d: {r["s"] for r in d.select(F.explode(F.split("text", r"[\t-\r\x1c-\x20]+")).alias("s")).distinct().collect()} - {""}
    first, n = store.tokens_by_key(old, ["lang"])
    assert n == len(distinct(old)) and totals(first) == totals(enc.tokens_by_key(old, rules, ["lang"]))
    second, more = store.tokens_by_key(every, ["lang"])
    assert more == len(distinct(every) - distinct(old)) and 0 < more < n
    assert totals(second) == totals(enc.tokens_by_key(every, rules, ["lang"]))
    third, none = SegmentStore(spark, str(tmp_path), rules, buckets=4).tokens_by_key(every, ["lang"])  # opened again
    assert none == 0 and totals(third) == totals(second)
    other, again = SegmentStore(spark, str(tmp_path), rules[:5], buckets=4).tokens_by_key(old, ["lang"])  # its own counts
    assert again == n and totals(other) == totals(enc.tokens_by_key(old, rules[:5], ["lang"]))


def test_the_stored_side_is_not_exchanged(spark, tmp_path):
    store = SegmentStore(spark, str(tmp_path), reference_rules("heavy"), buckets=4)
    store.add(spark.createDataFrame([("the",), ("cat",), ("sat",)], "seg string"))
    ask = spark.createDataFrame([("the", 2), ("dog", 1)], "seg string, occ int").repartition(3)
    assert [r["seg"] for r in store.unseen(ask).collect()] == ["dog"]
    for df in (store.unseen(ask), ask.join(store.counts().hint("merge"), "seg")):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        stored = plan[plan.index("FileScan parquet") - 400:]
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1, plan
        assert "SortMergeJoin" in plan and "Exchange" not in stored[stored.rindex("FileScan"):], plan


def test_odd_rows_and_repeated_appends(spark, tmp_path):
    rules = reference_rules("heavy")
    store = SegmentStore(spark, str(tmp_path), rules, buckets=2)
    rows = [("x", None), ("x", ""), (None, "the the cat"), (None, " \t\n"), ("y", "é　é the"), ("x", "a" * 3000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    out, _ = store.tokens_by_key(df, ["lang"])
    assert totals(out) == totals(enc.tokens_by_key(df, rules, ["lang"]))
    spark.table(store.table).write.format("parquet").bucketBy(2, "seg").sortBy("seg").mode("append").saveAsTable(
        store.table + "_copy", path=str(tmp_path / "copy"))
    spark.table(store.table + "_copy").write.insertInto(store.table)  # an append that ran twice
    again, n = store.tokens_by_key(df, ["lang"])
    assert n == 0 and totals(again) == totals(out)
    assert store.tokens_by_key(df.limit(0), ["lang"])[0].collect() == []
    with pytest.raises(ValueError):
        SegmentStore(spark, str(tmp_path), [Rule(0, 32, 97, 256, 2)])
