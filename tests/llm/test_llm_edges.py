"""Every operator on odd rows, on an empty table and with clashing columns."""

import pytest
from pyspark.sql import functions as F

from tokenledger.llm import (decontaminate, fingerprint, langid, linededup, neardup, packing, quality, repeats, tokencount,
                             toxicity)

from conftest import LONG, ROWS, clashing, rows_of


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(1, 13)] + [(None, 1, 1), (2, None, None)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "three four FIVE six"), (2, None), (3, ""), (None, "seven eight"), (4, "word"), (4, "word")],
                                 "item_id bigint, text string")


def operators(labels, bench):
    return {
        "op1": tokencount.count_tokens, "op2": repeats.digest, "op3": packing.pack, "op4": langid.identify,
        "op5": lambda d: toxicity.toxicity_scores(d, labels), "op6": linededup.drop_boilerplate,
        "op7": fingerprint.edited_fingerprints, "op8": lambda d: decontaminate.contamination(d, bench),
        "op9": lambda d: quality.quality_scores(d, labels), "op10": neardup.near_duplicates}


@pytest.mark.parametrize("name", [f"op{i}" for i in range(1, 11)])
def test_odd_rows(odd, labels, bench, name):
    f = operators(labels, bench)[name]
    out = f(odd)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    want = [r[0] for r in ROWS]
    if name == "op3":
        assert set(ids) == set(want)
    else:
        assert sorted(ids, key=repr) == sorted(want, key=repr)
    if name != "op6":  # its extra columns pass through
        cols = [c for c in out.columns if c not in ("sequence_id", "offset")]
        a, b = rows_of(out, *cols), rows_of(f(clashing(odd).repartition(3)), *cols)
        assert repr(a) == repr(b)
    else:
        assert rows_of(out, "doc_id", "text") == rows_of(f(clashing(odd)), "doc_id", "text")


@pytest.mark.parametrize("name", [f"op{i}" for i in range(1, 11)])
def test_empty_table(empty, labels, bench, name):
    assert operators(labels, bench)[name](empty).collect() == []


def test_no_labels(odd, spark, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.quality_scores(odd, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.toxicity_scores(odd, none).collect()} == {0.0}
    assert quality.keep_quality(odd, none).count() == len(ROWS)
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], none.schema)
    assert {r["score"] for r in quality.quality_scores(odd, one).collect()} == {1.0}


def test_language_of_odd_rows(odd):
    got = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    for i in (3, 4, 5):
        assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0
    assert got[6]["lang_pred"] == "en" and 0 <= got[6]["score"] <= 1
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(nothing).collect()} == {"und"}


def test_near_duplicates_of_odd_rows(odd):
    got = {}
    for r in neardup.near_duplicates(odd).collect():
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[-5] == [(6, -5, True)] and got[1] == [(6, -5, False)] and got[2] == [(6, -5, False)]
    assert got[3] == [(0, 3, True)] and got[4] == [(0, 4, True)] * 2 and got[5] == [(0, 5, True)]
    assert got[7][0][1:] == (6, False) and got[8] == [(1, 8, True)]
    assert got[None][0][1:] == (None, True)
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (d is None, d or 0) for d in (r[0] for r in ROWS) if d not in (1, 2, 7, 12) or d == 12 and got[12][0][2])


def test_packing_of_odd_rows(odd):
    p = packing.pack(odd).collect()
    assert sum(r["length"] for r in p if r["doc_id"] in (3, 4, 5)) >= 3
    by = {}
    for r in p:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for slots in by.values():
        at = 0
        for off, n in sorted(slots):
            assert off == at
            at += n
        assert at <= packing.CAPACITY
    long_ = sorted((r["piece"], r["start"], r["length"]) for r in p if r["doc_id"] == 6)
    assert len(long_) > 3 and all(n == 2048 for _, _, n in long_[1:]) and long_[1][1] == long_[0][2]


def test_fingerprints_of_odd_rows(odd):
    got = {}
    for r in fingerprint.edited_fingerprints(odd).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[1][0]["fingerprint"] == got[2][0]["fingerprint"]
    assert got[3][0]["n_chars"] == 0 and got[4][0]["fingerprint"] == got[3][0]["fingerprint"]
    assert got[6][0]["n_chars"] == len(LONG) and got[6][0]["near_edited"] > 0.5
    assert all(0 <= r[0]["near_next"] <= 1 for r in got.values())


def test_repeats_of_odd_rows(odd):
    got = {r["doc_id"]: r for r in repeats.digest(odd).collect()}
    texts = {r[0]: r[1] for r in ROWS if r[0] is not None}
    want = repeats.brute_force(texts)
    for d, w in want.items():
        assert tuple(got[d])[1:] == w, d
    assert got[None]["n_removed"] == 0 and got[12]["n_removed"] > 100


def test_contamination_blocks_keep_rows_apart(spark, odd, bench):
    more = spark.createDataFrame([(None, "three four five six", "en", "a", 1), (None, "nothing of the kind", "en", "a", 1),
                                  (4, "word", "en", "a", 1), (21, "a word, three four five six", "en", "a", 1)], odd.schema)
    docs = odd.union(more)
    assert len(decontaminate._blocks(bench, 5)) > 3
    spans = decontaminate.SCHEMA.names
    assert rows_of(decontaminate.find_spans(docs, bench, block_bytes=5), *spans) == rows_of(decontaminate.find_spans(docs, bench), *spans)
    cols = decontaminate.contamination(docs, bench).columns
    one = rows_of(decontaminate.contamination(docs, bench), *cols)
    assert len(one) == len(ROWS) + 4
    assert rows_of(decontaminate.contamination(docs, bench, block_bytes=5), *cols) == one


def test_contamination_reads_one_block_at_a_time(spark, odd, bench, monkeypatch):
    log = []
    blocks, keep = decontaminate._blocks, decontaminate.written
    n = len(blocks(bench, 5))

    class Watched:
        def __len__(self):
            return n

        def __iter__(self):
            for b in blocks(bench, 5):
                log.append("read")
                yield b

    monkeypatch.setattr(decontaminate, "_blocks", lambda *a: Watched())
    monkeypatch.setattr(decontaminate, "written", lambda df, name: log.append(name) or keep(df, name))
    decontaminate.find_spans(odd, bench, block_bytes=5)
    assert log == ["decontaminate-rows"] + ["read", "decontaminate-spans"] * n
