"""op6: repeated lines of every language go, one-off lines stay, names may clash."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tokenledger.llm import decontaminate, linededup, neardup

from conftest import rows_of

SF01 = "/root/testdata/sf0.1"


def test_repeated_lines_of_every_language_go(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = docs.select("doc_id", "source", "lang", "text").collect()
    pages, on, langs = Counter(r["source"] for r in rows), Counter(), defaultdict(Counter)
    for r in rows:
        for k in {x.strip(" \t\r") for x in r["text"].split("\n")} - {""}:
            on[r["source"], k] += 1
            langs[k][r["lang"]] += 1
    over = {k for k, n in on.items() if n >= linededup.MIN_HITS and n > linededup.RATIO * pages[k[0]]}
    gone, lost = defaultdict(set), Counter()
    out = {r["doc_id"]: r for r in linededup.drop_boilerplate(docs).select("doc_id", "text", "__lines", "__dropped").collect()}
    for r in rows:
        kept = out[r["doc_id"]]["text"].split("\n") if out[r["doc_id"]]["text"] else []
        before = [x.strip(" \t\r") for x in r["text"].split("\n")]
        want = [x for x in before if (r["source"], x) not in over]
        assert [x.strip(" \t\r") for x in kept] == (want if want else kept)
        lost[r["lang"]] += len(before) - len(want)
        for x in before:
            if (r["source"], x) in over:
                gone[langs[x].most_common(1)[0][0]].add(x)
            else:
                assert on[r["source"], x] < linededup.MIN_HITS or on[r["source"], x] <= linededup.RATIO * pages[r["source"]]
    # lines that stand on 2 % of all pages, by their language: every one goes somewhere
    common = {k for k, c in langs.items() if c.total() > 0.015 * len(rows)}
    assert {langs[k].most_common(1)[0][0] for k in common} == {"en", "de", "fr", "es"}
    assert common <= set().union(*gone.values())
    assert all(lost[x] > 20 for x in ("en", "de", "fr", "es")), lost


def test_clashing_names_of_the_callers_columns(spark, odd):
    names = ["__host", "__found", "__lines", "__dropped", "__salt", "__other", "__all", "__kept", "__gone", "__row", "_t", "salt", "host"]
    own = odd.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    plain = linededup.drop_boilerplate(odd, min_pages=1, min_hits=2)
    out = linededup.drop_boilerplate(own, min_pages=1, min_hits=2)
    assert rows_of(out, "doc_id", "text", "__lines", "__dropped") == rows_of(plain, "doc_id", "text", "__lines", "__dropped")
    passed = [n for n in names if n not in ("__lines", "__dropped")]
    assert rows_of(out, *passed) == rows_of(own, *passed)
    bench = spark.createDataFrame([(1, "three four FIVE six"), (2, "a passage of words that"), (3, "word")], "item_id bigint, text string")
    for f in (neardup.keep_one, lambda d: decontaminate.keep_clean(d, bench), lambda d: decontaminate.keep_clean(d, bench, block_bytes=5)):
        kept = f(own)
        assert kept.columns == own.columns
        assert rows_of(kept, "doc_id", "text") == rows_of(f(odd), "doc_id", "text")
        assert set(rows_of(kept, *names)) <= set(rows_of(own, *names))
