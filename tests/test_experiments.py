"""The experiment reports reproduce the published tables."""

from tokenledger.plans import experiments as ex


def _by_lang(df):
    return {r["lang"]: r for r in df.collect()}


def test_experiment1_table(spark):
    t = _by_lang(ex.tokenization(spark))
    assert {k: v["tokens"] for k, v in t.items()} == \
        {"English": 34, "Japanese": 77, "Korean": 65, "French": 48, "Chinese": 39}
    assert [round(t[k]["vs_english"], 1) for k in ("Japanese", "Korean", "French", "Chinese")] == \
        [2.3, 1.9, 1.4, 1.1]


def test_experiments2_and_3_tables(spark):
    ja = _by_lang(ex.balancing(spark, "balanced_ja", ["Japanese"]))["Japanese"]
    assert (ja["heavy_tokens"], ja["balanced_tokens"]) == (77, 64)
    assert ja["reduction_pct"] > 0
    zh = _by_lang(ex.balancing(spark, "balanced_zh", ["Chinese"]))["Chinese"]
    assert (zh["heavy_tokens"], zh["balanced_tokens"]) == (39, 39)


def test_experiment4_tables(spark):
    b = _by_lang(ex.bolt_on(spark))
    assert {k: (v["before"], v["after"]) for k, v in b.items()} == {
        "English": (34, 34), "Japanese": (77, 11), "Chinese": (39, 9), "French": (48, 22),
        "Korean": (65, 43)}
    assert [round(b[k]["reduction_pct"]) for k in ("Japanese", "Chinese", "French", "Korean")] == \
        [86, 77, 54, 34]
    assert [round(b[k]["mult_after"], 1) for k in ("Japanese", "Chinese", "French", "Korean")] == \
        [0.3, 0.3, 0.6, 1.3]
    c = _by_lang(ex.cost(spark))
    assert [round(c[k]["cost_before"], 2) for k in ("English", "Japanese", "Chinese", "Korean", "French")] \
        == [85.0, 192.5, 97.5, 162.5, 120.0]
    assert [round(c[k]["cost_after"], 2) for k in ("English", "Japanese", "Chinese", "Korean", "French")] \
        == [85.0, 27.5, 22.5, 107.5, 55.0]
    assert c["English"]["saved"] is None and round(c["Japanese"]["saved"], 2) == 165.0
