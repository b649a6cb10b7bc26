"""Registered queries: one per operator of the inventory, over driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the SQL oracle in ``plans.oracle``.  Integer outputs are
``bigint`` throughout.  Encode and bolt-on queries use the tokenizer of the
first reference experiment (80 rules from the English-heavy mix, see
``sources.rules``); training queries train on the documents themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenledger import sql
from tokenledger.functions.text import (ASCII_WS_CLASS, ASCII_WS_PATTERN, array_size, byte_length, utf8_bytes,
                                        word_count, words)
from tokenledger.functions.tokens import (apply_rules, char_to_id, token_count, token_label,
                                          token_string_ids)
from tokenledger.operators import encode as enc
from tokenledger.operators.match import longest_matches
from tokenledger.operators.pairs import counted_pairs, pair_ids, top_pairs
from tokenledger.operators.queue_encode import encode_counts_queued
from tokenledger.operators.scan import VariantScan, scan_of
from tokenledger.operators.segment_store import SegmentStore
from tokenledger.operators.train import Rule, compression, frequent_word_rules, train_bpe
from tokenledger.operators.vocab import BoltOn, LargeBoltOn, build_vocab, vocab_added
from tokenledger.operators.words import WordKeys, first_key, word_freq, word_table, word_tables
from tokenledger.plans import reports
from tokenledger.session import materialize, scratch_path
from tokenledger.sources import fixtures as fx
from tokenledger.sources import tables as tb
from tokenledger.sources.rules import reference_rules

BASE_MIX = "heavy"
DOC_MERGES = 80
#: Of these, learned by counting all words in ``train_rules_indexed``.
RECOUNTED = 64
#: Words spelled by the rules of ``encode_word_rules`` (about three rules each).
SPELLED_WORDS = 1000
BASELINE_LANG = "en"
VARIANTS = ["base", "zh", "ja", "fr", "all"]

Query = Callable[[SparkSession, str], DataFrame]


def base_rules() -> list[Rule]:
    return reference_rules(BASE_MIX)


def first_vocab_id() -> int:
    return 256 + len(base_rules())


def _long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _ids_text(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")


def _docs(spark: SparkSession, sf: str, cols=("doc_id", "lang", "text")) -> DataFrame:
    return tb.documents(spark, sf, cols)


# ------------------------------------------------------------------ training

def train_documents(spark: SparkSession, sf: str, mix_name: str | None = None,
                    num_merges: int = DOC_MERGES) -> tuple[list[Rule], DataFrame]:
    """Rules learned from the documents (or a mix of them), and the written
    word table they were learned from."""
    mix = tb.DOCUMENT_MIXES[mix_name] if mix_name else None
    words_, _ = materialize(word_table(tb.documents_corpus(spark, sf, mix), ["source_ord", "doc_ord"]), "words")
    return train_bpe(words_, num_merges, written=True).rules, words_


def trained_many(spark: SparkSession, sf: str, mix_names: list[str]) -> dict[str, list[Rule]]:
    """Train independent mixes concurrently (one driver thread each), from one
    count of the words of all their languages.

    Each training is a chain of small dependent jobs; running the chains side
    by side lets the scheduler fill idle cores.
    """
    mixes = {m: tb.DOCUMENT_MIXES[m] for m in mix_names}
    langs = dict.fromkeys(lang for mix in mixes.values() for lang, _ in mix)
    tables = word_tables(tb.documents_corpus(spark, sf, [(lang, 1) for lang in langs]), mixes)

    def train(name: str) -> list[Rule]:
        return train_bpe(materialize(tables[name], "words")[0], DOC_MERGES, written=True).rules

    with ThreadPoolExecutor(max_workers=len(mix_names)) as pool:
        futures = {m: pool.submit(train, m) for m in mix_names}
        return {m: f.result() for m, f in futures.items()}


def _doc_keys(spark: SparkSession, sf: str) -> WordKeys:
    """The documents' distinct words, aggregated and written once."""
    return first_key(word_table(tb.documents_corpus(spark, sf, None), ["source_ord", "doc_ord"]))


def _rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame(
        [(r.rank, r.left, r.right, r.new_id, r.n) for r in rules],
        "rank bigint, left_id bigint, right_id bigint, new_id bigint, n bigint")


# --------------------------------------------------------------- sources (2.1)

def q_corpus_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The English-heavy documents mix, per source."""
    c = tb.documents_corpus(spark, sf, tb.DOCUMENT_MIXES["en_heavy"])
    per = c.select("source", "source_ord", "weight", word_count("text").alias("w"))
    return (per.groupBy("source", "source_ord", "weight")
            .agg(F.count(F.lit(1)).alias("docs"), F.sum("w").alias("words"))
            .select("source", _long("source_ord").alias("source_ord"), "weight", "docs",
                    _long("words").alias("words"),
                    (F.col("weight") * F.col("words")).alias("weighted_words")))


def q_corpora_union(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and conversations as one weighted corpus, in that order."""
    corpus = tb.union_corpora([("documents", tb.documents(spark, sf, ("doc_id", "text")), 1),
                               ("conversations", tb.conversations(spark, sf, ("conv_id", "text")), 2)])
    per = corpus.select("source", "source_ord", "weight", word_count("text").alias("w"), byte_length("text").alias("b"))
    return (per.groupBy("source", "source_ord", "weight")
            .agg(F.count(F.lit(1)).alias("texts"), _long(F.sum("w")).alias("words"), _long(F.sum("b")).alias("bytes"))
            .select("source", _long("source_ord").alias("source_ord"), "weight", "texts", "words", "bytes",
                    (F.col("weight") * F.col("words")).alias("weighted_words")))


def q_corpus_words(spark: SparkSession, sf: str) -> DataFrame:
    """S3: words (with repeats) and distinct words of every documents mix, in one pass."""
    mixes = spark.createDataFrame(
        [(m, lang, w) for m, mix in tb.DOCUMENT_MIXES.items() for lang, w in mix],
        "mix string, lang string, weight bigint")
    wc = (_docs(spark, sf, ("lang", "text"))
          .select("lang", F.explode(words("text")).alias("word"))
          .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("occ")))
    j = wc.join(F.broadcast(mixes), "lang")
    return (j.groupBy("mix").agg(F.sum(F.col("occ") * F.col("weight")).alias("words"),
                                 F.countDistinct("word").alias("distinct_words")))


# ------------------------------------------------ projections and scalars (2.2)

def q_pretokenize(spark: SparkSession, sf: str) -> DataFrame:
    """Whitespace words with their position."""
    d = _docs(spark, sf, ("doc_id", "text"))
    return d.select("doc_id", F.posexplode(words("text")).alias("pos", "word")).select(
        "doc_id", _long("pos").alias("pos"), "word")


def q_utf8_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """UTF-8 byte histogram per language, from distinct segments (words and
    runs of white space) weighted by their count."""
    d = _docs(spark, sf, ("lang", "text"))
    segs = F.concat(F.split("text", ASCII_WS_PATTERN), F.split("text", "[^" + ASCII_WS_CLASS[1:] + "+"))
    distinct = (d.select("lang", F.explode(segs).alias("seg")).where(F.col("seg") != "")
                .groupBy("lang", "seg").agg(F.count(F.lit(1)).alias("occ")))
    return (distinct.select("lang", "occ", F.explode(utf8_bytes("seg")).alias("byte"))
            .groupBy("lang", "byte").agg(F.sum("occ").alias("n"))
            .select("lang", _long("byte").alias("byte"), "n"))


def q_byte_length(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and characters per document."""
    d = _docs(spark, sf)
    return d.select("doc_id", "lang", _long(F.char_length("text")).alias("n_chars"),
                    _long(byte_length("text")).alias("n_bytes")).withColumn(
        "bytes_per_char", F.try_divide(F.col("n_bytes").cast("double"),
                                       F.col("n_chars").cast("double")))


def q_utf8_overhead(spark: SparkSession, sf: str) -> DataFrame:
    """Language density: bytes per char, chars per word."""
    d = _docs(spark, sf, ("lang", "text"))
    per = d.select("lang", F.char_length("text").alias("c"), byte_length("text").alias("b"),
                   word_count("text").alias("w"))
    agg = per.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), _long(F.sum("c")).alias("chars"),
                                  _long(F.sum("b")).alias("bytes"), _long(F.sum("w")).alias("words"))
    return (agg.withColumn("bytes_per_char", F.try_divide(F.col("bytes").cast("double"),
                                                          F.col("chars").cast("double")))
            .withColumn("chars_per_word", F.try_divide(F.col("chars").cast("double"),
                                                       F.col("words").cast("double"))))


# --------------------------------------------------------- aggregations (2.3)

def q_word_freq(spark: SparkSession, sf: str) -> DataFrame:
    """A2: distinct words, frequency and first occurrence (documents in id order)."""
    wf = word_freq(tb.documents_corpus(spark, sf, None), ["source_ord", "doc_ord"])
    return wf.select("word", "freq", F.col("first.doc_ord").alias("first_doc"),
                     _long("first.pos").alias("first_pos"))


def q_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A1: adjacent byte-pair counts over all words, overlaps counted."""
    pc = counted_pairs(_doc_keys(spark, sf))
    left, right = pair_ids("pair")
    return pc.select(_long(left).alias("left_id"), _long(right).alias("right_id"), "n",
                     F.col("first.doc_ord").alias("first_doc"), _long("first.pos").alias("first_pos"),
                     _long("first.i").alias("first_i"))


def q_pair_top(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best pairs seen at least twice, ties by first occurrence."""
    top = top_pairs(counted_pairs(_doc_keys(spark, sf)), 10)
    left, right = pair_ids("pair")
    w = Window.orderBy(F.desc("n"), F.asc("first"))
    return top.select(_long(F.row_number().over(w) - 1).alias("rank"),
                      _long(left).alias("left_id"), _long(right).alias("right_id"), "n")


def q_merge_step(spark: SparkSession, sf: str) -> DataFrame:
    """K1: apply the best pair as one merge to every distinct word."""
    keys = first_key(word_table(tb.documents_corpus(spark, sf, None), ["source_ord", "doc_ord"]))
    best = top_pairs(counted_pairs(keys), 1).collect()
    rules = []
    if best:
        p = best[0]["pair"]
        rules = [Rule(0, char_to_id(p[0]), char_to_id(p[1]), 256, best[0]["n"])]
    return keys.frame.select("word", "freq", _long(F.char_length("tok")).alias("tokens_before"),
                             _long(F.char_length(apply_rules("tok", rules))).alias("tokens_after"))


# ------------------------------------------------------------- training (2.6)

def q_train_rules(spark: SparkSession, sf: str) -> DataFrame:
    """80 merge rules learned from all documents."""
    return _rules_frame(spark, train_documents(spark, sf)[0])


def q_train_rules_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """K2/A1: the same 80 rules, the last ones from the inverted index."""
    words_, _ = materialize(word_table(tb.documents_corpus(spark, sf, None), ["source_ord", "doc_ord"]), "words")
    return _rules_frame(spark, train_bpe(words_, DOC_MERGES, written=True, index_from=RECOUNTED).rules)


def q_rules_top10(spark: SparkSession, sf: str) -> DataFrame:
    """O1: the first ten rules with display labels."""
    return q_rule_labels(spark, sf).where(F.col("rank") < 10)


def q_rule_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Every learned rule with display labels."""
    r = _rules_frame(spark, train_documents(spark, sf)[0])
    return r.select("rank", token_label("left_id").alias("left_label"),
                    token_label("right_id").alias("right_label"), "new_id", "n")


def q_train_compression(spark: SparkSession, sf: str) -> DataFrame:
    """A4: corpus tokens before and after training."""
    rules, words_ = train_documents(spark, sf)
    return compression(words_, rules)


def q_train_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """K3: every distinct training word as its final token ids."""
    rules, words_ = train_documents(spark, sf)
    wt = words_.select("word", "freq", apply_rules("tok", rules).alias("t"))
    return wt.select("word", "freq", _long(F.char_length("t")).alias("n_tokens"),
                     _ids_text(token_string_ids("t")).alias("ids"))


# --------------------------------------------------------------- encode (2.6)

def q_encode_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and tokens per byte of every document."""
    out = enc.encode_counts(_docs(spark, sf), base_rules(), keep=["doc_id", "lang"])
    return out.select("doc_id", "lang", _long("n_bytes").alias("n_bytes"),
                      _long("tokens").alias("tokens"), "tokens_per_byte")


def q_encode_ids(spark: SparkSession, sf: str) -> DataFrame:
    """K4: token ids of every document."""
    out = enc.encode_with_ids(_docs(spark, sf, ("doc_id", "text")), base_rules(), keep=["doc_id"])
    return out.select("doc_id", _long("tokens").alias("tokens"), _ids_text(F.col("ids")).alias("ids"))


def q_encode_queue(spark: SparkSession, sf: str) -> DataFrame:
    """K4: the counts of ``encode_counts`` by the priority queue."""
    out = encode_counts_queued(_docs(spark, sf), base_rules(), keep=["doc_id", "lang"])
    return out.select("doc_id", "lang", _long("n_bytes").alias("n_bytes"), _long("tokens").alias("tokens"), "tokens_per_byte")


def q_sql_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """2.7: the counts of ``encode_counts`` by a query that calls SQL functions."""
    sql.register_rules(spark, base_rules())
    _docs(spark, sf).createOrReplaceTempView("tokenledger_documents")
    return spark.sql("""
        SELECT doc_id, lang, CAST(octet_length(text) AS BIGINT) AS n_bytes, bpe_tokens(text) AS tokens,
               try_divide(CAST(bpe_tokens(text) AS DOUBLE), CAST(octet_length(text) AS DOUBLE)) AS tokens_per_byte
        FROM tokenledger_documents""")


def q_encode_word_rules(spark: SparkSession, sf: str) -> DataFrame:
    """K4 with thousands of rules: those that spell the documents' most frequent words."""
    words_, _ = materialize(word_table(tb.documents_corpus(spark, sf, None), ["source_ord", "doc_ord"]), "words")
    rules = frequent_word_rules(words_, SPELLED_WORDS)
    out = enc.encode_counts(_docs(spark, sf), rules, keep=["doc_id", "lang"])
    return out.select("doc_id", "lang", F.lit(len(rules)).cast("bigint").alias("n_rules"), _long("tokens").alias("tokens"))


def _by_lang(df: DataFrame) -> DataFrame:
    return df.select("lang", "docs", _long("bytes").alias("bytes"), _long("chars").alias("chars"),
                     _long("words").alias("words"), _long("tokens").alias("tokens"),
                     "tokens_per_byte", "tokens_per_char", "tokens_per_word")


def q_tokens_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    """A5: token totals and densities per language."""
    return _by_lang(enc.tokens_by_key(_docs(spark, sf, ("lang", "text")), base_rules(), ["lang"]))


def q_encode_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The same totals, encoding each distinct segment once."""
    return _by_lang(enc.tokens_by_key_dedup(_docs(spark, sf, ("lang", "text")), base_rules(),
                                            ["lang"]))


def q_encode_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same totals from a store of segment counts that this run fills."""
    store = SegmentStore(spark, scratch_path(spark, "store"), base_rules())
    return _by_lang(store.tokens_by_key(_docs(spark, sf, ("lang", "text")), ["lang"])[0])


def q_vs_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Densities relative to English."""
    t = enc.tokens_by_key(_docs(spark, sf, ("lang", "text")), base_rules(), ["lang"])
    t = reports.vs_baseline(t, "tokens_per_byte", baseline=BASELINE_LANG, out="tpb_vs_en")
    t = reports.vs_baseline(t, "tokens_per_word", baseline=BASELINE_LANG, out="tpw_vs_en")
    return t.select("lang", "tokens_per_byte", "tokens_per_word", "tpb_vs_en", "tpw_vs_en")


def _balanced(spark: SparkSession, sf: str, mixes: list[str]) -> DataFrame:
    """Tokens per language under several trained tokenizers, in one pass."""
    return enc.tokens_by_key_many(_docs(spark, sf, ("lang", "text")), trained_many(spark, sf, mixes), ["lang"])


def q_gap_reduction(spark: SparkSession, sf: str) -> DataFrame:
    """Gap to English under an English-heavy vs a French-balanced tokenizer."""
    t = _balanced(spark, sf, ["en_heavy", "balanced_fr"])
    g = reports.gap_columns(t, "per_byte_en_heavy", "per_byte_balanced_fr", baseline=BASELINE_LANG)
    return g.where(F.col("lang") != BASELINE_LANG).select(
        "lang", F.col("per_byte_en_heavy").alias("value_before"), "gap_before",
        F.col("per_byte_balanced_fr").alias("value_after"), "gap_after", "reduction_pct")


def q_gap_compare(spark: SparkSession, sf: str) -> DataFrame:
    """French vs German balancing effect side by side."""
    t = _balanced(spark, sf, ["en_heavy", "balanced_fr", "balanced_de"])
    own = lambda c: F.when(F.col("lang") == "fr", F.col(f"{c}_balanced_fr")).otherwise(F.col(f"{c}_balanced_de"))
    # each language's own balanced tokenizer, with that tokenizer's English
    t = (t.withColumn("_fr", reports.baseline_of("per_byte_balanced_fr", baseline=BASELINE_LANG))
         .withColumn("_de", reports.baseline_of("per_byte_balanced_de", baseline=BASELINE_LANG))
         .withColumn("_en", reports.baseline_of("per_byte_en_heavy", baseline=BASELINE_LANG)))
    after = F.try_divide(own("per_byte"), F.when(F.col("lang") == "fr", F.col("_fr")).otherwise(F.col("_de")))
    before = F.try_divide(F.col("per_byte_en_heavy"), F.col("_en"))
    return t.where(F.col("lang").isin("fr", "de")).select(
        "lang", _long("tokens_en_heavy").alias("heavy_tokens"), _long(own("tokens")).alias("balanced_tokens"),
        ((F.lit(1.0) - F.try_divide(after, before)) * F.lit(100.0)).alias("gap_reduction_pct"))


# --------------------------------------------------------------- bolt-on (2.6)

# The driver's documents hold Latin text only.  Their letters, mapped one to
# one to characters of the vocabulary lists, give whole tables of text in the
# scripts that the vocabularies are made for.
CJK_FROM = "etaoinshrdlucmfwypvbgkjqxz"
CJK_TO = "我们他什么可以已经" "あいうえおかきくけ" "アイウエ" "이다는을"


def _cjk(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.translate("text", CJK_FROM, CJK_TO))


def _vocab(spark: SparkSession, labels=None) -> DataFrame:
    return build_vocab(fx.vocab_input(spark, labels), first_vocab_id())


def _bolt(spark: SparkSession, labels=None) -> BoltOn:
    return BoltOn.from_vocab(_vocab(spark, labels), base_rules())


def _term_hits(spark: SparkSession, sf: str, bolt: BoltOn) -> DataFrame:
    d = _docs(spark, sf, ("text",))
    return (d.select(F.explode(bolt.matches("text")).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("hits")))


def q_vocab_build(spark: SparkSession, sf: str) -> DataFrame:
    """The bolt-on vocabulary and how often each entry is used."""
    v = _vocab(spark)
    hits = _term_hits(spark, sf, BoltOn.from_vocab(v, base_rules()))
    return (v.join(hits, "term", "left")
            .select(_long("token_id").alias("token_id"), "term", _long("n_bytes").alias("n_bytes"),
                    F.concat(F.col("term"), F.lit(" ("), F.col("label"), F.lit(")")).alias("display"),
                    F.coalesce(F.col("hits"), F.lit(0)).cast("bigint").alias("hits")))


def q_vocab_added(spark: SparkSession, sf: str) -> DataFrame:
    """Entries offered, added and used in documents, per group and in total."""
    vin = fx.vocab_input(spark)
    v = build_vocab(vin, first_vocab_id())
    hits = _term_hits(spark, sf, BoltOn.from_vocab(v, base_rules()))
    used = (v.join(hits, "term").groupBy("group_ord", "label")
            .agg(F.count(F.lit(1)).alias("used")))
    per = (vocab_added(v, vin, total=False)
           .join(used, ["group_ord", "label"], "left").fillna(0, ["used"]))
    return (per.rollup("group_ord", "label")
            .agg(_long(F.sum("offered")).alias("offered"), _long(F.sum("added")).alias("added"),
                 _long(F.sum("used")).alias("used"))
            .where(F.col("label").isNotNull() | F.col("group_ord").isNull())
            .select(_long("group_ord").alias("group_ord"), "label", "offered", "added", "used"))


def _match_report(d: DataFrame, bolt: BoltOn) -> DataFrame:
    return d.select("doc_id", bolt.matches("text").alias("m")).select(
        "doc_id", _long(array_size(F.col("m"))).alias("matches"),
        _long(F.aggregate(F.transform("m", lambda t: F.octet_length(t)), F.lit(0),
                          lambda a, b: a + b)).alias("matched_bytes"),
        _long(array_size(F.array_distinct("m"))).alias("distinct_terms"))


def q_vocab_match(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy longest-match of the vocabulary in every document."""
    return _match_report(_docs(spark, sf, ("doc_id", "text")), _bolt(spark))


def q_vocab_match_cjk(spark: SparkSession, sf: str) -> DataFrame:
    """K6/J4 on text in the vocabulary's own scripts."""
    return _match_report(_cjk(_docs(spark, sf, ("doc_id", "text"))), _bolt(spark))


def q_vocab_match_join(spark: SparkSession, sf: str) -> DataFrame:
    """J4 by joins (the path of large vocabularies): matches per term."""
    hits = longest_matches(_docs(spark, sf, ("doc_id", "text")), _vocab(spark), ["doc_id"])
    return hits.groupBy("term", _long("token_id").alias("token_id")).agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct("doc_id").alias("docs"))


def q_vocab_hits_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """K6: matches and matched bytes per vocabulary label."""
    v = _vocab(spark)
    hits = _term_hits(spark, sf, BoltOn.from_vocab(v, base_rules()))
    j = hits.join(v.select("term", "label", "n_bytes"), "term")
    return j.groupBy("label").agg(_long(F.sum("hits")).alias("hits"),
                                  _long(F.sum(F.col("hits") * F.col("n_bytes"))).alias("matched_bytes"))


def _scan(spark: SparkSession) -> VariantScan:
    return scan_of(_vocab(spark), base_rules())


def _bolt_count_report(spark: SparkSession, d: DataFrame) -> DataFrame:
    return _scan(spark).counts(d, base="tokens_before").select(
        "doc_id", "lang", "tokens_before", F.col("bolt_tokens").alias("tokens_after"))


def q_bolt_counts(spark: SparkSession, sf: str) -> DataFrame:
    """K7: tokens per document before and after adding all vocabularies."""
    return _bolt_count_report(spark, _docs(spark, sf))


def q_bolt_counts_cjk(spark: SparkSession, sf: str) -> DataFrame:
    """K7 on text in the vocabulary's own scripts."""
    return _bolt_count_report(spark, _cjk(_docs(spark, sf)))


def _ids_report(d: DataFrame) -> DataFrame:
    return d.select("doc_id", _long(F.char_length("t")).alias("tokens"),
                    _ids_text(token_string_ids("t")).alias("ids"))


def q_bolt_ids(spark: SparkSession, sf: str) -> DataFrame:
    """K7: token ids with the all-languages bolt-on tokenizer."""
    return _ids_report(_scan(spark).with_token_string(_docs(spark, sf, ("doc_id", "text")), out="t"))


def q_bolt_ids_cjk(spark: SparkSession, sf: str) -> DataFrame:
    """K7 ids on text in the vocabulary's own scripts, by the join path."""
    d = _cjk(_docs(spark, sf, ("doc_id", "text")))
    return _ids_report(LargeBoltOn(tuple(base_rules()), _vocab(spark)).with_token_string(d, ["doc_id"], out="t"))


def q_variant_counts(spark: SparkSession, sf: str) -> DataFrame:
    """K8: tokens per language for the base tokenizer and each bolt-on variant."""
    return _variant_report(spark, _docs(spark, sf, ("lang", "text")))


def q_variant_counts_cjk(spark: SparkSession, sf: str) -> DataFrame:
    """K8 on text in the vocabulary's own scripts."""
    return _variant_report(spark, _cjk(_docs(spark, sf, ("lang", "text"))))


def _variants(spark: SparkSession) -> VariantScan:
    with ThreadPoolExecutor(len(fx.VOCAB_VARIANTS)) as pool:  # small independent jobs
        made = {v: pool.submit(_bolt, spark, labels) for v, labels in fx.VOCAB_VARIANTS.items()}
        return VariantScan(tuple(base_rules()), {v: f.result().entries for v, f in made.items()})


def _variant_report(spark: SparkSession, d: DataFrame) -> DataFrame:
    per = _variants(spark).counts(d).groupBy("lang").agg(*[F.sum(v).alias(v) for v in VARIANTS])
    stack = ", ".join(f"'{v}', `{v}`" for v in VARIANTS)
    return per.selectExpr("lang", f"stack({len(VARIANTS)}, {stack}) as (variant, tokens)").select(
        "variant", "lang", _long("tokens").alias("tokens"))


def _before_after(spark: SparkSession, sf: str) -> DataFrame:
    """One row per language: ``before``, ``after`` and their tokens per byte."""
    bolt = _bolt(spark)
    per = _docs(spark, sf, ("lang", "text")).select(
        "lang", byte_length("text").alias("b"), token_count("text", base_rules()).alias("t0"),
        bolt.token_count("text").alias("t1"))
    agg = per.groupBy("lang").agg(_long(F.sum("b")).alias("bytes"), _long(F.sum("t0")).alias("before"),
                                  _long(F.sum("t1")).alias("after"))
    density = lambda c: F.try_divide(F.col(c).cast("double"), F.col("bytes").cast("double"))
    return agg.select("lang", "before", "after", density("before").alias("tpb_before"), density("after").alias("tpb_after"))


def q_before_after(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and densities per language before and after the vocabularies."""
    return _before_after(spark, sf)


def q_bolt_reduction(spark: SparkSession, sf: str) -> DataFrame:
    """Reduction per language; multipliers against English before the change."""
    return reports.reduction_columns(_before_after(spark, sf), "tpb_before", "tpb_after", baseline=BASELINE_LANG)


def q_token_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Cost before and after at the reference price and volume; saved null unless positive."""
    return reports.token_cost(_before_after(spark, sf).select("lang", "before", "after"), fx.PRICE_PER_TOKEN, fx.SEND_VOLUME)


def q_vocab_growth(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary size (256 bytes + rules + bolt-on entries) of each variant,
    next to the distinct ids that the documents really use."""
    scan = _variants(spark)
    sizes = spark.createDataFrame([("base", 0), *((v, len(e)) for v, e in scan.variants.items())], "variant string, added bigint")
    ids = scan.used_ids(_docs(spark, sf, ("text",)))
    n = F.lit(len(base_rules())).cast("bigint")
    return sizes.join(ids, "variant", "left").select(
        "variant", F.lit(256).cast("bigint").alias("base"), n.alias("rules"), "added",
        (F.lit(256) + n + F.col("added")).alias("vocab_size"), F.coalesce("used_ids", F.lit(0)).cast("bigint").alias("used_ids"))


def q_conversation_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """A5 on conversations: tokens per role, base and all-languages bolt-on."""
    bolt = _bolt(spark)
    c = tb.conversations(spark, sf, ("role", "text"))
    per = c.select("role", byte_length("text").alias("b"), token_count("text", base_rules()).alias("t"),
                   bolt.token_count("text").alias("bt"))
    agg = per.groupBy("role").agg(F.count(F.lit(1)).alias("turns"), _long(F.sum("b")).alias("bytes"),
                                  _long(F.sum("t")).alias("tokens"), _long(F.sum("bt")).alias("bolt_tokens"))
    return agg.withColumn("tokens_per_byte", F.try_divide(F.col("tokens").cast("double"),
                                                          F.col("bytes").cast("double")))


QUERIES: dict[str, Query] = {
    "corpus_mix": q_corpus_mix,
    "corpora_union": q_corpora_union,
    "corpus_words": q_corpus_words,
    "pretokenize": q_pretokenize,
    "utf8_bytes": q_utf8_bytes,
    "byte_length": q_byte_length,
    "utf8_overhead": q_utf8_overhead,
    "word_freq": q_word_freq,
    "pair_counts": q_pair_counts,
    "pair_top": q_pair_top,
    "merge_step": q_merge_step,
    "train_rules": q_train_rules,
    "train_rules_indexed": q_train_rules_indexed,
    "rules_top10": q_rules_top10,
    "rule_labels": q_rule_labels,
    "train_compression": q_train_compression,
    "train_sequences": q_train_sequences,
    "encode_counts": q_encode_counts,
    "encode_ids": q_encode_ids,
    "encode_queue": q_encode_queue,
    "encode_word_rules": q_encode_word_rules,
    "sql_tokens": q_sql_tokens,
    "tokens_by_lang": q_tokens_by_lang,
    "encode_dedup": q_encode_dedup,
    "encode_stored": q_encode_stored,
    "vs_baseline": q_vs_baseline,
    "gap_reduction": q_gap_reduction,
    "gap_compare": q_gap_compare,
    "vocab_build": q_vocab_build,
    "vocab_added": q_vocab_added,
    "vocab_match": q_vocab_match,
    "vocab_match_cjk": q_vocab_match_cjk,
    "vocab_match_join": q_vocab_match_join,
    "vocab_hits_by_label": q_vocab_hits_by_label,
    "bolt_counts": q_bolt_counts,
    "bolt_counts_cjk": q_bolt_counts_cjk,
    "bolt_ids": q_bolt_ids,
    "bolt_ids_cjk": q_bolt_ids_cjk,
    "variant_counts": q_variant_counts,
    "variant_counts_cjk": q_variant_counts_cjk,
    "before_after": q_before_after,
    "bolt_reduction": q_bolt_reduction,
    "token_cost": q_token_cost,
    "vocab_growth": q_vocab_growth,
    "conversation_tokens": q_conversation_tokens,
}
