"""DuckDB SQL for every registered query (same column names and types).

Written separately from the Spark path: training is one merge per step
(unrolled CTEs, ties by the first occurrence struct), bytes come from code
point arithmetic, vocabulary ids from window functions over a VALUES list,
and matching uses a flat longest-first alternation (RE2).
"""

from __future__ import annotations

from tokenledger.plans import sqlgen as g
from tokenledger.plans.queries import BASELINE_LANG, CJK_FROM, CJK_TO, DOC_MERGES, SPELLED_WORDS, VARIANTS, base_rules
from tokenledger.sources import fixtures as fx
from tokenledger.sources.tables import DOCUMENT_MIXES

RULES = base_rules()
FIRST_VOCAB_ID = 256 + len(RULES)


def _enc(text: str) -> str:
    return g.apply_rules(g.utf8_byte_string(text), RULES)


def _vocab_rows(labels=None):
    return fx.vocab_rows(labels)


def _pattern(labels=None) -> str:
    return g.vocab_pattern([t for _, _, t, _ in _vocab_rows(labels)])


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body


# ------------------------------------------------------------------ sources

def corpus_mix() -> str:
    mix = DOCUMENT_MIXES["en_heavy"]
    so = " ".join(f"WHEN {g.q(lang)} THEN {i}" for i, (lang, _) in enumerate(mix))
    wt = " ".join(f"WHEN {g.q(lang)} THEN {w}" for lang, w in mix)
    langs = ", ".join(g.q(lang) for lang, _ in mix)
    return f"""
SELECT source, CAST(so AS BIGINT) AS source_ord, weight, CAST(count(*) AS BIGINT) AS docs,
       CAST(sum(w) AS BIGINT) AS words, CAST(weight * sum(w) AS BIGINT) AS weighted_words
FROM (SELECT lang AS source, CASE lang {so} END AS so, CAST(CASE lang {wt} END AS BIGINT) AS weight,
             len({g.words('text')}) AS w
      FROM documents WHERE lang IN ({langs})) t
GROUP BY source, so, weight"""


def corpora_union() -> str:
    return f"""
SELECT source, CAST(so AS BIGINT) AS source_ord, CAST(weight AS BIGINT) AS weight, CAST(count(*) AS BIGINT) AS texts,
       CAST(sum(w) AS BIGINT) AS words, CAST(sum(b) AS BIGINT) AS bytes, CAST(weight * sum(w) AS BIGINT) AS weighted_words
FROM (SELECT 'documents' AS source, 0 AS so, 1 AS weight, len({g.words('text')}) AS w, strlen(text) AS b FROM documents
      UNION ALL
      SELECT 'conversations', 1, 2, len({g.words('text')}), strlen(text) FROM conversations) t
GROUP BY source, so, weight"""


def corpus_words() -> str:
    vals = ", ".join(f"({g.q(m)}, {g.q(lang)}, {w})" for m, mix in DOCUMENT_MIXES.items()
                     for lang, w in mix)
    return f"""
WITH mixes AS (SELECT * FROM (VALUES {vals}) v(mix, lang, weight)),
wc AS (SELECT lang, word, count(*) AS occ
       FROM (SELECT lang, unnest({g.words('text')}) AS word FROM documents) t GROUP BY lang, word)
SELECT mix, CAST(sum(occ * weight) AS BIGINT) AS words,
       CAST(count(DISTINCT word) AS BIGINT) AS distinct_words
FROM wc JOIN mixes USING (lang) GROUP BY mix"""


# ----------------------------------------------------------- scalars (2.2)

def pretokenize() -> str:
    return f"""
SELECT doc_id, CAST(unnest(range(0, len(ws))) AS BIGINT) AS pos, unnest(ws) AS word
FROM (SELECT doc_id, {g.words('text')} AS ws FROM documents) t"""


def utf8_bytes() -> str:
    return f"""
SELECT lang, CAST(unicode(c) AS BIGINT) AS byte, CAST(count(*) AS BIGINT) AS n
FROM (SELECT lang, unnest(string_split({g.utf8_byte_string('text')}, '')) AS c FROM documents) t
WHERE c <> '' GROUP BY lang, unicode(c)"""


def byte_length() -> str:
    return f"""
SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS n_chars, CAST(strlen(text) AS BIGINT) AS n_bytes,
       {g.div('strlen(text)', 'length(text)')} AS bytes_per_char
FROM documents"""


def utf8_overhead() -> str:
    return f"""
SELECT lang, docs, chars, bytes, words, {g.div('bytes', 'chars')} AS bytes_per_char,
       {g.div('chars', 'words')} AS chars_per_word
FROM (SELECT lang, CAST(count(*) AS BIGINT) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars,
             CAST(sum(strlen(text)) AS BIGINT) AS bytes,
             CAST(sum(len({g.words('text')})) AS BIGINT) AS words
      FROM documents GROUP BY lang) t"""


# ------------------------------------------------------- aggregations (2.3)

def word_freq() -> str:
    return f"""
SELECT word, freq, fo.doc AS first_doc, CAST(fo.pos AS BIGINT) AS first_pos
FROM ({g.corpus_words_cte(g.documents_corpus(None))}) t"""


def _initial_pairs() -> str:
    return f"""
WITH w AS (SELECT {g.utf8_byte_string('word')} AS tok, freq, fo
           FROM ({g.corpus_words_cte(g.documents_corpus(None))}) z),
pc AS (SELECT substr(tok, i + 1, 2) AS pair, CAST(sum(freq) AS BIGINT) AS n,
              min(struct_pack(so := fo.so, doc := fo.doc, pos := fo.pos, i := i)) AS first
       FROM (SELECT tok, freq, fo, unnest(range(0, length(tok) - 1)) AS i FROM w) e GROUP BY pair)"""


def pair_counts() -> str:
    return _initial_pairs() + """
SELECT CAST(unicode(substr(pair, 1, 1)) AS BIGINT) AS left_id,
       CAST(unicode(substr(pair, 2, 1)) AS BIGINT) AS right_id, n,
       first.doc AS first_doc, CAST(first.pos AS BIGINT) AS first_pos, CAST(first.i AS BIGINT) AS first_i
FROM pc"""


def pair_top() -> str:
    return _initial_pairs() + """
SELECT CAST(row_number() OVER (ORDER BY n DESC, first ASC) - 1 AS BIGINT) AS rank,
       CAST(unicode(substr(pair, 1, 1)) AS BIGINT) AS left_id,
       CAST(unicode(substr(pair, 2, 1)) AS BIGINT) AS right_id, n
FROM (SELECT * FROM pc WHERE n >= 2 ORDER BY n DESC, first ASC LIMIT 10) t"""


def merge_step() -> str:
    return _initial_pairs() + """,
best AS MATERIALIZED (SELECT coalesce(max(pair), '') AS pair
                      FROM (SELECT pair FROM pc WHERE n >= 2 ORDER BY n DESC, first ASC LIMIT 1) b),
words AS (SELECT word, freq FROM (""" + g.corpus_words_cte(g.documents_corpus(None)) + f""") y)
SELECT word, freq, CAST(length(tok) AS BIGINT) AS tokens_before,
       CAST(CASE WHEN pair = '' THEN length(tok) ELSE length(replace(tok, pair, {g.chr_id(256)})) END AS BIGINT) AS tokens_after
FROM (SELECT word, freq, {g.utf8_byte_string('word')} AS tok FROM words) w CROSS JOIN best"""


# ----------------------------------------------------------- training (2.6)

def _doc_training(prefix: str = "t", mix=None):
    return g.train_ctes(prefix, g.documents_corpus(mix), DOC_MERGES)


def train_rules() -> str:
    ctes, pairs = _doc_training()
    return _with(ctes, g.rules_select(pairs))


def rules_top10() -> str:
    return rule_labels() + " WHERE rank < 10"


def rule_labels() -> str:
    ctes, pairs = _doc_training()
    return _with(ctes, f"""
SELECT rank, {g.token_label('left_id')} AS left_label, {g.token_label('right_id')} AS right_label,
       new_id, n
FROM ({g.rules_select(pairs)}) r""")


def train_compression() -> str:
    ctes, pairs = _doc_training()
    return _with(ctes, f"""
SELECT tokens_before, tokens_after, {g.div('tokens_after', 'tokens_before')} AS ratio
FROM (SELECT CAST(sum(freq * length(tok)) AS BIGINT) AS tokens_before,
             CAST(sum(freq * length({g.apply_trained('tok', pairs)})) AS BIGINT) AS tokens_after
      FROM t_w0) s""")


def train_sequences() -> str:
    ctes, pairs = _doc_training()
    return _with(ctes, f"""
SELECT word, freq, CAST(length(t) AS BIGINT) AS n_tokens, {g.ids_text('t')} AS ids
FROM (SELECT word, freq, {g.apply_trained('tok', pairs)} AS t FROM t_w0) s""")


# ------------------------------------------------------------- encode (2.6)

def encode_word_rules() -> str:
    return f"""
WITH w AS (SELECT {g.utf8_byte_string('word')} AS tok, freq FROM ({g.corpus_words_cte(g.documents_corpus(None))}) z),
top AS (SELECT * FROM (SELECT tok, row_number() OVER (ORDER BY freq DESC, tok) AS r FROM w WHERE length(tok) >= 2) t
        WHERE r <= {SPELLED_WORDS}),
starts AS (SELECT p, row_number() OVER (ORDER BY min(r), length(p)) - 1 AS k
           FROM (SELECT substr(tok, 1, i) AS p, r FROM (SELECT tok, r, unnest(range(2, length(tok) + 1)) AS i FROM top) t) t GROUP BY p),
rules AS (SELECT list((CASE WHEN length(a.p) = 2 THEN substr(a.p, 1, 1) ELSE chr(CAST(256 + b.k AS INTEGER)) END)
                      || substr(a.p, length(a.p), 1) || chr(CAST(256 + a.k AS INTEGER)) ORDER BY a.k) AS rules, count(*) AS n
          FROM starts a LEFT JOIN starts b ON b.p = substr(a.p, 1, length(a.p) - 1) AND length(a.p) > 2)
SELECT doc_id, lang, CAST(n AS BIGINT) AS n_rules,
       CAST(length(list_reduce(list_concat([{g.utf8_byte_string('text')}], rules),
                               lambda t, r: replace(t, substr(r, 1, 2), substr(r, 3, 1)))) AS BIGINT) AS tokens
FROM documents, rules"""


def encode_counts() -> str:
    return f"""
SELECT doc_id, lang, n_bytes, tokens, {g.div('tokens', 'n_bytes')} AS tokens_per_byte
FROM (SELECT doc_id, lang, CAST(strlen(text) AS BIGINT) AS n_bytes,
             CAST(length({_enc('text')}) AS BIGINT) AS tokens FROM documents) t"""


def encode_ids() -> str:
    return f"""
SELECT doc_id, CAST(length(t) AS BIGINT) AS tokens, {g.ids_text('t')} AS ids
FROM (SELECT doc_id, {_enc('text')} AS t FROM documents) s"""


def _by_lang_sql(tok_sql_of_text: str, table: str = "documents") -> str:
    return f"""
SELECT lang, docs, bytes, chars, words, tokens,
       {g.div('tokens', 'bytes')} AS tokens_per_byte, {g.div('tokens', 'chars')} AS tokens_per_char,
       {g.div('tokens', 'words')} AS tokens_per_word
FROM (SELECT lang, CAST(count(*) AS BIGINT) AS docs, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
             CAST(sum(length(text)) AS BIGINT) AS chars,
             CAST(sum(len({g.words('text')})) AS BIGINT) AS words,
             CAST(sum(length({tok_sql_of_text})) AS BIGINT) AS tokens
      FROM {table} GROUP BY lang) t"""


def tokens_by_lang() -> str:
    return _by_lang_sql(_enc("text"))


def encode_dedup() -> str:
    return _by_lang_sql(_enc("text"))


def vs_baseline() -> str:
    return f"""
WITH t AS ({_by_lang_sql(_enc('text'))})
SELECT lang, tokens_per_byte, tokens_per_word,
       tokens_per_byte / (SELECT tokens_per_byte FROM t WHERE lang = {g.q(BASELINE_LANG)}) AS tpb_vs_en,
       tokens_per_word / (SELECT tokens_per_word FROM t WHERE lang = {g.q(BASELINE_LANG)}) AS tpw_vs_en
FROM t"""


def _gap(before: str, after: str) -> str:
    en = g.q(BASELINE_LANG)
    return f"""
SELECT b.lang, b.tokens_per_byte AS value_before,
       b.tokens_per_byte / (SELECT tokens_per_byte FROM {before} WHERE lang = {en}) AS gap_before,
       a.tokens_per_byte AS value_after,
       a.tokens_per_byte / (SELECT tokens_per_byte FROM {after} WHERE lang = {en}) AS gap_after
FROM {before} b JOIN {after} a USING (lang) WHERE b.lang <> {en}"""


def gap_reduction() -> str:
    hc, hp = _doc_training("h", DOCUMENT_MIXES["en_heavy"])
    bc, bp = _doc_training("b", DOCUMENT_MIXES["balanced_fr"])
    heavy = _by_lang_sql(g.apply_trained(g.utf8_byte_string("text"), hp))
    bal = _by_lang_sql(g.apply_trained(g.utf8_byte_string("text"), bp))
    ctes = hc + bc + [f"heavy AS ({heavy})", f"bal AS ({bal})", f"gaps AS ({_gap('heavy', 'bal')})"]
    return _with(ctes, """
SELECT lang, value_before, gap_before, value_after, gap_after,
       (CAST(1 AS DOUBLE) - gap_after / gap_before) * CAST(100 AS DOUBLE) AS reduction_pct
FROM gaps""")


def gap_compare() -> str:
    hc, hp = _doc_training("h", DOCUMENT_MIXES["en_heavy"])
    fc, fp = _doc_training("f", DOCUMENT_MIXES["balanced_fr"])
    dc, dp = _doc_training("d", DOCUMENT_MIXES["balanced_de"])
    ctes = hc + fc + dc + [
        f"heavy AS ({_by_lang_sql(g.apply_trained(g.utf8_byte_string('text'), hp))})",
        f"bal_fr AS ({_by_lang_sql(g.apply_trained(g.utf8_byte_string('text'), fp))})",
        f"bal_de AS ({_by_lang_sql(g.apply_trained(g.utf8_byte_string('text'), dp))})",
        f"g_fr AS ({_gap('heavy', 'bal_fr')})",
        f"g_de AS ({_gap('heavy', 'bal_de')})",
    ]
    return _with(ctes, """
SELECT x.lang, h.tokens AS heavy_tokens, bf.tokens AS balanced_tokens,
       (CAST(1 AS DOUBLE) - x.gap_after / x.gap_before) * CAST(100 AS DOUBLE) AS gap_reduction_pct
FROM g_fr x JOIN heavy h USING (lang) JOIN bal_fr bf USING (lang) WHERE x.lang = 'fr'
UNION ALL
SELECT x.lang, h.tokens AS heavy_tokens, bd.tokens AS balanced_tokens,
       (CAST(1 AS DOUBLE) - x.gap_after / x.gap_before) * CAST(100 AS DOUBLE) AS gap_reduction_pct
FROM g_de x JOIN heavy h USING (lang) JOIN bal_de bd USING (lang) WHERE x.lang = 'de'""")


# ------------------------------------------------------------ bolt-on (2.6)

def _hits(pattern: str) -> str:
    return (f"SELECT m AS term, CAST(count(*) AS BIGINT) AS hits "
            f"FROM (SELECT unnest({g.vocab_matches('text', pattern)}) AS m FROM documents) t GROUP BY m")


def vocab_build() -> str:
    return f"""
WITH v AS ({g.vocab_table(_vocab_rows(), FIRST_VOCAB_ID)}), h AS ({_hits(_pattern())})
SELECT token_id, term, n_bytes, term || ' (' || label || ')' AS display,
       CAST(coalesce(hits, 0) AS BIGINT) AS hits
FROM v LEFT JOIN h USING (term)"""


def vocab_added() -> str:
    return f"""
WITH vin AS ({g.vocab_values(_vocab_rows())}),
v AS ({g.vocab_table(_vocab_rows(), FIRST_VOCAB_ID)}),
h AS ({_hits(_pattern())}),
offered AS (SELECT group_ord, label, count(*) AS offered FROM vin GROUP BY group_ord, label),
added AS (SELECT group_ord, label, count(*) AS added FROM v GROUP BY group_ord, label),
used AS (SELECT group_ord, label, count(*) AS used FROM v JOIN h USING (term) GROUP BY group_ord, label),
per AS (SELECT o.group_ord, o.label, o.offered, coalesce(a.added, 0) AS added, coalesce(u.used, 0) AS used
        FROM offered o LEFT JOIN added a USING (group_ord, label) LEFT JOIN used u USING (group_ord, label))
SELECT CAST(group_ord AS BIGINT) AS group_ord, label, CAST(sum(offered) AS BIGINT) AS offered,
       CAST(sum(added) AS BIGINT) AS added, CAST(sum(used) AS BIGINT) AS used
FROM per GROUP BY ROLLUP (group_ord, label)
HAVING label IS NOT NULL OR group_ord IS NULL"""


def vocab_match() -> str:
    return f"""
SELECT doc_id, CAST(len(m) AS BIGINT) AS matches,
       CAST(coalesce(list_sum(list_transform(m, lambda x: strlen(x))), 0) AS BIGINT) AS matched_bytes,
       CAST(len(list_distinct(m)) AS BIGINT) AS distinct_terms
FROM (SELECT doc_id, {g.vocab_matches('text', _pattern())} AS m FROM documents) t"""


def vocab_hits_by_label() -> str:
    return f"""
WITH v AS ({g.vocab_table(_vocab_rows(), FIRST_VOCAB_ID)}), h AS ({_hits(_pattern())})
SELECT label, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(hits * n_bytes) AS BIGINT) AS matched_bytes
FROM h JOIN v USING (term) GROUP BY label"""


def _cjk(sql: str) -> str:
    """The same query over documents mapped to the vocabulary's scripts."""
    mapped = f"cjk AS (SELECT doc_id, lang, translate(text, {g.q(CJK_FROM)}, {g.q(CJK_TO)}) AS text FROM documents)"
    return f"WITH {mapped}\n{sql.replace('FROM documents', 'FROM cjk')}"


def vocab_match_cjk() -> str:
    return _cjk(vocab_match())


def vocab_match_join() -> str:
    return f"""
WITH v AS ({g.vocab_table(_vocab_rows(), FIRST_VOCAB_ID)}),
m AS (SELECT doc_id, unnest({g.vocab_matches('text', _pattern())}) AS term FROM documents)
SELECT term, token_id, CAST(count(*) AS BIGINT) AS hits, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs
FROM m JOIN v USING (term) GROUP BY term, token_id"""


def _bolt_count(runs_col: str) -> str:
    return f"length({g.bolt_token_string_counting(runs_col, RULES)})"


def bolt_counts() -> str:
    return f"""
SELECT doc_id, lang, CAST(length({_enc('text')}) AS BIGINT) AS tokens_before,
       CAST({_bolt_count('runs')} AS BIGINT) AS tokens_after
FROM (SELECT doc_id, lang, text, {g.vocab_runs('text', _pattern())} AS runs FROM documents) t"""


def bolt_counts_cjk() -> str:
    return _cjk(bolt_counts())


def _bolt_strings(labels=None) -> str:
    """``(doc_id, lang, t)``: token strings; ids come from the vocabulary table."""
    t = g.bolt_token_string("runs", "ms", "idmap[{m}]", RULES)
    return f"""
SELECT doc_id, lang, {t} AS t
FROM (SELECT doc_id, lang, idmap, {g.vocab_runs('text', _pattern(labels))} AS runs,
             {g.vocab_matches('text', _pattern(labels))} AS ms
      FROM documents CROSS JOIN ({_idmap(labels)}) i) a"""


def _idmap(labels=None) -> str:
    return (f"SELECT map(list(term), list(chr(CAST(token_id AS INTEGER)))) AS idmap "
            f"FROM ({g.vocab_table(_vocab_rows(labels), FIRST_VOCAB_ID)}) v")


def bolt_ids() -> str:
    return f"""
SELECT doc_id, CAST(length(t) AS BIGINT) AS tokens, {g.ids_text('t')} AS ids
FROM ({_bolt_strings()}) b"""


def bolt_ids_cjk() -> str:
    return _cjk(bolt_ids())


def variant_counts() -> str:
    parts = [f"SELECT 'base' AS variant, lang, CAST(sum(length({_enc('text')})) AS BIGINT) AS tokens "
             f"FROM documents GROUP BY lang"]
    for variant, labels in fx.VOCAB_VARIANTS.items():
        parts.append(
            f"SELECT {g.q(variant)} AS variant, lang, CAST(sum({_bolt_count('runs')}) AS BIGINT) AS tokens "
            f"FROM (SELECT lang, {g.vocab_runs('text', _pattern(labels))} AS runs FROM documents) t "
            f"GROUP BY lang")
    assert [p.split("'")[1] for p in parts] == VARIANTS
    return "\nUNION ALL\n".join(parts)


def variant_counts_cjk() -> str:
    return _cjk(variant_counts())


def before_after() -> str:
    return f"""
WITH {_before_after()}
SELECT lang, t0 AS before, t1 AS after, {g.div('t0', 'bytes')} AS tpb_before, {g.div('t1', 'bytes')} AS tpb_after
FROM ba"""


def _before_after() -> str:
    return f"""
ba AS (SELECT lang, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
              CAST(sum(length({_enc('text')})) AS BIGINT) AS t0,
              CAST(sum({_bolt_count('runs')}) AS BIGINT) AS t1
       FROM (SELECT lang, text, {g.vocab_runs('text', _pattern())} AS runs FROM documents) t
       GROUP BY lang)"""


def bolt_reduction() -> str:
    en = g.q(BASELINE_LANG)
    return f"""
WITH {_before_after()},
base AS (SELECT {g.div('t0', 'bytes')} AS b FROM ba WHERE lang = {en})
SELECT lang, t0 AS before, t1 AS after, t0 - t1 AS reduction,
       CASE WHEN t0 - t1 > 0 THEN CAST(t0 - t1 AS DOUBLE) / CAST(t0 AS DOUBLE) * CAST(100 AS DOUBLE) END
         AS reduction_pct,
       {g.div('t0', 'bytes')} / (SELECT b FROM base) AS mult_before,
       {g.div('t1', 'bytes')} / (SELECT b FROM base) AS mult_after
FROM ba"""


def token_cost() -> str:
    price = f"CAST({fx.PRICE_PER_TOKEN!r} AS DOUBLE)"
    return f"""
WITH {_before_after()},
c AS (SELECT lang, t0 AS before, t1 AS after,
             CAST(t0 AS DOUBLE) * CAST({fx.SEND_VOLUME} AS DOUBLE) * {price} AS cost_before,
             CAST(t1 AS DOUBLE) * CAST({fx.SEND_VOLUME} AS DOUBLE) * {price} AS cost_after FROM ba)
SELECT lang, before, after, cost_before, cost_after,
       CASE WHEN cost_before - cost_after > 0 THEN cost_before - cost_after END AS saved
FROM c"""


def vocab_growth() -> str:
    variants = {"base": None} | fx.VOCAB_VARIANTS
    parts = []
    for variant, labels in variants.items():
        if labels is None:
            added, strings = "0", f"SELECT {_enc('text')} AS t FROM documents"
        else:
            added = f"(SELECT count(*) FROM ({g.vocab_table(_vocab_rows(labels), FIRST_VOCAB_ID)}) v)"
            strings = _bolt_strings(labels)
        parts.append(f"""SELECT {g.q(variant)} AS variant, CAST({added} AS BIGINT) AS added,
       (SELECT CAST(count(DISTINCT c) AS BIGINT)
        FROM (SELECT unnest(string_split(t, '')) AS c FROM ({strings}) s) u WHERE c <> '') AS used_ids""")
    return "WITH a AS (" + "\nUNION ALL\n".join(parts) + f""")
SELECT variant, CAST(256 AS BIGINT) AS base, CAST({len(RULES)} AS BIGINT) AS rules, added,
       CAST(256 + {len(RULES)} + added AS BIGINT) AS vocab_size, used_ids
FROM a"""


def conversation_tokens() -> str:
    return f"""
SELECT role, turns, bytes, tokens, bolt_tokens, {g.div('tokens', 'bytes')} AS tokens_per_byte
FROM (SELECT role, CAST(count(*) AS BIGINT) AS turns, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
             CAST(sum(length({_enc('text')})) AS BIGINT) AS tokens,
             CAST(sum({_bolt_count('runs')}) AS BIGINT) AS bolt_tokens
      FROM (SELECT role, text, {g.vocab_runs('text', _pattern())} AS runs FROM conversations) c
      GROUP BY role) t"""


ORACLES = {
    "corpus_mix": corpus_mix,
    "corpus_words": corpus_words,
    "pretokenize": pretokenize,
    "utf8_bytes": utf8_bytes,
    "byte_length": byte_length,
    "utf8_overhead": utf8_overhead,
    "word_freq": word_freq,
    "pair_counts": pair_counts,
    "pair_top": pair_top,
    "merge_step": merge_step,
    "train_rules": train_rules,
    "train_rules_indexed": train_rules,
    "rules_top10": rules_top10,
    "train_compression": train_compression,
    "train_sequences": train_sequences,
    "encode_counts": encode_counts,
    "encode_queue": encode_counts,
    "sql_tokens": encode_counts,
    "encode_word_rules": encode_word_rules,
    "encode_ids": encode_ids,
    "tokens_by_lang": tokens_by_lang,
    "encode_dedup": encode_dedup,
    "encode_stored": encode_dedup,
    "vs_baseline": vs_baseline,
    "gap_reduction": gap_reduction,
    "gap_compare": gap_compare,
    "vocab_build": vocab_build,
    "vocab_added": vocab_added,
    "vocab_match": vocab_match,
    "vocab_hits_by_label": vocab_hits_by_label,
    "bolt_counts": bolt_counts,
    "bolt_ids": bolt_ids,
    "variant_counts": variant_counts,
    "bolt_reduction": bolt_reduction,
    "token_cost": token_cost,
    "vocab_growth": vocab_growth,
    "corpora_union": corpora_union,
    "rule_labels": rule_labels,
    "vocab_match_cjk": vocab_match_cjk,
    "vocab_match_join": vocab_match_join,
    "bolt_counts_cjk": bolt_counts_cjk,
    "bolt_ids_cjk": bolt_ids_cjk,
    "variant_counts_cjk": variant_counts_cjk,
    "before_after": before_after,
    "conversation_tokens": conversation_tokens,
}


def oracle_sql() -> dict[str, str]:
    return {name: fn() for name, fn in ORACLES.items()}
