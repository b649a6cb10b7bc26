"""SQL fragments for the DuckDB oracle (``oracle_sql``).

The oracle is written independently of the Spark code path: plain SQL over
the driver's views, one-merge-per-step training as unrolled ``MATERIALIZED``
CTEs, and a flat longest-first alternation for the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from tokenledger.functions.text import WS_PATTERN
from tokenledger.functions.tokens import SURROGATE_LO, SURROGATE_SHIFT
from tokenledger.functions.vocab import BARRIER, flat_pattern


def q(s: str) -> str:
    """SQL string literal (DuckDB does not process backslashes)."""
    return "'" + s.replace("'", "''") + "'"


def chr_id(token_id: int) -> str:
    cp = token_id + SURROGATE_SHIFT if token_id >= SURROGATE_LO else token_id
    return f"chr({cp})"


def words(text: str) -> str:
    """``text.split()`` as a list."""
    return f"list_filter(regexp_split_to_array({text}, {q(WS_PATTERN)}), lambda x: x <> '')"


def utf8_byte_string(text: str) -> str:
    """One character per UTF-8 byte, computed from each code point."""
    u = "unicode(c)"
    two = f"chr(192 | ({u} >> 6)) || chr(128 | ({u} & 63))"
    three = f"chr(224 | ({u} >> 12)) || chr(128 | (({u} >> 6) & 63)) || chr(128 | ({u} & 63))"
    four = (f"chr(240 | ({u} >> 18)) || chr(128 | (({u} >> 12) & 63)) || "
            f"chr(128 | (({u} >> 6) & 63)) || chr(128 | ({u} & 63))")
    per_char = (f"CASE WHEN {u} < 128 THEN c WHEN {u} < 2048 THEN {two} "
                f"WHEN {u} < 65536 THEN {three} ELSE {four} END")
    return f"array_to_string(list_transform(string_split({text}, ''), lambda c: {per_char}), '')"


def apply_rules(tok: str, rules) -> str:
    """Nested ``replace`` for a fixed rule list (rank order)."""
    out = tok
    for r in rules:
        out = f"replace({out}, {chr_id(r.left)} || {chr_id(r.right)}, {chr_id(r.new_id)})"
    return out


def token_ids(tok: str) -> str:
    cp = "unicode(c)"
    lo = SURROGATE_LO + SURROGATE_SHIFT
    return (f"list_transform(list_filter(string_split({tok}, ''), lambda c: c <> ''), "
            f"lambda c: CASE WHEN {cp} >= {lo} THEN {cp} - {SURROGATE_SHIFT} ELSE {cp} END)")


def ids_text(tok: str) -> str:
    return f"array_to_string({token_ids(tok)}, ' ')"


def token_label(i: str) -> str:
    return f"CASE WHEN {i} < 128 THEN chr(CAST({i} AS INTEGER)) ELSE '[' || CAST({i} AS VARCHAR) || ']' END"


# ---------------------------------------------------------------- training

NO_PAIR = "chr(1114111) || chr(1114111)"  # never occurs in a token string


def corpus_words_cte(corpus_select: str) -> str:
    """Distinct words of a corpus ``(so, doc, weight, text)`` with first occurrence."""
    return f"""
    SELECT word, CAST(sum(weight) AS BIGINT) AS freq,
           min(struct_pack(so := so, doc := doc, pos := pos)) AS fo
    FROM (
        SELECT so, doc, weight, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos
        FROM (SELECT so, doc, weight, {words('text')} AS ws FROM ({corpus_select}) c) x
    ) y
    GROUP BY word"""


def train_ctes(prefix: str, corpus_select: str, num_merges: int,
               first_id: int = 256) -> tuple[list[str], list[str]]:
    """Unrolled one-merge-per-step training.

    Returns ``(ctes, pair_ctes)``: the CTE definitions and, per step, the
    name of a one-row (or empty) CTE ``(pair, n)`` holding that step's winner.
    Once a step finds no pair with ``n >= 2`` every later step is empty too.
    """
    ctes = [f"{prefix}_w0 AS MATERIALIZED (SELECT word, {utf8_byte_string('word')} AS tok, freq, fo "
            f"FROM ({corpus_words_cte(corpus_select)}) z)"]
    pairs = []
    for k in range(1, num_merges + 1):
        prev = f"{prefix}_w{k - 1}"
        p = f"{prefix}_p{k}"
        ctes.append(f"""{p} AS MATERIALIZED (
    SELECT pair, n FROM (
        SELECT substr(tok, i + 1, 2) AS pair, CAST(sum(freq) AS BIGINT) AS n,
               min(struct_pack(so := fo.so, doc := fo.doc, pos := fo.pos, i := i)) AS first
        FROM (SELECT tok, freq, fo, unnest(range(0, length(tok) - 1)) AS i FROM {prev}) e
        GROUP BY pair
    ) g WHERE n >= 2 ORDER BY n DESC, first ASC LIMIT 1)""")
        if k < num_merges:
            ctes.append(f"{prefix}_w{k} AS MATERIALIZED (SELECT replace(tok, "
                        f"coalesce((SELECT pair FROM {p}), {NO_PAIR}), {chr_id(first_id + k - 1)}) "
                        f"AS tok, word, freq, fo FROM {prev})")
        pairs.append(p)
    return ctes, pairs


def apply_trained(tok: str, pair_ctes: Sequence[str], first_id: int = 256) -> str:
    out = tok
    for k, p in enumerate(pair_ctes):
        out = (f"replace({out}, coalesce((SELECT pair FROM {p}), {NO_PAIR}), "
               f"{chr_id(first_id + k)})")
    return out


def rules_select(pair_ctes: Sequence[str], first_id: int = 256) -> str:
    """The learned rules ``(rank, left, right, new_id, n)`` from the step CTEs."""
    parts = []
    for k, p in enumerate(pair_ctes):
        parts.append(f"SELECT {k} AS rank, unicode(substr(pair, 1, 1)) AS l, "
                     f"unicode(substr(pair, 2, 1)) AS r, {first_id + k} AS new_id, n FROM {p}")
    inner = " UNION ALL ".join(parts)
    return (f"SELECT CAST(rank AS BIGINT) AS rank, CAST(l AS BIGINT) AS left_id, "
            f"CAST(r AS BIGINT) AS right_id, CAST(new_id AS BIGINT) AS new_id, n FROM ({inner}) u")


def documents_corpus(mix: Sequence[tuple[str, int]] | None) -> str:
    """SQL corpus ``(so, doc, weight, text)`` over the documents view."""
    if mix is None:
        return "SELECT 0 AS so, doc_id AS doc, CAST(1 AS BIGINT) AS weight, text FROM documents"
    so = " ".join(f"WHEN {q(lang)} THEN {i}" for i, (lang, _) in enumerate(mix))
    wt = " ".join(f"WHEN {q(lang)} THEN {w}" for lang, w in mix)
    langs = ", ".join(q(lang) for lang, _ in mix)
    return (f"SELECT CASE lang {so} END AS so, doc_id AS doc, "
            f"CAST(CASE lang {wt} END AS BIGINT) AS weight, text FROM documents "
            f"WHERE lang IN ({langs})")


# ---------------------------------------------------------------- vocabulary

def vocab_values(rows: Sequence[tuple[int, int, str, str]]) -> str:
    vals = ", ".join(f"({g}, {i}, {q(t)}, {q(lab)})" for g, i, t, lab in rows)
    return f"SELECT * FROM (VALUES {vals}) v(group_ord, item_ord, term, label)"


def vocab_table(rows: Sequence[tuple[int, int, str, str]], first_id: int) -> str:
    """Vocabulary ids: skip <= 1 byte, first entry wins, consecutive ids."""
    return f"""
    SELECT CAST(row_number() OVER (ORDER BY group_ord, item_ord) + {first_id - 1} AS BIGINT) AS token_id,
           term, CAST(strlen(term) AS BIGINT) AS n_bytes, label, group_ord, item_ord
    FROM (
        SELECT *, row_number() OVER (PARTITION BY term ORDER BY group_ord, item_ord) AS k
        FROM ({vocab_values(rows)}) a WHERE strlen(term) > 1
    ) b WHERE k = 1"""


def vocab_pattern(terms: Sequence[str]) -> str:
    return q(flat_pattern(t for t in terms if len(t.encode("utf-8")) > 1))


def vocab_runs(text: str, pattern_sql: str) -> str:
    return f"regexp_split_to_array({text}, {pattern_sql})"


def vocab_matches(text: str, pattern_sql: str) -> str:
    return f"regexp_extract_all({text}, {pattern_sql})"


def bolt_token_string_counting(runs: str, rules) -> str:
    """Byte runs joined by the barrier character (``runs`` is a list column)."""
    joined = (f"array_to_string(list_transform({runs}, lambda r: {utf8_byte_string('r')}), "
              f"chr({ord(BARRIER)}))")
    return apply_rules(joined, rules)


def bolt_token_string(runs: str, matches: str, id_case: str, rules) -> str:
    """Interleave byte runs with the matched entries' id characters.

    ``runs`` and ``matches`` are list columns computed once in a subquery.
    """
    body = (f"array_to_string(list_transform(range(1, len({runs}) + 1), lambda k: "
            f"{utf8_byte_string(f'{runs}[k]')} || "
            f"coalesce(({id_case.replace('{m}', f'{matches}[k]')}), '')), '')")
    return apply_rules(body, rules)


def id_char_case(entries: Sequence[tuple[str, int]]) -> str:
    """``CASE {m} WHEN term THEN chr(id) ... END`` (``{m}`` is substituted)."""
    whens = " ".join(f"WHEN {q(t)} THEN {chr_id(i)}" for t, i in entries)
    return f"CASE {{m}} {whens} END"


def div(a: str, b: str) -> str:
    """``a / b`` as double, null when ``b`` is 0 (Spark's ``try_divide``)."""
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"
