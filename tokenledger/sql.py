"""The tokenizer from SQL: functions of a rule list and a vocabulary.

``register`` creates temporary SQL functions whose bodies are native
expressions, so Catalyst puts them into the plan of the query that calls them:
no Python runs and filters and columns are pruned as usual.

===================================  =======================================
``bpe_tokens(text)``                 number of tokens
``bpe_ids(text)``                    token ids
``bpe_label(id)``                    display label of an id
``bpe_rules()``                      table of the rules
``bolt_tokens(text)``                number of tokens with the vocabulary
``bolt_matches(text)``               table of its matches, in text order
``bolt_vocab()``                     table of the vocabulary
===================================  =======================================

``prefix`` and ``bolt_prefix`` name other sets next to each other.  The bodies
hold the rules as nested ``replace``, so lists are bounded by
``NESTED_REPLACE_LIMIT`` and vocabularies by ``REGEX_ENTRIES``; larger ones run
through the DataFrame operators.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tokenledger.functions.tokens import NESTED_REPLACE_LIMIT, SURROGATE_LO, SURROGATE_SHIFT, id_to_char, validate_rules
from tokenledger.functions.vocab import BARRIER, BARRIER_BYTES, trie_pattern

_PLAIN = re.compile(r"[A-Za-z0-9 ]")


def literal(value: str) -> str:
    """A SQL string literal of any text."""
    return "'" + "".join(c if _PLAIN.match(c) else f"\\U{ord(c):08X}" for c in value) + "'"


def _bytes(text: str) -> str:
    return f"decode(encode({text}, 'UTF-8'), 'ISO-8859-1')"


def _merged(tokens: str, rules) -> str:
    for left, right, new in validate_rules(rules):
        tokens = f"replace({tokens}, {literal(id_to_char(left) + id_to_char(right))}, {literal(id_to_char(new))})"
    return tokens


def _create(spark: SparkSession, signature: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")


def register_rules(spark: SparkSession, rules: Sequence, prefix: str = "bpe") -> None:
    """``<prefix>_tokens``, ``_ids``, ``_label`` and the table ``_rules``."""
    if len(rules) > NESTED_REPLACE_LIMIT:
        raise ValueError(f"at most {NESTED_REPLACE_LIMIT} rules in a SQL function; use operators.encode")
    encoded = _merged(_bytes("text"), rules)
    _create(spark, f"{prefix}_tokens(text STRING)", "BIGINT", f"char_length({encoded})")
    _create(spark, f"{prefix}_ids(text STRING)", "ARRAY<INT>",
            f"transform(filter(split({encoded}, ''), c -> c <> ''), "
            f"c -> IF(ascii(c) >= {SURROGATE_LO + SURROGATE_SHIFT}, ascii(c) - {SURROGATE_SHIFT}, ascii(c)))")
    _create(spark, f"{prefix}_label(id INT)", "STRING", "IF(id < 128, char(id), concat('[', CAST(id AS STRING), ']'))")
    rows = ", ".join(f"({r.rank}, {r.left}, {r.right}, {r.new_id}, {r.n}L)" for r in rules)
    table = f"SELECT * FROM VALUES {rows} AS r(rank, left_id, right_id, new_id, n)" if rows else (
        "SELECT 0, 0, 0, 0, 0L WHERE false")
    _create(spark, f"{prefix}_rules()", "TABLE(rank INT, left_id INT, right_id INT, new_id INT, n BIGINT)", table)


def register_vocabulary(spark: SparkSession, entries: Sequence[tuple[str, int]], rules: Sequence, prefix: str = "bolt") -> None:
    """``<prefix>_tokens`` and the tables ``_matches`` and ``_vocab`` of a
    vocabulary ``(term, token id)`` on top of the rules."""
    from tokenledger.operators.vocab import REGEX_ENTRIES

    if len(entries) > REGEX_ENTRIES or len(rules) > NESTED_REPLACE_LIMIT:
        raise ValueError("too large for a SQL function; use operators.scan")
    pattern = literal(trie_pattern(t for t, _ in entries))
    mark, mark_bytes = literal(BARRIER), literal(BARRIER_BYTES)
    marked = f"replace({_bytes(f'regexp_replace(text, {pattern}, {mark})')}, {mark_bytes}, {mark})"
    # a text that holds the barrier itself is cut at its matches instead
    cut = f"array_join(transform(split(text, {pattern}, -1), run -> {_bytes('run')}), {mark})"
    body = _merged(f"IF(instr(text, {mark}) > 0, {cut}, {marked})", rules)
    _create(spark, f"{prefix}_tokens(text STRING)", "BIGINT", f"char_length({body})")
    _create(spark, f"{prefix}_matches(text STRING)", "TABLE(pos INT, term STRING)",
            f"SELECT p.pos, p.col FROM (SELECT posexplode(regexp_extract_all(text, {pattern}, 0))) AS p(pos, col)")
    rows = ", ".join(f"({i}, {literal(t)})" for t, i in entries)
    table = f"SELECT * FROM VALUES {rows} AS v(token_id, term)" if rows else "SELECT 0, '' WHERE false"
    _create(spark, f"{prefix}_vocab()", "TABLE(token_id INT, term STRING)", table)


def register(spark: SparkSession, rules: Sequence, vocab=None, prefix: str = "bpe", bolt_prefix: str = "bolt") -> None:
    """Functions of a rule list and, if given, of a vocabulary table."""
    register_rules(spark, rules, prefix)
    if vocab is not None:
        rows = vocab.select("term", "token_id").orderBy("token_id").collect()
        register_vocabulary(spark, [(r["term"], int(r["token_id"])) for r in rows], rules, bolt_prefix)
