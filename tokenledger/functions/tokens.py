"""Token strings: one character per token id, so a merge is a ``replace``.

Token id ``n`` is the character with code point ``n``; ids from 0xD800 up
skip the surrogate block (``n + 0x800``).  Bytes 0..255 are ids 0..255, so
``utf8_byte_string`` is the initial token string.  ``replace`` is a single
left-to-right, non-overlapping pass -- exactly one BPE merge -- and
``char_length`` is the token count.  Everything stays in native Spark
expressions (whole-stage codegen), no Python in the hot path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenledger.functions.text import _col, utf8_byte_string

SURROGATE_LO = 0xD800
SURROGATE_SHIFT = 0x800
MAX_TOKEN_ID = 0x10FFFF - SURROGATE_SHIFT

# Rule sets longer than this are applied with one ``aggregate`` fold over an
# array literal instead of nested ``replace`` calls, which keeps the generated
# code below the JVM method-size limit.
NESTED_REPLACE_LIMIT = 200


def id_to_char(token_id: int) -> str:
    if token_id < 0 or token_id > MAX_TOKEN_ID:
        raise ValueError(f"token id out of range: {token_id}")
    return chr(token_id + SURROGATE_SHIFT if token_id >= SURROGATE_LO else token_id)


def char_to_id(ch: str) -> int:
    cp = ord(ch)
    return cp - SURROGATE_SHIFT if cp >= SURROGATE_LO + SURROGATE_SHIFT else cp


def ids_to_token_string(ids: Sequence[int]) -> str:
    return "".join(id_to_char(i) for i in ids)


def token_string_to_ids(s: str) -> list[int]:
    return [char_to_id(c) for c in s]


def _rule_triples(rules) -> list[tuple[int, int, int]]:
    out = []
    for r in rules:
        if hasattr(r, "left"):
            out.append((int(r.left), int(r.right), int(r.new_id)))
        else:
            out.append((int(r[0]), int(r[1]), int(r[2])))
    return out


def validate_rules(rules) -> list[tuple[int, int, int]]:
    """Check what the encoder relies on: fresh ids that differ from their parts."""
    triples = _rule_triples(rules)
    seen_new: set[int] = set()
    for left, right, new in triples:
        if new in (left, right):
            raise ValueError(f"rule ({left},{right})->{new}: new id equals a part")
        if new in seen_new:
            raise ValueError(f"rule id {new} defined twice")
        if new < 256:
            raise ValueError(f"rule id {new} collides with a byte")
        seen_new.add(new)
    return triples


def apply_rules(tok: Column | str, rules, pad_to: int | None = None) -> Column:
    """Fold the merge rules, in rank order, over a token-string column.

    ``pad_to`` appends no-op steps (``replace`` with an empty search string
    returns at once) up to that many, so chains of different lengths share
    one generated-code shape and the compiled code is reused from Spark's
    cache.
    """
    triples = validate_rules(rules)
    c = _col(tok)
    if len(triples) <= NESTED_REPLACE_LIMIT:
        for left, right, new in triples:
            c = F.replace(c, F.lit(id_to_char(left) + id_to_char(right)), F.lit(id_to_char(new)))
        for _ in range(max(0, (pad_to or 0) - len(triples))):
            c = F.replace(c, F.lit(""), F.lit(""))
        return c
    pairs = F.array(*[F.lit(id_to_char(l) + id_to_char(r)) for l, r, _ in triples])
    news = F.array(*[F.lit(id_to_char(n)) for _, _, n in triples])
    rule_arr = F.arrays_zip(pairs.alias("p"), news.alias("n"))
    return F.aggregate(rule_arr, c, lambda acc, r: F.replace(acc, r["p"], r["n"]))


def encode_token_string(text: Column | str, rules) -> Column:
    """``tokenize(text, rules)`` as a token string."""
    return apply_rules(utf8_byte_string(text), rules)


def token_count(text: Column | str, rules) -> Column:
    """``len(tokenize(text, rules))``; null text gives null, empty text 0."""
    return F.char_length(encode_token_string(text, rules))


def token_string_ids(tok: Column | str) -> Column:
    """Token string -> ``array<int>`` of token ids."""
    chars = F.filter(F.split(_col(tok), ""), lambda c: c != F.lit(""))

    def to_id(c: Column) -> Column:
        cp = F.ascii(c)
        return F.when(cp >= SURROGATE_LO + SURROGATE_SHIFT, cp - SURROGATE_SHIFT).otherwise(cp)

    return F.transform(chars, to_id)


def encode_ids(text: Column | str, rules) -> Column:
    """``tokenize(text, rules)`` as ``array<int>``."""
    return token_string_ids(encode_token_string(text, rules))


def token_label(token_id: Column | str) -> Column:
    """Display label of a token id: the ASCII character below 128, else ``[id]``."""
    i = _col(token_id)
    return F.when(i < 128, F.char(i)).otherwise(F.concat(F.lit("["), i.cast("string"), F.lit("]")))
