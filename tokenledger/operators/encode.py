"""Encode tables of text with trained rules; token summaries and aggregates.

The default path is a single narrow projection (no shuffle): bytes as a
token string, one ``replace`` per rule, ``char_length``.  Aggregates by a key
then shuffle only partial aggregates.

``tokens_by_key_dedup`` is the alternative for highly repetitive text and
long rule lists: rules never contain an ASCII whitespace byte, so text can
be cut at ASCII whitespace and each distinct segment encoded once.  Every
whitespace byte is one token.  It shuffles ``(key, segment)`` partial
counts instead of encoding every occurrence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.text import (ASCII_WHITESPACE_CODEPOINTS, ASCII_WS_PATTERN,
                                        byte_length, word_count)
from tokenledger.functions.tokens import (NESTED_REPLACE_LIMIT, encode_ids, token_count, token_string_ids,
                                          encode_token_string, validate_rules)
from tokenledger.operators.queue_encode import encode_counts_queued, encode_ids_queued, encoded_queued


def encode_counts(df: DataFrame, rules, text: str = "text",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Per row: ``(*keep, n_bytes, tokens, tokens_per_byte)``; long rule lists
    by a priority queue (``operators.queue_encode``)."""
    if len(rules) > NESTED_REPLACE_LIMIT:
        return encode_counts_queued(df, rules, text, keep)
    return (df.select(*keep, byte_length(text).alias("n_bytes"),
                      token_count(text, rules).alias("tokens"))
            .withColumn("tokens_per_byte", F.try_divide(F.col("tokens").cast("double"),
                                                        F.col("n_bytes").cast("double"))))


def encode_with_ids(df: DataFrame, rules, text: str = "text",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Per row: ``(*keep, ids array<int>, tokens)`` from one encode pass."""
    if len(rules) > NESTED_REPLACE_LIMIT:
        return encode_ids_queued(df, rules, text, keep)
    enc = df.select(*keep, encode_token_string(text, rules).alias("_tok"))
    return enc.select(*keep, token_string_ids("_tok").alias("ids"),
                      F.char_length("_tok").alias("tokens"))


def tokens_by_key(df: DataFrame, rules, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Token totals and densities per key (tokens per byte, char and word)."""
    sizes = {"b": byte_length(text), "c": F.char_length(text), "w": word_count(text)}
    if len(rules) > NESTED_REPLACE_LIMIT:
        per = encoded_queued(df, rules, text, keys, sizes).withColumn("t", F.char_length("_tok"))
    else:
        per = df.select(*keys, *[c.alias(n) for n, c in sizes.items()], token_count(text, rules).alias("t"))
    agg = per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("b").alias("bytes"), F.sum("c").alias("chars"),
        F.sum("w").alias("words"), F.sum("t").alias("tokens"))
    return _densities(agg)


def tokens_by_key_many(df: DataFrame, tokenizers: dict, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Token totals of several rule lists per key, in one pass over the texts:
    ``(*keys, bytes, tokens_<name>..., per_byte_<name>...)``."""
    per = df.select(*keys, byte_length(text).alias("b"),
                    *[token_count(text, rules).alias(f"t_{n}") for n, rules in tokenizers.items()])
    agg = per.groupBy(*keys).agg(F.sum("b").alias("bytes"),
                                 *[F.sum(f"t_{n}").alias(f"tokens_{n}") for n in tokenizers])
    return agg.select("*", *[F.try_divide(F.col(f"tokens_{n}").cast("double"), F.col("bytes").cast("double"))
                             .alias(f"per_byte_{n}") for n in tokenizers])


def _densities(agg: DataFrame) -> DataFrame:
    t = F.col("tokens").cast("double")
    return (agg.withColumn("tokens_per_byte", F.try_divide(t, F.col("bytes").cast("double")))
            .withColumn("tokens_per_char", F.try_divide(t, F.col("chars").cast("double")))
            .withColumn("tokens_per_word", F.try_divide(t, F.col("words").cast("double"))))


def rules_touch_ascii_whitespace(rules) -> bool:
    """True if any rule's pair contains an ASCII whitespace byte (then no dedup)."""
    ws = set(ASCII_WHITESPACE_CODEPOINTS)
    return any(left in ws or right in ws for left, right, _ in validate_rules(rules))


def tokens_by_key_dedup(df: DataFrame, rules, keys: Sequence[str],
                        text: str = "text") -> DataFrame:
    """Same result as ``tokens_by_key``, encoding each distinct segment once."""
    if rules_touch_ascii_whitespace(rules):
        return tokens_by_key(df, rules, keys, text)
    per_doc = df.select(*keys, byte_length(text).alias("b"), F.char_length(text).alias("c"),
                        word_count(text).alias("w"),
                        (byte_length(text) - byte_length(F.regexp_replace(text, ASCII_WS_PATTERN, "")))
                        .alias("ws"),
                        F.split(text, ASCII_WS_PATTERN, -1).alias("segs"))
    doc_agg = per_doc.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("b").alias("bytes"), F.sum("c").alias("chars"),
        F.sum("w").alias("words"), F.sum("ws").alias("ws_tokens"))
    segs = (per_doc.select(*keys, F.explode("segs").alias("seg")).where(F.col("seg") != "")
            .groupBy(*keys, "seg").agg(F.count(F.lit(1)).alias("occ")))
    if len(rules) > NESTED_REPLACE_LIMIT:
        counted = encoded_queued(segs, rules, "seg", [*keys, "occ"]).select(*keys, (F.col("occ") * F.char_length("_tok")).alias("t"))
    else:
        counted = segs.select(*keys, (F.col("occ") * token_count("seg", rules)).alias("t"))
    seg_tokens = counted.groupBy(*keys).agg(F.sum("t").alias("seg_tokens"))
    out = (doc_agg.join(seg_tokens, list(keys), "left")
           .select(*keys, "docs", "bytes", "chars", "words",
                   (F.col("ws_tokens") + F.coalesce(F.col("seg_tokens"), F.lit(0))).alias("tokens")))
    return _densities(out)


__all__ = ["encode_counts", "encode_with_ids", "tokens_by_key", "tokens_by_key_dedup",
           "rules_touch_ascii_whitespace", "encode_ids"]
