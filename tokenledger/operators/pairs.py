"""Adjacent-pair counting over token strings (overlaps counted)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenledger.functions.tokens import SURROGATE_LO, SURROGATE_SHIFT


# Words up to this many tokens take the generator path (``explode`` of
# positions plus ``substring`` in a codegen'd projection, about twice as fast);
# ``substring`` walks from the start, so longer words use the linear split.
SHORT_WORD = 256


def _pairs_of(tok: Column) -> Column:
    """``[t0t1, t1t2, ...]`` for a token string of length >= 2 (linear time)."""
    chars = F.split(tok, "")
    n = F.size(chars) - 1
    return F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda a, b: F.concat(a, b))


def explode_pairs(words: DataFrame, tok: str, carry: dict[str, Column],
                  max_len: int | None = None, route_len: str | None = None) -> DataFrame:
    """``(*carry, _i, pair)`` for every adjacent pair; ``_i`` is 0-based.

    ``max_len``, when known, bounds the token-string length; if no word is
    long, the linear branch (and its second scan) is left out.
    ``route_len`` names a stored upper bound of each row's length (its length
    before the latest merges): routing on it keeps the filter from being
    pushed below a projection that computes ``tok``, so a ``replace`` chain
    feeding ``tok`` runs once per row.
    """
    n = F.char_length("_t")
    cols = [c.alias(k) for k, c in carry.items()]
    names = list(carry)
    route = F.col(route_len) if route_len else F.char_length(tok)
    short = (words.where(route <= SHORT_WORD)
             .select(*cols, F.col(tok).alias("_t"))
             .select(*names, "_t", F.explode(F.when(n >= 2, F.sequence(F.lit(0), n - 2))).alias("_i"))
             .select(*names, "_i", F.substring(F.col("_t"), F.col("_i") + 1, 2).alias("pair")))
    if max_len is not None and max_len <= SHORT_WORD:
        return short
    long_ = (words.where(route > SHORT_WORD)
             .select(*cols, F.col(tok).alias("_t"))
             .where(n >= 2)
             .select(*names, F.posexplode(_pairs_of(F.col("_t"))).alias("_i", "pair")))
    return short.unionByName(long_)


def pair_counts(words: DataFrame, tok: str = "tok", freq: str = "freq",
                first: str | None = "first", shift: int | None = None,
                max_len: int | None = None, route_len: str | None = None) -> DataFrame:
    """Count every adjacent pair, weighted by ``freq``.

    Returns ``(pair string, n bigint[, first])`` where ``pair`` is the
    two-character token string and ``first`` is the first occurrence in
    corpus order: the word's first occurrence extended by the pair's position
    in the current token string.  Pairs never cross words.

    ``first`` may be a struct (kept as a struct) or, with ``shift``, a dense
    bigint word rank; the key is then ``rank << shift | position``, which
    keeps the aggregation on the fast fixed-width hash path.
    """
    if first is not None and shift is not None:
        ex = explode_pairs(words, tok, {"_f": F.col(freq), "_o": F.col(first)}, max_len,
                           route_len)
        key = F.shiftleft(F.col("_o"), shift) + F.col("_i")
        return ex.groupBy("pair").agg(F.sum("_f").alias("n"), F.min(key).alias("first"))
    if first is not None:
        # A struct minimum plans as a sort-based aggregate; it is the way out
        # when no bigint key fits (see ``operators.words.first_key``).
        fields = words.schema[first].dataType.fieldNames()
        ex = explode_pairs(words, tok, {"_f": F.col(freq), "_o": F.col(first)}, max_len, route_len)
        key = F.struct(*[F.col(f"_o.{f}").alias(f) for f in fields], F.col("_i").alias("i"))
        return ex.groupBy("pair").agg(F.sum("_f").alias("n"), F.min(key).alias("first"))
    ex = explode_pairs(words, tok, {"_f": F.col(freq)}, max_len, route_len)
    return ex.groupBy("pair").agg(F.sum("_f").alias("n"))


def pair_ids(pair: Column | str) -> tuple[Column, Column]:
    """(left id, right id) of a two-character pair string."""
    p = F.col(pair) if isinstance(pair, str) else pair

    def cid(c: Column) -> Column:
        cp = F.ascii(c)
        return F.when(cp >= SURROGATE_LO + SURROGATE_SHIFT, cp - SURROGATE_SHIFT).otherwise(cp)

    return cid(F.substring(p, 1, 1)), cid(F.substring(p, 2, 1))


def counted_pairs(keys, tok: str = "tok") -> DataFrame:
    """``pair_counts`` over a written word table (``WordKeys``), with the first
    occurrence as ``struct<*fields, i>``: one word aggregation in all, and a
    hash aggregate by pair."""
    col = "first" if keys.shift is None else "wkey"
    counts = pair_counts(keys.frame, tok, first=col, shift=keys.shift, max_len=keys.max_len)
    return keys.firsts(counts)


def ranked_pairs(counts: DataFrame) -> DataFrame:
    """Order pairs as the trainer picks them: count desc, first occurrence asc."""
    return counts.orderBy(F.desc("n"), F.asc("first"))


def top_pairs(counts: DataFrame, k: int, min_count: int = 2) -> DataFrame:
    """The ``k`` best pairs with count >= ``min_count`` (TakeOrderedAndProject)."""
    return ranked_pairs(counts.where(F.col("n") >= min_count)).limit(k)
