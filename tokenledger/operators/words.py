"""Corpus -> words -> distinct-word table (the training working set).

A corpus is any DataFrame with a text column, an integer ``weight`` (how
many times the text is repeated in the mix) and ordering columns that give
its corpus order (e.g. ``source_ord, doc_ord``).  Repetition is never
materialised: weights multiply counts and leave first-seen order unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.functions.text import utf8_byte_string, words


def pretokenize(corpus: DataFrame, text: str = "text",
                keep: Sequence[str] = ()) -> DataFrame:
    """One row per whitespace word: ``(*keep, pos, word)``; ``pos`` counts words."""
    return corpus.select(*keep, F.posexplode(words(text)).alias("pos", "word"))


# First occurrences (order columns, word position) travel through the corpus
# aggregation as one packed number, so ``min`` stays a hash aggregate -- ``min``
# over a struct would sort every exploded word of the corpus.  A column's
# value is stored relative to its observed minimum, null as 0 (nulls come
# first), so any bigint works as an ordinal.  The key is a bigint when the
# observed ranges leave room for the 31 bits of a position, a decimal(38,0)
# when their digits do, and the plain struct otherwise.
_KEY = "decimal(38,0)"
_POS_BITS = 31
_POS_DIGITS = 10


def _dec(v: int) -> Column:
    return F.lit(str(v)).cast(_KEY)


@dataclass(frozen=True)
class _Field:
    name: str
    type: str
    low: int
    span: int  # codes 0..span

    @property
    def bits(self) -> int:
        return max(1, self.span.bit_length())

    @property
    def digits(self) -> int:
        # one digit of headroom keeps decimal quotients away from rounding
        return len(str(self.span)) + 1

    def code(self, c: Column, kind: str) -> Column:
        low = F.lit(self.low).cast("bigint") if kind == "bigint" else _dec(self.low)
        one = F.lit(1).cast("bigint") if kind == "bigint" else _dec(1)
        return F.coalesce(c.cast(kind) - low + one, F.lit(0).cast(kind))

    def decode(self, code: Column, kind: str) -> Column:
        low = F.lit(self.low).cast("bigint") if kind == "bigint" else _dec(self.low)
        one = F.lit(1).cast("bigint") if kind == "bigint" else _dec(1)
        return F.when(code > 0, (code - one + low).cast(self.type))


def _observed(df: DataFrame, columns: dict[str, Column]) -> list[_Field]:
    """Ranges of integer columns from one small job that reads only them."""
    aggs = [f(c).alias(f"{k}{i}") for i, c in enumerate(columns.values()) for k, f in (("lo", F.min), ("hi", F.max))]
    st = df.agg(*aggs).first()
    types = dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes)
    out = []
    for i, n in enumerate(columns):
        lo, hi = st[f"lo{i}"], st[f"hi{i}"]
        lo, hi = (0, -1) if lo is None else (int(lo), int(hi))
        out.append(_Field(n, types[n], lo, hi - lo + 1))
    return out


def word_freq(corpus: DataFrame, order: Sequence[str], text: str = "text",
              weight: str | None = "weight", by: Sequence[str] = ()) -> DataFrame:
    """Distinct words with weighted frequency and first occurrence.

    Returns ``(word, freq bigint, first struct<*order, pos>)``.  The
    aggregation is partial (map-side) then final, so a hot word costs one
    row per partition in the shuffle.  The order columns are any integers,
    also negative or null (nulls come first).  ``by`` names columns that keep
    words apart; they come before ``word``.
    """
    group = [*by, "word"]
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    exploded = corpus.select(*dict.fromkeys([*by, *order]), w.alias("_w"), F.posexplode(words(text)).alias("pos", "word"))
    fields = _observed(corpus, {n: F.col(n) for n in order})
    pos = F.col("pos")
    if sum(f.bits for f in fields) + _POS_BITS <= 63:
        key = F.lit(0).cast("bigint")
        for f in fields:
            key = F.shiftleft(key, f.bits) + f.code(F.col(f.name), "bigint")
        key = F.shiftleft(key, _POS_BITS) + pos.cast("bigint")
        agg = exploded.groupBy(*group).agg(F.sum("_w").alias("freq"), F.min(key).alias("_k"))
        rest, parts = F.shiftright("_k", _POS_BITS), []
        for f in reversed(fields):
            parts.append(f.decode(rest.bitwiseAND(F.lit((1 << f.bits) - 1)), "bigint").alias(f.name))
            rest = F.shiftright(rest, f.bits)
        at = F.col("_k").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).cast("int")
        return agg.select(*group, "freq", F.struct(*reversed(parts), at.alias("pos")).alias("first"))
    if sum(f.digits for f in fields) + _POS_DIGITS <= 38:
        key = _dec(0)
        for f in fields:
            key = (key * _dec(10 ** f.digits)).cast(_KEY) + f.code(F.col(f.name), _KEY)
        key = ((key * _dec(10 ** _POS_DIGITS)).cast(_KEY) + pos.cast(_KEY)).cast(_KEY)
        agg = exploded.groupBy(*group).agg(F.sum("_w").alias("freq"), F.min(key).alias("_k"))

        def cut(k: Column, digits: int) -> tuple[Column, Column]:
            low = (k % _dec(10 ** digits)).cast(_KEY)
            return ((k - low).cast(_KEY) / _dec(10 ** digits)).cast(_KEY), low

        rest, at = cut(F.col("_k"), _POS_DIGITS)
        parts = []
        for f in reversed(fields):
            rest, code = cut(rest, f.digits)
            parts.append(f.decode(code, _KEY).alias(f.name))
        return agg.select(*group, "freq", F.struct(*reversed(parts), at.cast("int").alias("pos")).alias("first"))
    return (exploded.groupBy(*group)
            .agg(F.sum("_w").alias("freq"), F.min(F.struct(*order, "pos")).alias("first")))


def word_table(corpus: DataFrame, order: Sequence[str], text: str = "text",
               weight: str | None = "weight") -> DataFrame:
    """Distinct words as initial token strings: ``(word, tok, freq, first)``."""
    wf = word_freq(corpus, order, text, weight)
    return wf.select("word", utf8_byte_string("word").alias("tok"), "freq", "first")


def word_tables(corpus: DataFrame, mixes: dict[str, Sequence[tuple[str, int]]]) -> dict[str, DataFrame]:
    """The word table of several mixes ``[(source, weight), ...]`` from one pass
    over a corpus ``(source, doc_ord, text)``: its words are counted by source
    and written once, a mix then weights and joins the counts of its sources."""
    from tokenledger.session import materialize

    counted, _ = materialize(word_freq(corpus, ["doc_ord"], weight=None, by=["source"]), "source-words")
    out = {}
    for name, mix in mixes.items():
        pick = lambda values: F.element_at(F.create_map(*[F.lit(x) for v in values for x in v]), F.col("source"))
        rows = counted.where(F.col("source").isin([s for s, _ in mix])).select(
            "word", (F.col("freq") * pick(mix).cast("bigint")).alias("freq"),
            F.struct(pick([(s, i) for i, (s, _) in enumerate(mix)]).cast("int").alias("source_ord"),
                     F.col("first.doc_ord").alias("doc_ord"), F.col("first.pos").alias("pos")).alias("first"))
        out[name] = rows.groupBy("word").agg(F.sum("freq").alias("freq"), F.min("first").alias("first")).select(
            "word", utf8_byte_string("word").alias("tok"), "freq", "first")
    return out


def rank_words(table: DataFrame, first: str = "first") -> tuple[DataFrame, int, list[str]]:
    """Dense, order-preserving rank of each distinct word by first occurrence.

    A distributed sort (range partitioning) tags rows with
    ``monotonically_increasing_id`` (partition index in the high bits), the
    tagged table is written once, and per-partition counts turn the tags into
    consecutive ranks -- no single-task window over the words.  Returns
    ``(table + wrank bigint, max_len, scratch paths)``; ``max_len`` is the
    longest token string, which bounds the position bits of pair keys.
    """
    from tokenledger.session import materialize

    s, path = materialize(table.orderBy(first).withColumn("_mid", F.monotonically_increasing_id()),
                          "sorted-words")
    low = (1 << 33) - 1
    # One row per sorted partition: tiny, so the running sum is cheap.
    stats = (s.groupBy(F.shiftright("_mid", 33).alias("_p"))
             .agg(F.count(F.lit(1)).alias("_cnt"), F.max(F.char_length("tok")).alias("_len"))
             .select("_p", "_len",
                     (F.sum("_cnt").over(Window.orderBy("_p")) - F.col("_cnt")).alias("_off"))
             .collect())
    max_len = max((r["_len"] or 0 for r in stats), default=0)
    offsets = s.sparkSession.createDataFrame([(r["_p"], r["_off"]) for r in stats],
                                             "_p bigint, _off bigint")
    ranked = (s.join(F.broadcast(offsets), F.shiftright(s["_mid"], 33) == F.col("_p"))
              .withColumn("wrank", F.col("_off") + F.col("_mid").bitwiseAND(F.lit(low)))
              .drop("_mid", "_p", "_off"))
    return ranked, int(max_len), [path]


@dataclass
class WordKeys:
    """A written word table with an order-preserving key per word.

    ``frame`` has ``wkey`` (bigint) when ``shift`` is set: the number of low
    bits that a position inside the token string takes next to it.  Without
    ``shift`` nothing fits a bigint and ``first`` itself is the key.
    """

    frame: DataFrame
    shift: int | None
    max_len: int
    n_words: int
    paths: list[str]
    fields: list[_Field] | None  # packed fields, or None for ranks

    def firsts(self, pairs: DataFrame) -> DataFrame:
        """``pairs(..., first)`` with ``first`` as ``struct<*fields, i>``."""
        if self.shift is None:
            return pairs
        low = F.col("first").bitwiseAND(F.lit((1 << self.shift) - 1)).cast("int").alias("i")
        rest, cols = F.shiftright("first", self.shift), [c for c in pairs.columns if c != "first"]
        if self.fields is None:
            words_first = self.frame.select(F.col("wkey").alias("_wkey"), F.col("first").alias("_first"))
            names = self.frame.schema["first"].dataType.fieldNames()
            return pairs.join(words_first, rest == F.col("_wkey")).select(
                *cols, F.struct(*[F.col(f"_first.{n}").alias(n) for n in names], low).alias("first"))
        parts = []
        for f in reversed(self.fields):
            parts.append(f.decode(rest.bitwiseAND(F.lit((1 << f.bits) - 1)), "bigint").alias(f.name))
            rest = F.shiftright(rest, f.bits)
        return pairs.select(*cols, F.struct(*reversed(parts), low).alias("first"))


def first_key(table: DataFrame, first: str = "first", write: bool = True) -> WordKeys:
    """An order-preserving ``bigint`` key for each word's first occurrence.

    The word table is written once (it is the expensive input of training;
    ``write=False`` says it already is).  If the observed ranges of the
    first-occurrence fields fit next to the position bits, the key is the
    packed fields; else a distributed dense rank (``rank_words``); else, for a
    word too long for either, the struct stays the key.
    """
    from tokenledger.session import materialize

    paths = []
    if write:
        table, path = materialize(table, "word-table")
        paths.append(path)
    names = table.schema[first].dataType.fieldNames()
    st = table.agg(F.max(F.char_length("tok")).alias("len"), F.count(F.lit(1)).alias("n")).first()
    max_len, n_words = int(st["len"] or 0), int(st["n"])
    shift = max(1, max_len.bit_length())
    fields = _observed(table, {n: F.col(f"{first}.{n}") for n in names})
    if sum(f.bits for f in fields) + shift <= 62:
        key = F.lit(0).cast("bigint")
        for f in fields:
            key = F.shiftleft(key, f.bits) + f.code(F.col(f"{first}.{f.name}"), "bigint")
        return WordKeys(table.withColumn("wkey", key), shift, max_len, n_words, paths, fields)
    if n_words.bit_length() + shift <= 62:
        ranked, _, more = rank_words(table, first)
        return WordKeys(ranked.withColumnRenamed("wrank", "wkey"), shift, max_len, n_words, paths + more, None)
    return WordKeys(table, None, max_len, n_words, paths, None)
