"""Threshold-scaled document sketches for containment between unequal texts.

A sketch holds every distinct 5-word shingle hash below a fixed fraction
(``FRACTION``) of the hash space, and in any case the ``LEAST`` smallest ones,
with the bound below which it is complete.  Two sketches, of texts of any
sizes, are compared below the smaller of their bounds, where both are
complete; their union below it is the sketch of the merged document.  Only
DataFrame functions are used.

The next document (descending doc_id) is found without a global sort: ids are
cut into at most ``MAX_BUCKETS`` ranges of about as many rows each, whatever the
gaps between ids (rows of one id stay together), each range is ordered on its own, and
the last row of a range takes the first row of the next non-empty range from a
table with one row per range.

Defined cases: a null text counts as empty; words are runs without white
space, lower-cased; a text with fewer than five words has one shingle, an
empty one none; two empty sketches are alike (1), an empty and another are not
(0); rows with equal doc_id are ordered by text, descending, and a null doc_id
comes last; a single row is its own next document; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FRACTION = 1 / 8
LEAST = 64
SHINGLE = 5
MAX_BUCKETS = 65_536
ROWS_PER_BUCKET = 1000
_TOP = (1 << 63) - 1


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sketch ``out`` (struct of ``bound`` and ``hashes``) of a
    text column.  Each step is its own projection, so nothing is computed twice."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    h, n = F.col("__h"), F.size("__h")

    def shingle(x: Column, i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE)]), 1)

    many = F.transform(F.slice(h, F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(0))), shingle)
    one = F.when(n > 0, F.array(F.shiftrightunsigned(F.xxhash64(h), 1))).otherwise(F.array().cast("array<bigint>"))
    limit = F.lit(int(_TOP * FRACTION)).cast("bigint")
    s = F.col("__s")
    df = df.withColumn("__h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("__s", F.sort_array(F.array_distinct(F.when(n >= SHINGLE, many).otherwise(one))))
    bound = F.when(F.size(s) <= LEAST, F.lit(_TOP)).otherwise(F.greatest(limit, F.get(s, F.lit(LEAST - 1)) + 1))
    kept = F.filter(s, lambda x, i: (i < LEAST) | (x < limit))
    return df.withColumn(out, F.struct(bound.alias("bound"), kept.alias("hashes"))).drop("__h", "__s")


def as_text(sketch: str) -> Column:
    """A sketch as text: its bound, then its hashes, 16 hexadecimal digits each."""
    return F.concat_ws("", F.lpad(F.hex(F.col(f"{sketch}.bound")), 16, "0"), F.lit(":"),
                       F.array_join(F.transform(F.col(f"{sketch}.hashes"), lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def with_likeness(df: DataFrame, one: str, two: str, out: str) -> DataFrame:
    """``df`` with ``out``: the share of the smaller sketch that the other one
    contains, and ``out + '_jaccard'``: shared hashes over all hashes."""
    tau = F.least(F.col(f"{one}.bound"), F.col(f"{two}.bound"))
    df = df.withColumn("__t", tau)
    below = lambda c: F.filter(F.col(f"{c}.hashes"), lambda x: x < F.col("__t"))
    df = df.withColumn("__a", below(one)).withColumn("__b", below(two))
    df = df.withColumn("__i", F.size(F.array_intersect("__a", "__b")))
    a, b, i = F.size("__a"), F.size("__b"), F.col("__i")
    both_empty = (a == 0) & (b == 0)
    contained = F.when(both_empty, 1.0).when((a == 0) | (b == 0), 0.0).otherwise(i / F.least(a, b))
    jaccard = F.when(both_empty, 1.0).otherwise(i / (a + b - i))
    return df.withColumn(out, contained).withColumn(f"{out}_jaccard", jaccard).drop("__t", "__a", "__b", "__i")


def _borders(docs: DataFrame) -> list[int]:
    """Ascending ids that cut the rows into ranges of about ``ROWS_PER_BUCKET``
    rows: approximate quantiles, at most ``MAX_BUCKETS`` numbers."""
    n = docs.agg(F.count("doc_id")).first()[0]
    cells = max(1, min(MAX_BUCKETS, -(-n // ROWS_PER_BUCKET)))
    if cells == 1:
        return []
    return sorted(set(docs.agg(F.percentile_approx("doc_id", [k / cells for k in range(1, cells)],
                                                   max(10_000, 4 * cells))).first()[0]))


def _cell(borders: list[int]) -> Column:
    """Number of borders up to the id, -1 for a null id; looked up in two steps,
    a row of about ``sqrt`` of the borders each."""
    step = max(1, math.isqrt(len(borders)))
    rows = [borders[k:k + step] for k in range(0, len(borders), step)] or [[]]

    def up_to(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda b: b <= F.col("doc_id")))

    at = up_to(F.lit([r[0] for r in rows[1:]]).cast("array<bigint>"))
    own = up_to(F.element_at(F.lit(rows).cast("array<array<bigint>>"), at + 1))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at * step + own).cast("bigint")


def with_next(docs: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``docs`` (doc_id, text) with the columns that ``derive`` adds, and
    ``next_<column>`` of the next document by descending doc_id; after the last
    document comes the first."""
    docs = docs.withColumn("__cell", _cell(_borders(docs)))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()]
    w = Window.partitionBy("__cell").orderBy(*order)
    # at most MAX_BUCKETS + 1 rows of two numbers: a proven bound
    heads = docs.select("__cell", "doc_id").groupBy("__cell").agg(F.max("doc_id").alias("__head"))
    firsts = F.broadcast(heads.withColumnRenamed("__cell", "__hc"))
    head_rows = docs.join(firsts, (F.col("__cell") == F.col("__hc")) & F.col("doc_id").eqNullSafe(F.col("__head")))
    head_rows = derive(head_rows.select(*docs.columns)).groupBy("__cell").agg(F.max(F.struct("text", *[c for c in columns if c != "text"])).alias("__row"))
    around = Window.orderBy(F.col("__cell").desc())
    everyone = Window.partitionBy(F.lit(0))
    follow = heads.select("__cell", F.coalesce(F.lead("__cell").over(around), F.max("__cell").over(everyone)).alias("__to"))
    entry = follow.join(head_rows.withColumnRenamed("__cell", "__to"), "__to").select("__cell", "__row")
    full = derive(docs)
    led = full.withColumn("__led", F.lead(F.struct(*columns)).over(w))
    out = led.join(entry, "__cell", "left").withColumn("__next", F.coalesce(
        F.col("__led"), F.struct(*[F.col(f"__row.{c}").alias(c) for c in columns])))
    return out.select(*[c for c in full.columns if c != "__cell"], *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, sketch)`` of every row."""
    return with_sketch(_texts(docs), "text", "sketch")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The contract of op7: fingerprints of every text and of its edited text."""
    df = with_next(_texts(docs), ["text", "sketch"], lambda d: with_sketch(d, "text", "sketch"))
    df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    df = df.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - cut), F.left("next_text", cut)))
    df = with_sketch(df.drop("text", "next_text"), "edited", "edited_sketch")
    df = with_likeness(df, "sketch", "edited_sketch", "near_edited")
    df = with_likeness(df, "sketch", "next_sketch", "near_next")
    return df.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     as_text("sketch").alias("fingerprint"), as_text("edited_sketch").alias("edited_fingerprint"),
                     "near_edited", "near_next", "near_edited_jaccard", "near_next_jaccard")
