"""Site-relative line frequency: drop boilerplate lines of a host.

For each host the pages that contain a line are divided by all pages of the
host; lines above ``ratio`` go.  Only DataFrame functions are used.  Lines
are counted under a 96-bit hash with partial aggregation, so a host with a
third of all pages shuffles one row per distinct line and task; host totals
meet the counts under a salt, and the surviving lines become one small array
per host (at most ``lines per page / ratio`` entries), written once so that
its true size decides between broadcast and a salted join.

Defined cases: lines end at ``\\n`` and compare without outer blanks and
tabs; blank lines are never counted or dropped; a line that repeats within a
page counts once; a null text stays null; a page without host is left as it
is; hosts under ``min_pages`` pages and lines on fewer than ``min_hits``
pages are left as they are; repeated rows count as pages; other columns,
whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import free_names, written

#: Of a host's pages; a line on more of them goes.
RATIO = 0.015
MIN_PAGES = 10
MIN_HITS = 3
_SALT = 16


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\r"))


def _key(c: Column) -> Column:
    """96 bits of a trimmed line, as text."""
    return F.concat(F.hex(F.xxhash64(c)), F.hex(F.hash(c)))


def line_frequencies(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``(host, key, n)``: pages of the host that contain the line."""
    lines = F.array_distinct(F.transform(F.split(F.col(text), "\n"), _trim))
    return (docs.where(F.col(host).isNotNull() & F.col(text).isNotNull())
            .select(F.col(host).cast("string").alias("host"), F.explode(lines).alias("line"))
            .where(F.col("line") != "")
            .groupBy("host", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))
            .agg(F.count("*").alias("n")))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES, min_hits: int = MIN_HITS) -> DataFrame:
    """``(host, lines)``: the keys of each host's boilerplate lines."""
    freq = line_frequencies(docs, host, text).where(F.col("n") >= min_hits).withColumn(
        "salt", F.pmod("h1", F.lit(_SALT)))
    pages = (docs.where(F.col(host).isNotNull()).groupBy(F.col(host).cast("string").alias("host"))
             .agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SALT - 1).cast("bigint")))))
    return (freq.join(pages, ["host", "salt"]).where(F.col("n") > F.lit(float(ratio)) * F.col("pages"))
            .groupBy("host").agg(F.collect_set(F.concat(F.hex("h1"), F.hex("h2"))).alias("lines")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, min_hits: int = MIN_HITS) -> DataFrame:
    """``docs`` with ``text`` cleaned and two more columns, ``__lines`` (its
    lines before) and ``__dropped`` (lines removed), which replace input columns
    of these names."""
    site, found, salt, other, every, kept = free_names(docs, "__host", "__found", "__salt", "__other", "__all", "__kept")
    table = written(boilerplate(docs, host, text, ratio, min_pages, min_hits), "lines")
    table = table.select(F.col("host").alias(site), F.col("lines").alias(found),
                         F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1))).alias(other))
    spread = docs.withColumn(salt, F.pmod(F.hash(text), F.lit(_SALT)))
    joined = spread.join(table, (F.col(host).cast("string") == F.col(site)) & (F.col(salt) == F.col(other)), "left")
    # the page's keys meet the host's in one hash lookup; only its own hits are searched per line
    hits = F.array_intersect(F.transform(every, lambda x: _key(_trim(x))), found)
    out = joined.withColumn(every, F.split(F.col(text), "\n")).withColumn(found, hits)
    keep = F.when(F.coalesce(F.size(found), F.lit(0)) <= 0, F.col(every)).otherwise(
        F.filter(every, lambda x: ~F.array_contains(F.col(found), _key(_trim(x)))))
    out = out.withColumn(kept, keep)
    rest = [F.col(c) for c in docs.columns if c not in (text, "__lines", "__dropped")]
    return out.select(*rest, F.array_join(kept, "\n").alias(text),
                      F.coalesce(F.size(every), F.lit(0)).cast("bigint").alias("__lines"),
                      F.coalesce(F.size(every) - F.size(kept), F.lit(0)).cast("bigint").alias("__dropped"))
