"""Stored segment counts: a new batch of documents encodes only unseen segments.

White space cuts a text into segments that are encoded independently
(``operators.encode``).  A store keeps ``segment -> tokens`` of one rule list as
a Parquet table bucketed and sorted by the segment, at a shared path.  A batch is
reduced to its distinct segments; those without a stored count (anti join) are
encoded and appended, and totals come from a join with the store.  Both joins
read the store bucket by bucket: only the batch's distinct segments move, to the
store's buckets, and the stored side has no exchange, however large it grows.

A rule list has a folder of its own (named by a digest of its rules), so counts
of different tokenizers never mix.  An append that was cut off and repeated can
leave a segment twice, with the same count; readers take one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.functions.text import ASCII_WS_PATTERN, byte_length, word_count
from tokenledger.functions.tokens import validate_rules
from tokenledger.operators.encode import _densities, rules_touch_ascii_whitespace
from tokenledger.operators.queue_encode import encoded_queued
from tokenledger.session import drop_scratch, materialize

#: Buckets of a store; the batch's segments are dealt to as many tasks.
BUCKETS = 64


class SegmentStore:
    """The stored counts of one rule list under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, rules, buckets: int = BUCKETS):
        if rules_touch_ascii_whitespace(rules):
            raise ValueError("rules that touch ASCII white space cannot be counted by segment")
        self.spark, self.rules = spark, list(rules)
        digest = hashlib.sha256(repr((validate_rules(rules), buckets)).encode()).hexdigest()[:16]
        where = f"{path.rstrip('/')}/segments-{digest}"
        self.table = f"tokenledger_segments_{hashlib.sha256(where.encode()).hexdigest()[:16]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (seg STRING, tokens BIGINT) USING parquet "
                  f"CLUSTERED BY (seg) SORTED BY (seg) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
        self.buckets = int(buckets)

    def counts(self) -> DataFrame:
        """``(seg, tokens)``, one row per segment, in the store's buckets."""
        return self.spark.table(self.table).groupBy("seg").agg(F.max("tokens").alias("tokens"))

    def unseen(self, segments: DataFrame) -> DataFrame:
        """The rows of ``segments(seg, ...)`` without a stored count."""
        return segments.join(self.spark.table(self.table).hint("merge"), "seg", "left_anti")

    def add(self, segments: DataFrame) -> int:
        """Encode and store the unseen of distinct ``segments(seg)``; how many."""
        fresh = encoded_queued(self.unseen(segments.select("seg")), self.rules, "seg", ["seg"]).select(
            "seg", F.char_length("_tok").cast("bigint").alias("tokens"))
        written, path = materialize(fresh, "fresh-segments")
        n = written.count()
        if n:
            # one file per bucket: the rows arrive dealt by the bucket function
            written.repartition(self.buckets, "seg").write.format("parquet").bucketBy(self.buckets, "seg").sortBy("seg").mode(
                "append").saveAsTable(self.table, path=self._location())
            self.spark.catalog.refreshTable(self.table)
        drop_scratch(self.spark, path)
        return n

    def _location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.table}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def tokens_by_key(self, df: DataFrame, keys: Sequence[str], text: str = "text") -> tuple[DataFrame, int]:
        """Totals and densities as ``encode.tokens_by_key``, and the number of
        segments that had to be encoded."""
        per = df.select(*keys, byte_length(text).alias("b"), F.char_length(text).alias("c"), word_count(text).alias("w"),
                        (byte_length(text) - byte_length(F.regexp_replace(text, ASCII_WS_PATTERN, ""))).alias("s"), text)
        totals = per.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("docs"), F.sum("b").alias("bytes"), F.sum("c").alias("chars"), F.sum("w").alias("words"),
            F.sum("s").alias("_spaces"))
        segs, _ = materialize(df.select(*keys, F.explode(F.split(text, ASCII_WS_PATTERN, -1)).alias("seg")).where("seg <> ''")
                              .groupBy(*keys, "seg").agg(F.count(F.lit(1)).alias("occ")), "segments")
        added = self.add(segs.select("seg").distinct())
        counted = segs.join(self.counts().hint("merge"), "seg").groupBy(*keys).agg(F.sum(F.col("occ") * F.col("tokens")).alias("_t"))
        same = [totals[k].eqNullSafe(counted[k]) for k in keys]
        out = totals.join(counted, same, "left").select(
            *[totals[k] for k in keys], "docs", "bytes", "chars", "words",
            (F.col("_spaces") + F.coalesce(F.col("_t"), F.lit(0))).alias("tokens"))
        return _densities(out), added
