"""Encoding with any number of rules: rank-ordered merging by a priority queue.

A chain of ``replace`` runs every rule over every text, which is right for tens
of rules and hopeless for the thousands of a real tokenizer.  Here the work of a
text follows its own merges: its tokens are linked to their neighbours, a queue
holds the places where some rule applies, by (rank, place), and each merge adds
at most the two pairs that it creates.

The result is that of the chain, in which a rule passes over the text once, in
rank order: a pair created at rank r waits for the first rule of that pair
*after* r (a pair may have several), and equal ranks go from left to right.

Tokens that no rule knows (white space in trained rules, bolt-on ids) end every
run, so a text is cut at them and each distinct run is merged once; runs met
before are remembered, up to a number of runs and of tokens per worker.  Texts go to Python in
Arrow batches as token strings and come back as such: a narrow pass, also on a
stream.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenledger.functions.text import byte_length, utf8_byte_string
from tokenledger.functions.tokens import id_to_char, token_string_ids, validate_rules
from tokenledger.session import bounded_workers

#: Distinct runs that a worker remembers (memory only), their length in tokens,
#: and the tokens of all of them: a text without spaces is one long run.
REMEMBERED = 200_000
REMEMBERED_RUN = 64
REMEMBERED_TOKENS = 3_000_000

#: Bytes of text that become Python strings at a time.
SLICE_BYTES = 256 << 10


def slices(batch: pa.RecordBatch, at: int, most: int = SLICE_BYTES):
    """The batch cut into runs of rows with about ``most`` bytes in column ``at``."""
    a, n = 0, batch.num_rows
    if not n:
        yield batch
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


class MergeQueue:
    """The rules as a table of pairs; token strings in, token strings out."""

    def __init__(self, rules):
        triples = validate_rules(rules)
        self.ranks: dict[str, list[int]] = {}
        self.pairs = [id_to_char(left) + id_to_char(right) for left, right, _ in triples]
        self.merged = [id_to_char(new) for _, _, new in triples]
        for rank, pair in enumerate(self.pairs):
            self.ranks.setdefault(pair, []).append(rank)
        known = sorted(set("".join(self.pairs)))
        self._run = re.compile("[" + "".join(re.escape(c) for c in known) + "]{2,}") if known else None
        self._done: dict[str, str] = {}
        self._held = 0  # tokens of the remembered runs
        self.merges = 0  # merges made so far

    def __call__(self, tokens: str) -> str:
        """``tokens`` after all rules."""
        if self._run is None:
            return tokens
        if len(self._done) > REMEMBERED or self._held > REMEMBERED_TOKENS:
            self._done.clear()
            self._held = 0
        return self._run.sub(self._replace, tokens)

    def _replace(self, match: re.Match) -> str:
        run = match[0]
        if len(run) > REMEMBERED_RUN:
            return self.merge_run(run)
        out = self._done.get(run)
        if out is None:
            out = self._done[run] = self.merge_run(run)
            self._held += len(run)
        return out

    def merge_run(self, run: str) -> str:
        token = list(run)
        n = len(token)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(self.ranks[p][0], i) for i, p in enumerate(map("".join, zip(run, run[1:]))) if p in self.ranks]
        heapq.heapify(queue)

        def wait(i: int, j: int, rank: int) -> None:
            later = self.ranks.get(token[i] + token[j])
            if later and later[-1] > rank:
                heapq.heappush(queue, (later[bisect_right(later, rank)], i))

        while queue:
            rank, i = heapq.heappop(queue)
            j = right[i]
            if j >= n or token[i] + token[j] != self.pairs[rank]:
                continue  # one of the two went into another merge; "" marks a token that is gone
            token[i], token[j] = self.merged[rank], ""
            right[i] = k = right[j]
            self.merges += 1
            if k < n:
                left[k] = i
                wait(i, k, rank)
            if left[i] >= 0:
                wait(left[i], i, rank)
        return "".join(token)


def with_rules(df: DataFrame, rules, column: str) -> DataFrame:
    """``df`` with the token strings of ``column`` after all rules, null where
    null; every other column is kept as it is."""
    shared = list(validate_rules(rules))
    bounded_workers(df.sparkSession)
    names = df.columns
    at = names.index(column)
    schema = T.StructType([T.StructField(f.name, T.StringType() if i == at else f.dataType, True, f.metadata)
                           for i, f in enumerate(df.schema.fields)])

    def run(batches):
        queue = MergeQueue(shared)
        for b in (part for whole in batches for part in slices(whole, at)):
            done = pa.array([None if s is None else queue(s) for s in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([done if i == at else b.column(i) for i in range(b.num_columns)], names=names)

    return df.mapInArrow(run, schema)


def encode_counts_queued(df: DataFrame, rules, text: str = "text", keep=()) -> DataFrame:
    """``(*keep, n_bytes, tokens, tokens_per_byte)`` as ``encode.encode_counts``."""
    enc = encoded_queued(df, rules, text, keep, {"n_bytes": byte_length(text)})
    return enc.select(*keep, "n_bytes", F.char_length("_tok").alias("tokens")).withColumn(
        "tokens_per_byte", F.try_divide(F.col("tokens").cast("double"), F.col("n_bytes").cast("double")))


def encode_ids_queued(df: DataFrame, rules, text: str = "text", keep=()) -> DataFrame:
    """``(*keep, ids, tokens)`` as ``encode.encode_with_ids``."""
    return encoded_queued(df, rules, text, keep).select(
        *keep, token_string_ids("_tok").alias("ids"), F.char_length("_tok").alias("tokens"))


def encoded_queued(df: DataFrame, rules, text: str = "text", keep=(), extra: dict[str, Column] | None = None) -> DataFrame:
    """``(*keep, *extra, _tok)``: the final token string of each text."""
    cols = [c.alias(n) for n, c in (extra or {}).items()]
    return with_rules(df.select(*keep, *cols, utf8_byte_string(text).alias("_tok")), rules, "_tok")
