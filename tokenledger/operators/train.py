"""Byte-level BPE training as an iterative Spark job.

Each step counts adjacent pairs over the cached distinct-word table (one
partial + final aggregation, shuffle keyed by pair), and only the few best
pairs reach the driver.  The merge itself is a ``replace`` projection on the
word table, so the working set never leaves the executors.

Exact batching
--------------
One merge per job is slow when job overhead dominates.  From the ranked
list (count desc, first occurrence asc) we take several merges per job when
one-by-one training would provably pick exactly those, in that order (see
``select_batch`` for the argument).

Fragments
---------
A pair that occurs less often than the last rule to be learned is never merged,
and neither is any pair that a merge makes out of it (it occurs no more often).
So after one count of all words they are cut between the tokens of every pair
below a floor, and the steps work on the distinct fragments with their summed
frequencies (``cut_words``).  Every pair at or above the floor keeps its exact
count and first occurrence; when no pair reaches the floor any more, the words
are counted and cut again with a lower one.

Fault tolerance: the working set is cached between steps and reliably
checkpointed (``spark.checkpoint.dir``) every few steps, so a lost executor
recomputes at most a few ``replace`` projections.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenledger.functions.tokens import apply_rules, char_to_id
from tokenledger.operators.pairs import pair_counts, top_pairs
from tokenledger.operators.train_index import Step, train_indexed
from tokenledger.operators.words import first_key
from tokenledger.session import bounded_workers, drop_scratch, ensure_checkpoint_dir, materialize, num_partitions

RULES_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("left", T.IntegerType(), False),
    T.StructField("right", T.IntegerType(), False),
    T.StructField("new_id", T.IntegerType(), False),
    T.StructField("n", T.LongType(), False),
])


@dataclass(frozen=True)
class Rule:
    rank: int
    left: int
    right: int
    new_id: int
    n: int


@dataclass(frozen=True)
class Candidate:
    left: int
    right: int
    n: int


@dataclass
class TrainResult:
    rules: list[Rule]
    first_id: int
    jobs: int = 0
    batches: list[int] = field(default_factory=list)
    step_seconds: list[float] = field(default_factory=list)
    setup_seconds: float = 0.0
    indexed: list[Step] = field(default_factory=list)  # steps made from the index

    @property
    def next_id(self) -> int:
        return self.first_id + len(self.rules)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return rules_df(spark, self.rules)


def rules_df(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.rank, r.left, r.right, r.new_id, r.n) for r in rules],
                                 RULES_SCHEMA)


def select_batch(ranked: list[Candidate], remaining: int, complete: bool) -> list[Candidate]:
    """Longest exact batch from the head of a ranked candidate list.

    ``complete`` says the list holds every candidate with enough count
    (nothing unknown ranks above the minimum count, or the floor below which
    words are cut: no listed pair is below it).

    Merging ``(a, b)`` only consumes a token that sits next to its partner,
    so it can destroy occurrences of ``(b, y)`` and ``(x, a)`` (the shared
    token on the opposite side) but never of ``(a, y)`` or ``(x, b)``: a
    token has one right and one left neighbour.  The batch is the ranked
    prefix without opposite-side sharing (and without self-pairs after the
    first; a self-pair first goes alone).  Counts inside it do not move and
    neither does their relative order; pairs outside it can only lose
    occurrences.  New pairs ``(x, N)``, ``(N, y)``, ``(N, M)`` cost an
    occurrence of ``(x, a)``, ``(b, y)`` or ``(b, c)``, so their count is at
    most that of an opposite-side ("generator") pair.  The batch is cut back
    until its last count is strictly above every generator's -- then
    one-by-one training picks exactly these pairs, in this order.
    """
    if not ranked or remaining <= 0:
        return []
    head = ranked[0]
    batch = [head]
    if head.left != head.right:
        lefts, rights = {head.left}, {head.right}
        for c in ranked[1:]:
            if c.left == c.right or c.left in rights or c.right in lefts:
                break
            batch.append(c)
            lefts.add(c.left)
            rights.add(c.right)
    # Pairs beyond a partial list may be generators with up to its last count.
    unknown = 0 if complete else ranked[-1].n
    k = len(batch)
    while k > 1:
        taken = batch[:k]
        lefts = {c.left for c in taken}
        rights = {c.right for c in taken}
        members = set(taken)
        gen = max((c.n for c in ranked
                   if c not in members and (c.right in lefts or c.left in rights)), default=0)
        if taken[-1].n > max(gen, unknown):
            break
        k -= 1
    return batch[:min(k, remaining)]


# Target size of a training partition (distinct words).
WORDS_PER_PARTITION = 20_000

# Rules learned by counting all words; later ones come from an index.
INDEX_FROM = 128

# Pending-rule chains are padded to a multiple of this, so steps reuse a few
# compiled code shapes instead of compiling a new one every job.
CHAIN_BUCKET = 4


# Pairs kept uncut for each rule that is still to be learned, and besides.
KEPT_PAIRS = 1.5
MORE_KEPT = 16


def _padded(n: int) -> int:
    return -(-n // CHAIN_BUCKET) * CHAIN_BUCKET


def kept_pairs(ranked: list, k: int, min_count: int) -> tuple[set[str], int]:
    """``(pairs, floor)`` from the ``k`` best pairs: all pairs with at least
    ``floor`` occurrences.  Ties at the end of a full list are not all known."""
    if len(ranked) < k:
        return {r["pair"] for r in ranked}, min_count
    floor = int(ranked[-1]["n"]) + 1
    return {r["pair"] for r in ranked if r["n"] >= floor}, floor


def cut_words(words: DataFrame, kept: set[str], shift: int) -> DataFrame:
    """The distinct fragments, of two tokens or more, of words ``(tok, freq,
    first)`` cut between the tokens of every pair that is not in ``kept``:
    ``(tok, freq, first, blen)``, where ``first`` is the first occurrence of the
    fragment, ``word key << shift | position``."""
    rights: dict[str, set[str]] = {}
    for a, b in kept:
        rights.setdefault(a, set()).add(b)
    one_of = lambda cs: "[" + "".join(re.escape(c) for c in sorted(cs)) + "]"
    pattern = "(?:" + "|".join(f"{re.escape(a)}(?={one_of(bs)})" for a, bs in sorted(rights.items())) + ")+."

    def run(batches):
        found = re.compile(pattern, re.DOTALL).finditer
        for b in batches:
            toks, freqs, firsts = [], [], []
            for tok, freq, first in zip(*(b.column(i).to_pylist() for i in range(3))):
                for m in found(tok):
                    toks.append(m[0])
                    freqs.append(freq)
                    firsts.append((first << shift) + m.start())
            yield pa.RecordBatch.from_arrays([pa.array(toks, pa.string()), pa.array(freqs, pa.int64()), pa.array(firsts, pa.int64())],
                                             names=["tok", "freq", "first"])

    bounded_workers(words.sparkSession)
    cut = words.select("tok", F.col("freq").cast("bigint"), "first").mapInArrow(run, "tok string, freq bigint, first bigint")
    return cut.groupBy("tok").agg(F.sum("freq").alias("freq"), F.min("first").alias("first")).withColumn("blen", F.char_length("tok"))


def train_bpe(words: DataFrame, num_merges: int = 80, first_id: int = 256,
              batched: bool = True, fetch: int = 64, checkpoint_every: int = 8,
              min_count: int = 2, written: bool = False, index_from: int = INDEX_FROM) -> TrainResult:
    """Learn up to ``num_merges`` rules from a word table ``(tok, freq, first)``.

    Stops early when no pair occurs ``min_count`` times.  ``batched=False``
    runs exactly one merge per job (the reference procedure, used to test
    the batching).  ``written`` says the table is already a written one (the
    caller keeps it), so it is not written again.  Beyond ``index_from`` rules
    only touched words are counted (``operators.train_index``); the rules are
    the same.
    """
    spark = words.sparkSession
    result = TrainResult(rules=[], first_id=first_id)
    if num_merges <= 0:
        return result
    k_fetch = max(2, fetch) if batched else 1
    ensure_checkpoint_dir(spark)

    t_setup = time.perf_counter()
    keys = first_key(words.select("tok", "freq", "first").where(F.char_length("tok") >= 2), write=not written)
    shift, max_len = keys.shift, keys.max_len
    scratch: list[str] = []
    first = F.col("first") if shift is None else F.col("wkey")
    # The table's files give as many partitions as its size asks for; a table
    # with fewer is dealt out to one per WORDS_PER_PARTITION words.  The set
    # is kept in memory; a lost block is re-read from the files.
    parts = max(1, -(-keys.n_words // WORDS_PER_PARTITION))
    base = keys.frame.select("tok", "freq", first.alias("first"), F.char_length("tok").alias("blen"))
    current = num_partitions(base)
    if current is not None and current < parts:
        base = base.repartition(parts)
    whole = base
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    result.setup_seconds = time.perf_counter() - t_setup
    # Each step reads the last written working set and re-applies the rules
    # learned since (a narrow projection); every ``checkpoint_every`` steps
    # the set is rewritten, so lineage and recompute stay short.
    pending: list[Rule] = []
    since_ckpt = 0
    next_id = first_id
    recounted = num_merges if not batched or shift is None else min(num_merges, index_from)
    # Pairs below the floor are cut or not all listed; ``cut`` says the working
    # set is made of fragments, whose keys already hold a position.
    floor, cut, cuttable, k_asked = min_count, False, batched and shift is not None, k_fetch
    try:
        while len(result.rules) < recounted:
            t_step = time.perf_counter()
            cur = base if not pending else base.select(
                apply_rules("tok", pending, _padded(len(pending))).alias("tok"), "freq", "first",
                "blen")
            counts = pair_counts(cur, shift=0 if cut else shift, max_len=max_len, route_len="blen")
            if cuttable and (not cut or since_ckpt >= checkpoint_every > 0):
                k_asked = max(2, int(KEPT_PAIRS * (recounted - len(result.rules))) + MORE_KEPT)
                top = top_pairs(counts, k_asked, floor if cut else min_count).collect()
                kept, least = kept_pairs(top, k_asked, floor if cut else min_count)
                if not kept:  # nothing but ties: the working set stays as it is
                    cuttable, floor = cut, floor if cut else min_count
                else:
                    result.jobs += 1
                    floor = least
                    pieces, p = materialize(cut_words(cur, kept, 0 if cut else shift), "train-fragments")
                    base.unpersist()
                    for old in scratch:
                        drop_scratch(spark, old)
                    scratch, base = [p], pieces.persist(StorageLevel.MEMORY_AND_DISK)
                    cut, pending, since_ckpt = True, [], 0
            else:
                k_asked = k_fetch
                top = top_pairs(counts, k_asked, floor).collect()
            result.jobs += 1
            if not top and cut and floor > min_count:
                base.unpersist()
                base, pending, cut = whole, list(result.rules), False
                continue
            if not top:
                break
            ranked = [Candidate(char_to_id(r["pair"][0]), char_to_id(r["pair"][1]), int(r["n"]))
                      for r in top]
            if batched:
                batch = select_batch(ranked, recounted - len(result.rules),
                                     complete=len(top) < k_asked)
            else:
                batch = ranked[:1]
            for c in batch:
                rule = Rule(len(result.rules), c.left, c.right, next_id, c.n)
                result.rules.append(rule)
                pending.append(rule)
                next_id += 1
            result.batches.append(len(batch))
            since_ckpt += 1
            if (not cut and len(result.rules) < recounted and checkpoint_every > 0
                    and since_ckpt >= checkpoint_every):
                nxt = base.select(apply_rules("tok", pending, _padded(len(pending))).alias("tok"),
                                  "freq", "first")
                written, p = materialize(
                    nxt.select("tok", "freq", "first", F.char_length("tok").alias("blen"))
                    .where(F.col("blen") >= 2), "train-words")
                # The new working set reads only its own files: release the
                # previous one (cache and files) right away.
                base.unpersist()
                for old in scratch:
                    drop_scratch(spark, old)
                scratch = [p]
                base = written.persist(StorageLevel.MEMORY_AND_DISK)
                pending = []
                since_ckpt = 0
            result.step_seconds.append(round(time.perf_counter() - t_step, 3))
        if recounted == len(result.rules) < num_merges:
            if cut:
                base.unpersist()
                base, pending = whole, list(result.rules)
            now = base if not pending else base.select(apply_rules("tok", pending).alias("tok"), "freq", "first")
            result.indexed = train_indexed(now.select("tok", "freq", "first"), shift, max_len, result, num_merges,
                                           min_count=min_count)
    finally:
        base.unpersist()
        for p in [*scratch, *keys.paths]:
            drop_scratch(spark, p)
    return result


def compression(words: DataFrame, rules: list[Rule]) -> DataFrame:
    """Corpus tokens before and after training, and their ratio (one row)."""
    seq = words.select("freq", F.char_length("tok").alias("b"),
                       F.char_length(apply_rules("tok", rules)).alias("a"))
    agg = seq.agg(F.sum(F.col("freq") * F.col("b")).alias("tokens_before"),
                  F.sum(F.col("freq") * F.col("a")).alias("tokens_after"))
    return agg.withColumn("ratio", F.try_divide(F.col("tokens_after").cast("double"),
                                                F.col("tokens_before").cast("double")))


def frequent_word_rules(words: DataFrame, k: int, first_id: int = 256) -> list[Rule]:
    """Rules that spell the ``k`` most frequent words (ties by the word) from
    left to right, a cheap way to a long rule list: one aggregation, and ``k``
    words reach the driver.  Words that begin alike share the rules of their
    beginning; ``n`` is the frequency of the word that brought a rule."""
    top = (words.where(F.char_length("tok") >= 2).select("tok", "freq")
           .orderBy(F.desc("freq"), F.asc("tok")).limit(k).collect())
    ids: dict[str, int] = {}
    rules: list[Rule] = []
    for r in top:
        tok = r["tok"]
        for i in range(2, len(tok) + 1):
            if tok[:i] not in ids:
                left = ids[tok[:i - 1]] if i > 2 else char_to_id(tok[0])
                ids[tok[:i]] = first_id + len(rules)
                rules.append(Rule(len(rules), left, char_to_id(tok[i - 1]), ids[tok[:i]], int(r["freq"])))
    return rules
