"""BPE training from an inverted index: after a merge only touched words are counted.

``operators.train`` recounts every pair of every word in each step.  The first
merges touch most words anyway; later ones touch few, and a tokenizer has
thousands of them.  From a given point on, training goes on from three tables
written at a *base* (the words after the rules so far):

* ``counts``: pair -> count and first occurrence;
* ``index``: pair -> the words that hold it, one row per pair and word with the
  word itself, in order of the pair (dealt by (pair, word) in ranges, so a
  frequent pair is many files, and a filter on pairs skips the rest);
* ``long``: words too long to repeat for each of their pairs.

Next to them stand the *overlay*, all words touched since the base, and the
counts, both as of the last *commit*.  A step applies the rules learned since
then to the overlay and to the words that the index names for these rules' pairs
and that no earlier rule touched.  Pairs of the words that change, before (minus)
and after (plus), are count deltas, added to the counts in one aggregation; the
best pairs reach the driver.  Every ``COMMIT`` steps overlay and counts are
written again; when many words are touched or many rules were learned, the rules
are applied to all words and a new base is written.  All state is in written
tables, so a lost executor recomputes part of one step.

Ties
----
The order among equal counts is the first occurrence (word, position), which
words that do not change keep.  Occurrences of a pair only vanish once both its
tokens exist, so its first occurrence only moves back:

* it stands in a word that did not change: it stays;
* its word changed and still holds the pair: it is the new place there;
* its word lost the pair: unknown, but later than before.  Such a pair is
  *stale*, its old place a lower bound; only if its count ties with another
  candidate is the exact place looked up, in the index rows of that pair.

So the rules are the same, one by one, as those of ``train_bpe``.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tokenledger.functions.tokens import apply_rules, char_to_id, id_to_char
from tokenledger.operators.pairs import SHORT_WORD, _pairs_of, explode_pairs, pair_counts
from tokenledger.session import drop_scratch, materialize

#: Rules learned on a base before a new one is written.
PENDING = 256
#: Share of the words in the overlay before a new base is written.
TOUCHED = 0.4
#: Steps between commits of overlay and counts.
COMMIT = 6
#: Index rows per file.
ROWS_PER_FILE = 50_000


@dataclass
class Step:
    """One step: merges taken, words that changed and were counted, seconds."""

    merges: int
    words_counted: int
    seconds: float
    looked_up: int = 0


@dataclass
class Base:
    """Written tables at one point of the training."""

    words: DataFrame
    counts: DataFrame
    index: DataFrame
    long: DataFrame
    n_words: int
    files: int
    next_id: int
    paths: list[str] = field(default_factory=list)

    def drop(self) -> None:
        for p in self.paths:
            drop_scratch(self.words.sparkSession, p)


def build_base(words: DataFrame, shift: int, max_len: int, next_id: int) -> Base:
    """The tables of ``words(tok, freq, first)``, with ``first`` the word's bigint key."""
    words, at = materialize(words.where(F.char_length("tok") >= 2), "base-words")
    st = words.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("tok") - 1).alias("pairs")).first()
    short = words.where(F.char_length("tok") <= SHORT_WORD)
    rows = short.select(F.explode(F.array_distinct(_pairs_of(F.col("tok")))).alias("pair"), "tok", "freq", "first")
    files = max(1, -(-(st["pairs"] or 0) // ROWS_PER_FILE))
    frames = [(pair_counts(words, shift=shift, max_len=max_len), "base-counts"),
              (rows.repartitionByRange(files, "pair", "first").sortWithinPartitions("pair"), "base-index")]
    if max_len > SHORT_WORD:
        frames.append((words.where(F.char_length("tok") > SHORT_WORD), "base-long"))
    with ThreadPoolExecutor(len(frames)) as pool:  # independent jobs side by side
        made = list(pool.map(lambda f: materialize(*f), frames))
    counts, index = made[0][0], made[1][0]
    long = made[2][0] if len(made) > 2 else words.where(F.lit(False))
    return Base(words, counts, index, long, int(st["n"]), files, next_id, [at, *(p for _, p in made)])


def _sql_text(value: str) -> str:
    return "'" + "".join(f"\\U{ord(c):08X}" for c in value) + "'"


def _is_one_of(column: str, values: list[str]) -> Column:
    """Equalities, which the file scan can use to skip row groups."""
    return F.expr(" OR ".join(f"{column} = {_sql_text(v)}" for v in values) or "false")


#: Between values that travel as one literal; no token string holds it.
_BETWEEN = "\U0010FFFF"


def _array(values: list[str]) -> Column:
    """A literal array: one constant whatever its length, so that plans and
    generated code of all steps look alike."""
    return F.split(F.lit(_BETWEEN.join(values)), _BETWEEN)


def _held(tok: str, pairs: list[str]) -> Column:
    """Those of ``pairs`` that the token string holds, in order."""
    return F.filter(_array(pairs), lambda p: F.instr(F.col(tok), p) > 0) if pairs else F.array().cast("array<string>")


def _replayed(tok: str, rules) -> Column:
    """``apply_rules`` as one fold: few words, many rules."""
    steps = F.arrays_zip(_array([_pair(r) for r in rules]).alias("p"), _array([id_to_char(r.new_id) for r in rules]).alias("n"))
    return F.aggregate(steps, F.col(tok), lambda t, r: F.replace(t, r["p"], r["n"]))


def _pair(rule) -> str:
    return id_to_char(rule.left) + id_to_char(rule.right)


class _State:
    """A base, the last commit on it and the rules learned since."""

    def __init__(self, words: DataFrame, shift: int, max_len: int, next_id: int):
        self.shift, self.max_len, self.base = shift, max_len, build_base(words, shift, max_len, next_id)
        self.done: list = []  # rules between base and commit
        self.pending: list = []  # rules since the commit
        self.overlay: DataFrame | None = None
        self.counts = self.base.counts.withColumn("stale", F.lit(False))
        self.paths: list[str] = []
        self.changed = self.touched = self.steps = 0

    @property
    def rules(self) -> list:
        return self.done + self.pending

    def drop(self) -> None:
        for p in self.paths:
            drop_scratch(self.base.words.sparkSession, p)
        self.base.drop()

    def _pairs(self, rules) -> list[str]:
        # a rule with a newer token only meets words that an older rule touched
        return [_pair(r) for r in rules if max(r.left, r.right) < self.base.next_id]

    def _words(self) -> DataFrame:
        """``(was, tok, freq, first)``: the overlay and the words that pending
        rules are the first to touch, each once, at the commit and now."""
        pairs, before = self._pairs(self.pending), self._pairs(self.done)
        words = None if self.overlay is None else self.overlay.select("tok", "freq", "first")
        if pairs or words is None:
            held = F.try_element_at(_held("tok", pairs), F.lit(1))  # of a word's pairs, one row speaks
            untouched = F.size(_held("tok", before)) == 0 if before else F.lit(True)
            met = self.base.index.where(_is_one_of("pair", pairs)).where((held == F.col("pair")) & untouched).select("tok", "freq", "first")
            if self.max_len > SHORT_WORD:
                met = met.unionByName(self.base.long.where(held.isNotNull() & untouched).select("tok", "freq", "first"))
            words = met if words is None else words.unionByName(met)
        return words.select(F.col("tok").alias("was"), _replayed("tok", self.pending).alias("tok"), "freq", "first")

    def _counted(self, seen: Observation) -> DataFrame:
        """``(pair, n, first, stale)`` now: counts of the commit and deltas."""
        if not self.pending:
            return self.counts
        sides = F.array(F.struct(F.lit(-1).alias("s"), F.col("was").alias("t")), F.struct(F.lit(1).alias("s"), F.col("tok").alias("t")))
        moved = F.col("was") != F.col("tok")
        both = self._words().observe(seen, F.count_if(moved).alias("changed"), F.count(F.lit(1)).alias("touched")).where(
            moved).select("freq", "first", F.char_length("was").alias("len"), F.explode(sides).alias("x")).select(
            "freq", "first", "len", "x.s", F.col("x.t").alias("tok"))
        ex = explode_pairs(both, "tok", {"_f": F.col("freq") * F.col("s"), "_o": F.col("first"), "_s": F.col("s")}, self.max_len, "len")
        key = F.shiftleft(F.col("_o"), self.shift) + F.col("_i")
        none = F.lit(None).cast("bigint")
        rows = self.counts.select("pair", "n", F.col("first").alias("f0"), "stale", none.alias("gone"), none.alias("came")).unionByName(
            ex.select("pair", F.col("_f").alias("n"), none.alias("f0"), F.lit(False).alias("stale"),
                      F.when(F.col("_s") < 0, key).alias("gone"), F.when(F.col("_s") > 0, key).alias("came")))
        found = rows.groupBy("pair").agg(F.sum("n").alias("n"), F.min("f0").alias("f0"), F.bool_or("stale").alias("stale"),
                                         F.min("gone").alias("gone"), F.min("came").alias("came")).where(F.col("n") > 0)
        f0, came = F.col("f0"), F.col("came")
        kept = F.coalesce(F.col("gone") > f0, F.lit(True))
        here = F.coalesce(F.shiftright(came, self.shift) == F.shiftright(f0, self.shift), F.lit(False))
        first = F.when(f0.isNull(), came).when(kept, f0).when(here, came).otherwise(f0)
        return found.select("pair", "n", first.alias("first"), (F.col("stale") | (f0.isNotNull() & ~kept & ~here)).alias("stale"))

    def best(self, k: int, min_count: int) -> list[dict]:
        """The ``k`` best pairs ``(pair, n, first, stale)``."""
        seen = Observation()
        top = self._counted(seen).where(F.col("n") >= min_count).orderBy(F.desc("n"), F.asc("first")).limit(k).collect()
        if self.pending:
            self.changed, self.touched = int(seen.get["changed"]), int(seen.get["touched"])
        return [r.asDict() for r in top]

    def commit(self) -> None:
        """Write overlay and counts as they are now."""
        with ThreadPoolExecutor(2) as pool:
            made = list(pool.map(lambda f: materialize(*f), [
                (self._words().select("tok", "freq", "first").coalesce(self.base.files), "overlay"),
                (self._counted(Observation()), "counts")]))
        for p in self.paths:
            drop_scratch(self.base.words.sparkSession, p)
        (self.overlay, a), (self.counts, b) = made
        self.paths, self.done, self.pending = [a, b], self.rules, []

    def settle(self, rows: list[dict]) -> None:
        """Exact first occurrences of stale pairs, from the words that hold
        them: touched ones in their present form, the others in the index."""
        pairs = [r["pair"] for r in rows]
        place = lambda p: F.shiftleft("first", self.shift) + F.instr("tok", p) - 1
        apart = F.size(_held("tok", self._pairs(self.rules))) == 0
        left = self.base.index.where(_is_one_of("pair", pairs)).where(apart).select("pair", place(F.col("pair")).alias("at"))
        whole = [self._words().select("tok", "first") if self.pending else self.overlay.select("tok", "first")]
        if self.max_len > SHORT_WORD:
            whole.append(self.base.long.where(apart).select("tok", "first"))
        for df in whole:
            held = F.transform(_held("tok", pairs), lambda p: F.struct(p.alias("pair"), place(p).alias("at")))
            left = left.unionByName(df.select(F.explode(held).alias("x")).select("x.pair", "x.at"))
        at = {r["pair"]: r["at"] for r in left.groupBy("pair").agg(F.min("at").alias("at")).collect()}
        for r in rows:
            r["first"], r["stale"] = at[r["pair"]], False


def _batch(state: _State, top: list[dict], remaining: int, complete: bool) -> tuple[list, int]:
    """The next exact batch and the number of pairs looked up; no batch if a
    pair beyond the list could come before its first row."""
    from tokenledger.operators.train import Candidate, select_batch

    bound, looked = top[-1]["first"], 0  # pairs beyond the list with its last count come later
    while True:
        ranked = [Candidate(char_to_id(r["pair"][0]), char_to_id(r["pair"][1]), int(r["n"])) for r in top]
        batch = select_batch(ranked, remaining, complete)
        # order matters only down to the count of the batch's last pair
        n = [r["n"] for r in top]
        ties = [r for i, r in enumerate(top) if r["stale"] and r["n"] >= batch[-1].n and (
            i and n[i - 1] == r["n"] or i + 1 < len(top) and n[i + 1] == r["n"] or not complete and r["n"] == n[-1])]
        if not ties:
            return batch if complete or n[0] > n[-1] or top[0]["first"] <= bound else [], looked
        state.settle(ties)
        looked += len(ties)
        top.sort(key=lambda r: (-r["n"], r["first"]))


def train_indexed(words: DataFrame, shift: int, max_len: int, result, num_merges: int, fetch: int = 256,
                  min_count: int = 2) -> list[Step]:
    """Go on training from ``words(tok, freq, first)``, to which the rules of
    ``result`` are applied, until it has ``num_merges`` rules."""
    from tokenledger.operators.train import Rule

    steps: list[Step] = []
    state = _State(words, shift, max_len, result.next_id)
    try:
        while len(result.rules) < num_merges:
            t0 = time.perf_counter()
            batch, looked, k = [], 0, fetch
            while not batch:
                top = state.best(k, min_count)
                if not top:
                    return steps
                batch, looked = _batch(state, top, num_merges - len(result.rules), len(top) < k)
                k *= 4  # in case more pairs tie for the best count than were fetched
            rules = []
            for c in batch:
                rules.append(Rule(len(result.rules), c.left, c.right, result.next_id, c.n))
                result.rules.append(rules[-1])
            result.batches.append(len(batch))
            result.jobs += 1
            counted = state.changed
            if len(result.rules) < num_merges:
                if len(state.rules) + len(rules) > PENDING or state.touched > TOUCHED * state.base.n_words:
                    now = state.base.words.select(apply_rules("tok", state.rules + rules).alias("tok"), "freq", "first")
                    fresh = _State(now, shift, max_len, result.next_id)
                    state.drop()
                    state = fresh
                else:
                    state.steps += 1
                    state.pending += rules
                    if state.steps % COMMIT == 0:
                        state.commit()
            steps.append(Step(len(batch), counted, round(time.perf_counter() - t0, 3), looked))
            result.step_seconds.append(steps[-1].seconds)
        return steps
    finally:
        state.drop()
