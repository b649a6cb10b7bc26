"""Bolt-on vocabularies by one automaton: every variant from one scan of a text.

The entries of all variants form one Aho-Corasick automaton; an entry carries a
bit mask of the variants that hold it.  A text is scanned once, which lists all
matches of all entries.  Per variant a left-to-right pick over that list takes
the longest entry of its bit at each place, the rest of the text is encoded by
the merge queue, and variants with the same picks share the result.

The scan takes time by the length of the text, whatever the number of entries,
where a regex tries branch after branch and one pattern per variant.  Texts go
to Python in Arrow batches: a narrow pass without shuffle or key, so it also
runs on a stream.  The entries are broadcast, up to ``SCAN_ENTRIES`` of them;
beyond that ``operators.match`` joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenledger.functions.tokens import char_to_id, id_to_char
from tokenledger.functions.vocab import BARRIER, BARRIER_BYTES
from tokenledger.operators.queue_encode import MergeQueue, slices
from tokenledger.session import bounded_workers

#: Entries of all variants together that one automaton may hold (about 100 MB a worker).
SCAN_ENTRIES = 200_000

#: Ids of one bitmap, the size that Spark's bitmap functions use.
BITMAP_BITS = 32_768

Entries = Sequence[tuple[str, int]]


def latin(text: str) -> str:
    """The text's UTF-8 bytes, one character each."""
    return text.encode().decode("latin-1")


class Scanner:
    """The automaton, the masks and the rules, in one worker."""

    def __init__(self, variants: Sequence[Entries], rules):
        import ahocorasick

        self.n, self.queue = len(variants), MergeQueue(rules)
        self.masks: list[int] = []
        self.terms: list[str] = []
        self.ids: list[dict[int, str]] = [{} for _ in variants]  # by variant: entry -> token character
        place: dict[str, int] = {}
        for v, entries in enumerate(variants):
            for term, token_id in entries:
                if not term:
                    continue
                i = place.setdefault(term, len(place))
                if i == len(self.terms):
                    self.terms.append(term)
                    self.masks.append(0)
                self.masks[i] |= 1 << v
                self.ids[v].setdefault(i, id_to_char(token_id))
        self.sizes = [len(t) for t in self.terms]
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.terms):
            self.automaton.add_word(t, i)
        if self.terms:
            self.automaton.make_automaton()

    def found(self, text: str) -> list[tuple[int, int, int]]:
        """All matches ``(start, -size, entry)`` by start, the longest first."""
        if not self.terms:
            return []
        size = self.sizes
        return sorted([(end + 1 - size[i], -size[i], i) for end, i in self.automaton.iter(text)])

    def pick(self, found: list[tuple[int, int, int]], variant: int) -> tuple[tuple[int, int], ...]:
        """``(start, entry)`` of the variant's matches, greedy from the left."""
        end, bit, masks, out = 0, 1 << variant, self.masks, []
        for start, size, i in found:
            if start >= end and masks[i] & bit:
                out.append((start, i))
                end = start - size
        return tuple(out)

    def _runs(self, text: str, picks) -> list[str]:
        at, runs = 0, []
        for start, i in picks:
            runs.append(text[at:start])
            at = start + self.sizes[i]
        return [*runs, text[at:]]

    def counts(self, text: str) -> list[int]:
        """Tokens without a vocabulary and with each variant's."""
        base, found = len(self.queue(latin(text))), self.found(text)
        done: dict[tuple, int] = {(): base}
        out = [base]
        for v in range(self.n):
            picks = self.pick(found, v) if found else ()
            if picks not in done:
                runs = self._runs(text, picks)
                if BARRIER in text:
                    marked = BARRIER.join(map(latin, runs))
                else:
                    marked = latin(BARRIER.join(runs)).replace(BARRIER_BYTES, BARRIER)
                done[picks] = len(self.queue(marked))
            out.append(done[picks])
        return out

    def token_string(self, text: str, variant: int = 0) -> str:
        picks = self.pick(self.found(text), variant)
        runs, ids = self._runs(text, picks), self.ids[variant]
        return self.queue("".join([x for r, (_, i) in zip(runs, picks) for x in (latin(r), ids[i])]) + latin(runs[-1]))

    def token_strings(self, text: str) -> list[str]:
        """The token string without a vocabulary and with each variant's."""
        base, found = self.queue(latin(text)), self.found(text)
        done: dict[tuple, str] = {(): base}
        out = [base]
        for v in range(self.n):
            picks = self.pick(found, v) if found else ()
            ids = tuple((start, self.ids[v][i]) for start, i in picks)  # an entry's id depends on the variant
            if ids not in done:
                runs = self._runs(text, picks)
                done[ids] = self.queue("".join([x for r, (_, c) in zip(runs, ids) for x in (latin(r), c)]) + latin(runs[-1]))
            out.append(done[ids])
        return out

    def matches(self, text: str, variant: int = 0) -> list[str]:
        return [self.terms[i] for _, i in self.pick(self.found(text), variant)]


def _bitmaps(ids) -> list[tuple[int, bytes]]:
    """``(part, bits)``: id ``part * BITMAP_BITS + k`` is bit ``k`` of its part."""
    parts: dict[int, bytearray] = {}
    for i in ids:
        part, k = divmod(i, BITMAP_BITS)
        parts.setdefault(part, bytearray(BITMAP_BITS // 8))[k // 8] |= 1 << k % 8
    return [(p, bytes(b)) for p, b in sorted(parts.items())]


_built: dict[str, Scanner] = {}


def _scanner(key: str, shared) -> Scanner:
    """One scanner per worker process, the last one used."""
    if key not in _built:
        _built.clear()
        _built[key] = Scanner(*shared.value)
    return _built[key]


@dataclass(frozen=True)
class VariantScan:
    """Vocabularies by name over one rule list: ``(term, token id)`` each."""

    rules: tuple
    variants: dict  # name -> entries

    def __post_init__(self):
        if sum(len(e) for e in self.variants.values()) > SCAN_ENTRIES:
            raise ValueError("use bolt_on(): a vocabulary of this size is matched by joins")

    @cached_property
    def _key(self) -> str:
        return uuid4().hex

    def _column(self, df: DataFrame, text: str, out: list[T.StructField], method) -> DataFrame:
        """``df`` with columns computed from each text, null for a null text."""
        spark = df.sparkSession
        bounded_workers(spark)
        shared = spark.sparkContext.broadcast(([list(e) for e in self.variants.values()], self.rules))
        key, at, names = self._key, df.columns.index(text), [f.name for f in out]
        kept = [i for i, c in enumerate(df.columns) if c not in names]
        types = [pa.int64() if f.dataType == T.LongType() else pa.string() if f.dataType == T.StringType()
                 else pa.list_(pa.string()) for f in out]
        labels = [*(df.columns[i] for i in kept), *names]

        def run(batches):
            scan = _scanner(key, shared)
            for b in (part for whole in batches for part in slices(whole, at)):
                rows = [(None,) * len(names) if t is None else method(scan, t) for t in b.column(at).to_pylist()]
                cols = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *(pa.array(c, t) for c, t in zip(cols, types))],
                                                 names=labels)

        return df.mapInArrow(run, T.StructType([*(df.schema.fields[i] for i in kept), *out]))

    def counts(self, df: DataFrame, text: str = "text", base: str = "base") -> DataFrame:
        """``df`` with a count without vocabulary (``base``) and one per variant."""
        out = [T.StructField(n, T.LongType()) for n in (base, *self.variants)]
        return self._column(df, text, out, lambda scan, t: scan.counts(t))

    def used_ids(self, df: DataFrame, text: str = "text", base: str = "base") -> DataFrame:
        """``(variant, used_ids)``: how many different token ids the texts use
        without a vocabulary (``base``) and with each variant's.  Every task
        marks the ids it meets in bitmaps of ``BITMAP_BITS`` ids; their union is
        a native bitmap aggregate, so no id becomes a row."""
        spark = df.sparkSession
        bounded_workers(spark)
        shared = spark.sparkContext.broadcast(([list(e) for e in self.variants.values()], self.rules))
        key, names = self._key, [base, *self.variants]

        def run(batches):
            scan, used = _scanner(key, shared), [set() for _ in names]
            for b in (part for whole in batches for part in slices(whole, 0)):
                for t in b.column(0).to_pylist():
                    for s, tokens in zip(used, scan.token_strings(t) if t else ()):
                        s.update(tokens)
            rows = [(n, *x) for n, s in zip(names, used) for x in _bitmaps(map(char_to_id, s))]
            if rows:
                variant, part, bits = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(variant, pa.string()), pa.array(part, pa.int64()), pa.array(bits, pa.binary())],
                                                 names=["variant", "part", "bits"])

        marked = df.select(text).mapInArrow(run, "variant string, part bigint, bits binary")
        return marked.groupBy("variant", "part").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).groupBy("variant").agg(
            F.sum("n").alias("used_ids"))

    # The operations of BoltOn and LargeBoltOn, for the first variant; ``key`` is not needed.
    def with_counts(self, df: DataFrame, key: Sequence[str] = (), text: str = "text", out: str = "bolt_tokens") -> DataFrame:
        return self._column(df, text, [T.StructField(out, T.LongType())], lambda scan, t: (scan.counts(t)[1],))

    def with_token_string(self, df: DataFrame, key: Sequence[str] = (), text: str = "text", out: str = "token_string") -> DataFrame:
        return self._column(df, text, [T.StructField(out, T.StringType())], lambda scan, t: (scan.token_string(t),))

    def with_matches(self, df: DataFrame, text: str = "text", out: str = "matches") -> DataFrame:
        return self._column(df, text, [T.StructField(out, T.ArrayType(T.StringType()))], lambda scan, t: (scan.matches(t),))

    def matched(self, df: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
        """``(*key, term)``, one row per match."""
        return self.with_matches(df, text, "_m").select(*key, F.explode("_m").alias("term"))


def scan_of(vocab: DataFrame, rules, name: str = "bolt_tokens") -> VariantScan:
    """A vocabulary table of up to ``SCAN_ENTRIES`` entries, ready to scan."""
    rows = vocab.select("term", "token_id").orderBy("token_id").limit(SCAN_ENTRIES + 1).collect()
    if rows and rows[0]["token_id"] <= max((r.new_id for r in rules), default=255):
        raise ValueError("bolt-on ids must start above every rule id")
    return VariantScan(tuple(rules), {name: tuple((r["term"], int(r["token_id"])) for r in rows)})
