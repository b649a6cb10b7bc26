"""Longest-match of a vocabulary of any size, as joins.

Texts are numbered in a written table and dealt with in blocks of rows.  A Bloom
filter of the entries (UTF-8 strings, at most 1 MB, broadcast) looks at all
windows of a block at once and leaves the different strings that very likely are
entries; an equi-join on the term keeps the real ones.  Terms are broadcast up to
``BROADCAST_ENTRIES`` counted rows, beyond that both sides shuffle.  Every block
then meets the entries that stand in it, and only those, in a cogroup: one scan
lists the matches, per position the longest counts, and a left-to-right pick
takes non-overlapping ones.  No task holds the vocabulary, no match becomes a row
unless it is asked for, and the work follows the length of the text.

Rows are matched by their number, so ``key`` columns may repeat, be null, or be
of any type; they only come back with the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenledger.functions.tokens import NESTED_REPLACE_LIMIT, apply_rules, char_to_id
from tokenledger.operators.queue_encode import with_rules
from tokenledger.operators.scan import Scanner
from tokenledger.session import bounded_workers, materialize

BROADCAST_ENTRIES = 200_000

# Bits of a filter per entry (two are set: 0.4 % of other strings pass), and its
# largest size, 1 MB; a vocabulary far beyond that is left to the join.
_BITS = 32
_MOST_BITS = 1 << 23
_WORD = 32

# Rows of a block: 128.
_BLOCK_BITS = 7

# Windows are hashed as polynomials over scrambled bytes, modulo 2**64.
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def bloom(values: DataFrame, column: str, n: int) -> Callable[[Column], Column]:
    """The filter as a Column, for SQL: a test of ``xxhash64`` values, true for all ``n`` strings of a column and
    few others."""
    m = min(_MOST_BITS, max(1024, 1 << (_BITS * n - 1).bit_length()))

    def places(h: Column) -> tuple[Column, Column]:
        return h.bitwiseAND(F.lit(m - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(m - 1))

    words = [0] * (m // _WORD)
    bits = values.select(F.explode(F.array(*places(F.xxhash64(column)))).alias("p"))
    for r in bits.groupBy(F.shiftright("p", 5).alias("w")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(31)).cast("int"))).alias(
                "b")).collect():
        words[r["w"]] = r["b"]
    table = F.expr("array(" + ",".join(f"{w}L" for w in words) + ")")

    def test(h: Column) -> Column:
        hit = [F.getbit(F.element_at(table, (F.shiftright(p, 5) + 1).cast("int")), p.bitwiseAND(F.lit(31)).cast("int")) == 1
               for p in places(h)]
        return hit[0] & hit[1]

    return test


def numbered(texts: DataFrame, key: Sequence[str], text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(_row, *key, *keep, _t)`` with a number of its own for each row, written once."""
    cols = list(dict.fromkeys([*key, *keep]))
    return materialize(texts.select(F.monotonically_increasing_id().alias("_row"), *cols, F.col(text).alias("_t")), "numbered")[0]


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


class TermFilter:
    """A Bloom filter of the vocabulary's UTF-8 strings over all windows of a
    text at once: true for every entry and few other strings."""

    def __init__(self, sizes: Sequence[int], log_bits: int):
        self.sizes, self.log = sorted(sizes), log_bits
        self.bits = np.zeros(1 << log_bits, dtype=bool)
        self.heads = np.zeros(1 << 16, dtype=bool)  # the entries' first two bytes

    def _sums(self, data: np.ndarray) -> np.ndarray:
        acc = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[data] * _powers(_BASE, len(data)), out=acc[1:])
        return acc

    def _hash(self, acc: np.ndarray, back: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        h = (acc[starts + size] - acc[starts]) * back[starts] + np.uint64(size)
        h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9)

    def _places(self, h: np.ndarray, k: int) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * np.uint64(_PROBES[k])) >> np.uint64(64 - self.log)

    def places_of(self, terms: list[str]) -> np.ndarray:
        """The bits that the entries set."""
        out = [np.zeros(0, np.uint64)]
        for t in terms:
            raw = np.frombuffer(t.encode(), np.uint8)
            h = self._hash(self._sums(raw), _powers(_BASE_INV, len(raw) + 1), np.zeros(1, np.int64), len(raw))
            out += [self._places(h, k) for k in range(len(_PROBES))]
        return np.unique(np.concatenate(out))

    def spots(self, data: np.ndarray, offsets: np.ndarray):
        """``(size, starts, hashes)`` for each entry size: where in the rows
        ``data[offsets[i]:offsets[i + 1]]`` a window passes."""
        n = len(data)
        if not n or not self.sizes:
            return
        edge = np.append((data & 0xC0) != 0x80, True)  # where a character begins
        starts = np.flatnonzero(edge[:-1])
        ends = np.repeat(offsets[1:], np.diff(offsets))[starts]
        if self.sizes[0] > 1:
            starts, ends = starts[starts + 2 <= ends], ends[starts + 2 <= ends]
            ok = self.heads[data[starts].astype(np.int64) << 8 | data[starts + 1]]
            starts, ends = starts[ok], ends[ok]
        acc, back = self._sums(data), _powers(_BASE_INV, n + 1)
        for size in self.sizes:
            at = starts[starts + size <= ends]
            at = at[edge[at + size]]
            h = self._hash(acc, back, at, size)
            for k in range(len(_PROBES)):
                ok = self.bits[self._places(h, k)]
                at, h = at[ok], h[ok]
            if len(at):
                yield size, at, h


def _term_filter(terms: DataFrame, n: int) -> TermFilter:
    """The filter of ``n`` terms; its bits are set in tasks, the driver gets at most 1 MB of them."""
    sizes = [r[0] for r in terms.select(F.octet_length("term")).distinct().collect()]
    made = TermFilter([s for s in sizes if s], (min(_MOST_BITS, max(1024, 1 << (_BITS * n - 1).bit_length())) - 1).bit_length())
    blank = TermFilter(made.sizes, made.log)

    def run(batches):
        for b in batches:
            at = blank.places_of([t for t in b.column(0).to_pylist() if t])
            words, row = np.unique(at >> np.uint64(5), return_inverse=True)
            bits = np.zeros(len(words), np.int64)
            np.bitwise_or.at(bits, row, np.int64(1) << (at & np.uint64(31)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(bits)], names=["w", "b"])

    bounded_workers(terms.sparkSession)
    for r in terms.select("term").mapInArrow(run, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        for i in range(_WORD):
            made.bits[r["w"] * _WORD + i] = r["b"] >> i & 1
    for r in terms.select(F.hex(F.substring(F.encode("term", "UTF-8"), 1, 2)).alias("h")).distinct().collect():
        if len(r["h"]) == 4:
            made.heads[int(r["h"], 16)] = True
    return made


def _runs_of_rows(batch: pa.RecordBatch, at: int, most: int = 1 << 19):
    """``(first, last, bytes, offsets)`` of runs of rows with about ``most`` bytes of text."""
    texts = batch.column(at).cast(pa.large_string()).fill_null("")
    _, off_buf, data_buf = texts.buffers()
    off = np.frombuffer(off_buf, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, side="right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def candidates(texts: DataFrame, terms: DataFrame, n: int) -> DataFrame:
    """``(_row, pos, term)`` of ``texts(_row, _t)``: every place where an entry
    stands, and few others."""
    shared = texts.sparkSession.sparkContext.broadcast(_term_filter(terms, n))

    def run(batches):
        known = shared.value
        for b in batches:
            for first, _, data, off in _runs_of_rows(b, 1):
                rows, chars = b.column(0).to_numpy(), np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                for size, at, _ in known.spots(data, off):
                    row = np.searchsorted(off, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array(rows[first + row]), pa.array((chars[at] - chars[off[row]]).astype(np.int32)),
                        pa.array([data[s:s + size].tobytes().decode() for s in at.tolist()], pa.string())], names=["_row", "pos", "term"])

    return texts.select("_row", "_t").mapInArrow(run, "_row bigint, pos int, term string")


def block_candidates(texts: DataFrame, terms: DataFrame, n: int) -> DataFrame:
    """``(_block, term)``: the different strings of ``candidates`` in each block of rows
    (a string may come more than once)."""
    shared = texts.sparkSession.sparkContext.broadcast(_term_filter(terms, n))

    def run(batches):
        known = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            blocks, made, names = b.column(0).to_numpy(), {}, []
            for first, _, data, off in _runs_of_rows(b, 1):
                for size, at, h in known.spots(data, off):
                    row = blocks[first + np.searchsorted(off, at, side="right") - 1]
                    for block in np.unique(row).tolist():
                        mine = row == block
                        _, one = np.unique(h[mine], return_index=True)
                        made.setdefault(block, set()).update(data[s:s + size].tobytes() for s in at[mine][one].tolist())
            for block, found in made.items():
                names += [(block, t.decode()) for t in found]
            if names:
                ids, strings = zip(*names)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(strings, pa.string())], names=["_block", "term"])

    return texts.select("_block", "_t").mapInArrow(run, "_block bigint, term string")


def _in_blocks(rows: DataFrame, vocab: DataFrame, schema: T.StructType, method) -> DataFrame:
    """``method(scanner, table)`` for every block of ``rows``, where the scanner
    holds the entries that stand in the block: those that the join on the term
    leaves of its candidates."""
    n = vocab.count()
    bounded_workers(rows.sparkSession)
    texts = rows.withColumn("_block", F.shiftright("_row", _BLOCK_BITS))
    terms = vocab.select("term", "token_id")
    none = terms.select(F.lit(0).cast("bigint").alias("_block"), "term").where(F.lit(False))
    sized = F.broadcast(terms) if n <= BROADCAST_ENTRIES else terms.hint("merge")
    found = (block_candidates(texts, terms, n) if n else none).join(sized, "term").select("_block", "term", "token_id")

    def run(block: pa.Table, entries: pa.Table) -> pa.Table:
        listed = sorted(zip(entries.column("token_id").to_pylist(), entries.column("term").to_pylist()))
        return method(Scanner([[(t, i) for i, t in listed]], ()), block)

    return texts.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(run, schema)


def longest_matches(texts: DataFrame, vocab: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """``(*key, pos, term, token_id)``: one row per match, ``pos`` in characters."""
    rows = numbered(texts, key, text)
    keys = list(dict.fromkeys(key))
    schema = T.StructType([*(rows.schema[c] for c in keys), T.StructField("pos", T.IntegerType()),
                           T.StructField("term", T.StringType()), T.StructField("token_id", T.IntegerType())])

    def run(scan: Scanner, block: pa.Table) -> pa.Table:
        row, pos, entry = [], [], []
        for i, t in enumerate(block.column("_t").to_pylist()):
            for start, e in scan.pick(scan.found(t), 0) if t else ():
                row.append(i)
                pos.append(start)
                entry.append(e)
        took = block.select(keys).take(pa.array(row, pa.int64()))
        ids = [char_to_id(scan.ids[0][e]) for e in range(len(scan.terms))]
        return pa.table([*took.columns, pa.array(pos, pa.int32()), pa.array([scan.terms[e] for e in entry], pa.string()),
                         pa.array([ids[e] for e in entry], pa.int32())], names=[*keys, "pos", "term", "token_id"])

    return _in_blocks(rows, vocab, schema, run).select(*key, "pos", "term", "token_id")


def encoded(texts: DataFrame, vocab: DataFrame, rules, key: Sequence[str], text: str = "text",
            keep: Sequence[str] = ()) -> DataFrame:
    """``(*key, *keep, token_string)``: bolt-on encoding with a vocabulary of
    any size."""
    rows = numbered(texts, key, text, keep)
    rest = [c for c in rows.columns if c not in ("_row", "_t")]
    schema = T.StructType([*(rows.schema[c] for c in rest), T.StructField("_s", T.StringType())])

    def run(scan: Scanner, block: pa.Table) -> pa.Table:
        tokens = [None if t is None else scan.token_string(t) for t in block.column("_t").to_pylist()]
        return pa.table([*block.select(rest).columns, pa.array(tokens, pa.string())], names=[*rest, "_s"])

    marked = _in_blocks(rows, vocab, schema, run)
    if len(rules) > NESTED_REPLACE_LIMIT:
        return with_rules(marked.select(*rest, F.col("_s").alias("token_string")), rules, "token_string")
    return marked.select(*rest, apply_rules("_s", rules).alias("token_string"))
