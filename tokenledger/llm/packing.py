"""Best-fit packing planned over the histogram of piece lengths.

1. Texts become token pieces in one Arrow pass (only documents longer than a
   sequence are cut); the pieces are written once.
2. The plan is made from the histogram of lengths alone (at most ``capacity``
   numbers): best-fit decreasing, for whole ranges of equal pieces at a time.
   Bins with the same room form ranges of sequence numbers, so the plan is a
   short list of ``(length, ranks, sequences, offset)`` whatever the number of
   documents.
3. Every piece takes the slot planned for its rank among the pieces of its
   length.  A writing task numbers its own pieces of each length as it cuts
   them, and the counts of (length, task) shift these numbers: no piece is
   sorted or grouped, whatever share of all pieces one length holds.  Slots are
   joined on the length and a bucket of ranks, so a piece meets a few ranges of
   its length only.  Both small tables are broadcast up to ``BROADCAST_ROWS``
   counted rows and joined by shuffle beyond.

Defined cases: a null or empty text is the piece of the end token alone; equal
rows (repeated doc_id and text) take one slot each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenledger.llm.common import giving_back, spread_rows, written

CAPACITY = 2048
END_ID = 0
#: Rows of a few numbers that a broadcast table may have.
BROADCAST_ROWS = 200_000
#: Texts of these characters only take the fast encoder with the same
#: vocabulary; special-token strings and other scripts go to the tokenizer itself.
_COMMON = re.compile(r"[\t\n\r -~¡-ɏ‐-‧‰-⁞]*\Z")
_SPECIAL = "<|endoftext|>"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of the byte-level BPE tokenizer file at ``path``."""

    def __init__(self, path: str):
        import json

        import tiktoken

        self.path, self._exact = path, None
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        # byte-level BPE: each vocabulary character stands for one byte
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in visible}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t != _SPECIAL}
        import public_tokenizers

        self.fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def exact(self):
        """The tokenizer itself, loaded by workers that meet a text for it."""
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.path)
        return self._exact

    def __call__(self, text: str) -> list[int]:
        if _COMMON.match(text) and _SPECIAL not in text:
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids, ids_crc32, task, own)``: the token
    ids of each text, ended by ``END_ID``, cut from the back into full
    sequences.  ``own`` numbers the pieces of a length within the ``task`` that
    cut them, from 0: it holds in the written table, not between two runs."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        encode, task = encoder(path), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out: list[tuple] = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        raw = ids[x:y].tobytes()
                        out.append((doc, k, x, y - x, ids[x:y].astype(np.int32), zlib.crc32(raw), int(met[y - x])))
                        met[y - x] += 1
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.list_(pa.int32())), pa.array(cols[5], pa.int64()),
                    pa.array([task] * len(out), pa.int32()), pa.array(cols[6], pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "task", "own"])

    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return src.mapInArrow(giving_back(run), "doc_id bigint, piece int, start bigint, length bigint, ids array<int>, "
                                            "ids_crc32 bigint, task int, own bigint")


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows ``(length, rank_from, rank_to,
    sequence_from, offset)``; ranks of a row take consecutive sequences."""
    room: dict[int, deque] = {}  # room left -> ranges [sequence_from, count] of such bins
    open_rooms: list[int] = []
    plan, bins = [], 0

    def put(left: int, first: int, count: int) -> None:
        if left <= 0:
            return
        q = room.setdefault(left, deque())
        if not q:
            insort(open_rooms, left)
        if q and q[-1][0] + q[-1][1] == first:
            q[-1][1] += count
        else:
            q.append([first, count])

    for length in sorted(histogram, reverse=True):
        n, rank = histogram[length], 0
        while n:
            at = bisect_left(open_rooms, length)
            if at == len(open_rooms):
                fresh = -(-n // (capacity // length))
                put(capacity, bins, fresh)
                bins += fresh
                continue
            left = open_rooms[at]
            q = room[left]
            first, count = q.popleft()
            take = min(n, count)
            if take < count:
                q.appendleft([first + take, count - take])
            elif not q:
                open_rooms.pop(at)
            plan.append((length, rank, rank + take, first, capacity - left))
            put(left - length, first, take)
            rank, n = rank + take, n - take
    return plan


def bucketed(plan: list[tuple[int, int, int, int, int]], histogram: dict[int, int]) -> tuple[list[tuple], dict[int, int]]:
    """The plan's ranges once for every bucket of ranks they touch, and the
    width of a length's buckets: as many buckets as the length has ranges, so at
    most about three times the rows of the plan."""
    ranges = Counter(r[0] for r in plan)
    width = {length: max(1, -(-histogram[length] // n)) for length, n in ranges.items()}
    return [(length, k, lo, hi, first, offset) for length, lo, hi, first, offset in plan
            for k in range(lo // width[length], (hi - 1) // width[length] + 1)], width


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``token_pieces`` with ``sequence_id`` and ``offset`` of each piece."""
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, capacity, vocabulary), "pieces")
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, width = bucketed(plan_slots(histogram, capacity), histogram)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    if counts.count() <= BROADCAST_ROWS:
        shift = F.broadcast(shift)
    # at most `capacity` numbers
    widths = F.lit([width.get(x, 1) for x in range(capacity + 1)])
    ranked = pieces.join(shift, ["length", "task"]).withColumn("rank", F.col("own") + F.col("shift")).withColumn(
        "bucket", F.floor(F.col("rank") / F.element_at(widths, F.col("length").cast("int") + 1)).cast("bigint"))
    # as an Arrow table the plan needs no Python workers of its own
    names = ["length", "bucket", "lo", "hi", "first", "offset"]
    cols = np.array(plan or [(0, 0, 0, 0, 0, 0)], dtype=np.int64).T
    slots = spark.createDataFrame(pa.table([pa.array(c) for c in cols], names))
    if len(plan) <= BROADCAST_ROWS:
        slots = F.broadcast(slots)
    return ranked.join(slots, ["length", "bucket"]).where("rank >= lo and rank < hi").select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")
