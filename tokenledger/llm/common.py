"""Helpers shared by the training-data operators.

Texts reach Python as Arrow buffers: the operators work on one UTF-8 byte
array and row offsets per chunk, so numpy handles many documents at once and
memory is bounded by ``CHUNK_BYTES`` plus the longest single document.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.session import materialize
from tokenledger.sources.tables import spread

#: Bytes of text handled by numpy at a time in one task (memory only: every
#: document is processed whole, a longer one forms a chunk of its own).
CHUNK_BYTES = 512 << 10

#: Rows handled at a time (many short texts have per-row arrays).
CHUNK_ROWS = 4096


def text_chunks(batch: pa.RecordBatch, column: str = "text",
                chunk_bytes: int | None = None, chunk_rows: int | None = None) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Yield ``(rows, bytes, offsets)``: ``bytes[offsets[i]:offsets[i + 1]]``
    is the UTF-8 text of row ``rows.start + i``; null reads as empty."""
    limit = chunk_bytes or CHUNK_BYTES
    arr = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    n = len(arr)
    if not n:
        return
    _, off_buf, data_buf = arr.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(n, a + (chunk_rows or CHUNK_ROWS), max(b, a + 1))
        yield slice(a, b), data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive segments (0 for an empty one)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit values (murmur finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int, cache: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    p = cache.get(base)
    if p is None or len(p) < n:
        size = 1 << max(16, (n - 1).bit_length())
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        p = np.multiply.accumulate(p)
        cache[base] = p
    return p[:n]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, the same wherever the span stands
    (polynomial modulo 2**64 over scrambled bytes, scaled by its start)."""
    n = len(data)
    acc = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _powers(_BASE, n), out=acc[1:])
    h = (acc[ends] - acc[starts]) * _powers(_BASE_INV, n + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes within rows: ``(starts, ends, row_offsets)``,
    where words ``row_offsets[i]:row_offsets[i + 1]`` belong to row ``i``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    m = is_word[data]
    first = m.copy()
    first[1:] &= ~m[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = m[at]
    last = m.copy()
    last[:-1] &= ~m[1:]
    to = offsets[1:][offsets[1:] > 0] - 1
    last[to] = m[to]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


#: Lower-case A-Z, leave every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False

#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text: digits,
#: a-z and every byte of a character from U+0080 up.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k`` (a null id is in fold 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % k, F.lit(0))


#: Python workers are kept between tasks; these settings make them give freed
#: memory back instead of holding their peak.
_WORKER_ENV = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(16 << 20), "MALLOC_TRIM_THRESHOLD_": str(32 << 20),
               "ARROW_DEFAULT_MEMORY_POOL": "system"}

#: Bytes of rows that Spark hands to a Python worker at a time; several copies
#: of a batch live at once on both sides.  A smaller setting of the session stays.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bounded_batches(spark: SparkSession) -> None:
    now = spark.conf.get(_BATCH_SETTING, None)
    if now is None or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def prepare(df: DataFrame) -> None:
    """Session and worker settings: bounded batches, memory given back, and the
    package importable from where the driver found it (on a cluster it is
    installed or sent with --py-files)."""
    _bounded_batches(df.sparkSession)
    for k, v in _WORKER_ENV.items():
        df.sparkSession.sparkContext.environment.setdefault(k, v)
    root = str(Path(__file__).resolve().parents[2])
    env = df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def spread_rows(df: DataFrame) -> DataFrame:
    """``df`` with its rows dealt out if its scan would leave cores idle."""
    prepare(df)
    return spread(df)


def giving_back(run):
    """The Arrow function ``run``, whose worker returns freed memory when a task
    ends: kept workers otherwise hold the peak of every stage before."""
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
        if trim is not None:
            trim(0)

    return wrapped


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    prepare(df)
    return materialize(df, f"llm-{name}")[0]
