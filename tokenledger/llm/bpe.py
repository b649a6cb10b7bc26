"""BPE encoding and decoding by a pair occurrence index.

Texts are cut into words as the tokenizer file says; the distinct words of a
chunk of a partition lie side by side in one array of symbols, linked to their
neighbours.  An index maps the merge rank of every adjacent pair to all its
positions in the chunk.  Active ranks are applied in ascending order, each to
all its positions at once; a merge adds the pairs that it creates to the lists
of their ranks, and positions that changed meanwhile are passed over when their
list is reached.  Words are independent, so ascending order over the chunk is
ascending order within every word: the same ids as encoding word by word.

A word's ids are kept as packed bytes and joined per text.  Words of earlier
chunks are remembered up to ``REMEMBERED`` (memory only, results do not depend
on it).  The job is one narrow ``mapInArrow``: no shuffle, and a lost task is
run again from its split.

Defined cases: a null or empty text has no ids and decodes to the empty text;
strings of added tokens in a text become those tokens; rows that repeat an id
each give a row; ids without a token are left out when decoding, null ids
decode to the empty text; an empty table gives no rows; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import spread_rows

#: Characters of text whose distinct words share one index.
CHUNK_CHARS = 1 << 19
#: Words whose ids a worker remembers between chunks.
REMEMBERED = 400_000

#: Letters, digits, spaces and signs on whose kinds the tokenizer's pre-tokenizer and ``regex``
#: agree (tested for every one); texts with others are cut by the tokenizer's own pre-tokenizer.
_AGREED = regex.compile(r"[\t\n\r -~¡-ɏΑ-ΡΣ-ϿЀ-ҁҊ-ԯ‐-‧‰-⁞"
                        r"、-〃ぁ-ゖァ-ヺ一-鿌가-힣！-～\U0001F600-\U0001F64F]*+\Z")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible ones for themselves, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairIndex:
    """Merges of a byte-level BPE file, applied to many words at a time."""

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if model.get("type", "BPE") != "BPE" or odd or model.get("ignore_merges") or spec.get("normalizer") or (
                pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) != ("ByteLevel", False, True):
            raise ValueError(f"{path}: only plain byte-level BPE files are supported")
        added = spec.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens with options are not supported")
        vocab, chars = model["vocab"], byte_characters()
        self.added = {t["content"]: int(t["id"]) for t in added}
        self._split_added = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.byte_ids = np.array([vocab[chars[b]] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: (left, right, merged) by rank; ranks of pairs by left and by right symbol
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.after: dict[int, dict[int, int]] = {}
        self.before: dict[int, dict[int, int]] = {}
        for r, (a, b, _) in enumerate(self.merges):
            if self.after.setdefault(a, {}).setdefault(b, r) == r:
                self.before.setdefault(b, {})[a] = r
        self.byte_rank = np.array([[self.after.get(a, {}).get(b, -1) for b in self.byte_ids.tolist()] for a in self.byte_ids.tolist()])
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.own = Tokenizer.from_file(path).pre_tokenizer
        back = {c: b for b, c in chars.items()}

        def spelled(token: str) -> bytes:
            return bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()

        self.spelling = {i: spelled(t) for t, i in (vocab | self.added).items()}
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        if _AGREED.match(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of each word, packed."""
        raw = [w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
        n = len(data)
        starts = ends - [len(w) for w in raw]
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[starts] = -1
        at = np.flatnonzero(after >= 0)
        ranks = self.byte_rank[data[at], data[at + 1]]
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        active, cut = np.unique(ranks, return_index=True)
        index = {int(r): p.tolist() for r, p in zip(active, np.split(at, cut[1:]))} if len(at) else {}
        symbol, nxt, prv = self.byte_ids[data].tolist(), after.tolist(), before.tolist()
        heap, none = list(index), {}
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            a, b, new = self.merges[r]
            follows, leads = self.after.get(new, none).get, self.before.get(new, none).get
            spots = index.pop(r)
            if a == b:  # overlapping occurrences: from the left
                spots.sort()
            for p in spots:
                q = nxt[p]
                if symbol[p] != a or q < 0 or symbol[q] != b:
                    continue
                symbol[p], symbol[q] = new, -1
                nxt[p] = k = nxt[q]
                if k >= 0:
                    prv[k] = p
                    s = follows(symbol[k])
                    if s is not None:
                        if s in index:
                            index[s].append(p)
                        else:
                            index[s] = [p]
                            heapq.heappush(heap, s)
                k = prv[p]
                if k >= 0:
                    s = leads(symbol[k])
                    if s is not None:
                        if s in index:
                            index[s].append(k)
                        else:
                            index[s] = [k]
                            heapq.heappush(heap, s)
        out = np.array(symbol, dtype=np.int64)
        live = out >= 0
        packed = out[live].astype("<u4").tobytes()
        upto = np.concatenate([[0], np.cumsum(live)])[np.concatenate([[0], ends])] * 4
        return [packed[x:y] for x, y in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut: list[list[str]] = []
        for text in texts:
            parts = self._split_added.split(text) if self._split_added else [text]
            if len(parts) == 1:
                cut.append(self.words(text))
            else:  # odd places hold added tokens
                cut.append([w for i, p in enumerate(parts) for w in ([p] if i % 2 else self.words(p) if p else [])])
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        if not known:
            known.update((t, np.uint32(i).astype("<u4").tobytes()) for t, i in self.added.items())
        fresh = list(set().union(*cut).difference(known))
        if fresh:
            known.update(zip(fresh, self.merged(fresh)))
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    def decode(self, ids: Iterable[int]) -> str:
        spell = self.spelling
        return b"".join([spell.get(i, b"") for i in ids]).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def pair_index(path: str) -> PairIndex:
    """One index of merges per worker process and file."""
    return PairIndex(path)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """``(first row, texts)``: at most ``CHUNK_CHARS`` or one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and size + n > CHUNK_CHARS:
            yield at, [x or "" for x in texts[at:i]]
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, [x or "" for x in texts[at:]]


def _source(docs: DataFrame) -> DataFrame:
    return spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every whole text."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = pair_index(path)
        for b in batches:
            for at, texts in _chunks(b.column(1).to_pylist()):
                ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in coder.encode(texts)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)).cast(pa.int64()),
                                                  pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _source(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``, special tokens included."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = pair_index(path)
        for b in batches:
            texts = [coder.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    src = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return spread_rows(src).mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every whole text
    encoded and its ids decoded again, in one pass."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = pair_index(path)
        for b in batches:
            for at, texts in _chunks(b.column(1).to_pylist()):
                packed = coder.encode(texts)
                back = (coder.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in packed)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, len(texts)).cast(pa.int64()),
                    pa.array([len(x) // 4 for x in packed], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
