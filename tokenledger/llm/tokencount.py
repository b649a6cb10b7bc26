"""Unigram token counts by a count-only Viterbi over Aho-Corasick matches.

The pieces and scores of a public SentencePiece file are read as a unigram
vocabulary.  An Aho-Corasick automaton enumerates every piece that ends at a
character; dynamic programming carries only the best score and the number of
pieces so far, never the pieces themselves.  Rules, as in the public
``tokenizers`` unigram model: spaces become U+2581, one is put in front of a
text that does not start with one; of equal scores the longest last piece wins; a character that is no piece costs
the lowest score less 10 and counts as its UTF-8 bytes (byte fallback).
Scores are sums in double precision.

Texts are cut where no piece of the vocabulary could cross: before a run of
U+2581 when no piece holds one after another character (else a text stays
whole), and next to a character that stands in no longer piece.  Counts of
the parts are kept in a table of at most ``CACHE`` entries per worker.

Defined cases: null and empty texts have 0 tokens and score 0; the count does
not depend on batches, tasks or the table's size; repeated rows each get
theirs; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.common import spread_rows

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 1 << 18


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> list[tuple[str, float]]:
    """``(piece, score)`` by id from a SentencePiece file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), float(sp.get_score(i))) for i in range(sp.get_piece_size())]


class Counter:
    """Token counts under a unigram vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.trie = ahocorasick.Automaton()
        for piece, score in reversed(pieces):  # the first of equal pieces stays
            if piece:
                self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        longer = [p for p, _ in pieces if len(p) > 1]
        joined = "".join(sorted({c for p in longer for c in p}))
        loose = f"[^{re.escape(joined)}]" if joined else "(?s:.)"
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            self.parts = re.compile(f"{loose}|[{re.escape(joined)}]+" if joined else loose)
        else:
            self.parts = re.compile(f"{loose}|{SPACE}+[{re.escape(joined.replace(SPACE, ''))}]*|[{re.escape(joined.replace(SPACE, ''))}]+")
        self.known: dict[str, tuple[float, int]] = {}

    def viterbi(self, s: str) -> tuple[float, int]:
        """Best score and its number of tokens."""
        n = len(s)
        best = [float("-inf")] * (n + 1)
        count = [0] * (n + 1)
        best[0], done = 0.0, 0

        def close(upto: int) -> None:
            nonlocal done
            while done < upto:
                c = s[done]
                done += 1
                if c not in self.single and best[done - 1] + self.unknown > best[done]:
                    best[done] = best[done - 1] + self.unknown
                    count[done] = count[done - 1] + len(c.encode())

        longest = 0
        end = -1
        for at, (size, score) in self.trie.iter(s):
            if at != end:
                close(at)
                end, longest = at, 0
            value = best[at + 1 - size] + score
            if value > best[at + 1] or value == best[at + 1] and size > longest:
                best[at + 1], count[at + 1], longest = value, count[at + 1 - size] + 1, size
        close(n)
        return best[n], count[n]

    def __call__(self, text: str | None) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        score, tokens, known = 0.0, 0, self.known
        text = text.replace(" ", SPACE)
        for part in self.parts.findall(text if text[0] == SPACE else SPACE + text):
            got = known.get(part)
            if got is None:
                got = self.viterbi(part)
                if len(part) <= 64:
                    if len(known) >= CACHE:
                        known.clear()
                    known[part] = got
            score += got[0]
            tokens += got[1]
        return score, tokens


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One automaton per worker process and file."""
    return Counter(read_pieces(path))


def count_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, score)`` of every row: a narrow pass, no shuffle."""
    path = model or default_model()

    def run(batches):
        count = counter(path)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                got = [count(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([n for _, n in got], pa.int64()), pa.array([s for s, _ in got], pa.float64())],
                    ["doc_id", "n_tokens", "score"])

    src = spread_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return src.mapInArrow(run, "doc_id bigint, n_tokens bigint, score double")
