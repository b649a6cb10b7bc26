"""Bolt-on vocabulary matching as native regex expressions.

The bolt-on tokenizer scans the text left to right and, at each position,
takes the longest vocabulary entry that matches there (no word boundaries:
``comme`` matches inside ``commerce``); unmatched bytes fall through to BPE.
A regex engine with leftmost-first alternation does the same scan if the
alternatives at every branching point are tried longest-first.  We compile
the vocabulary into a character trie, so each branch starts with a distinct
character and a terminal node becomes an optional (greedy) continuation:
the engine descends as far as it can and backs off to the last complete
entry.  Entries start at a character boundary, so character-level matching
equals the byte-level scan.

The barrier character stands for a matched entry in token strings that are
only counted; no rule can touch it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenledger.functions.text import _col, utf8_byte_string
from tokenledger.functions.tokens import apply_rules, id_to_char

BARRIER = "\U0010FFFD"
_END = ""


def escape_char(ch: str) -> str:
    """Regex-escape one character for both Java and RE2."""
    if ch.isascii() and not ch.isalnum():
        return f"\\x{{{ord(ch):02X}}}"
    if ch.isascii():
        return ch
    # Non-ASCII is literal in both engines, except the whitespace/format
    # characters a reader could not see; spell those out too.
    return ch if ch.isprintable() else f"\\x{{{ord(ch):X}}}"


def flat_pattern(terms: Iterable[str]) -> str:
    """Plain alternation, longest (in UTF-8 bytes) first.  Used by the oracle."""
    uniq = sorted(set(terms), key=lambda t: (-len(t.encode("utf-8")), t))
    return "|".join("".join(escape_char(c) for c in t) for t in uniq)


# Nodes with more children than this dispatch on character ranges first.
DISPATCH_FANOUT = 8


def _alternation(branches: list[tuple[str, str]]) -> str:
    """Alternation of ``(first char, branch pattern)`` sorted by first char.

    Java's engine tries alternatives one by one, so a flat list costs one
    test per branch at every text position.  Wide nodes are split into a
    balanced tree of range lookaheads: a position costs about
    ``log2(branches)`` range tests plus a handful of branch tests, and only
    the branch whose first character matches can succeed -- the semantics
    (and so the longest match) are unchanged.
    """
    if len(branches) <= DISPATCH_FANOUT:
        pats = [p for _, p in branches]
        return pats[0] if len(pats) == 1 else "(?:" + "|".join(pats) + ")"
    mid = len(branches) // 2
    lo, hi = branches[0][0], branches[mid - 1][0]
    rng = f"[{escape_char(lo)}-{escape_char(hi)}]" if lo != hi else f"[{escape_char(lo)}]"
    left = _alternation(branches[:mid])
    right = _alternation(branches[mid:])
    return f"(?:(?={rng}){left}|(?!{rng}){right})"


def trie_pattern(terms: Iterable[str]) -> str:
    """Prefix-factored alternation with longest-match semantics."""
    root: dict = {}
    for t in set(terms):
        if not t:
            continue
        node = root
        for ch in t:
            node = node.setdefault(ch, {})
        node[_END] = True

    # Children before parents, on an explicit stack: entries may be long.
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node[k] for k in node if k != _END)
    done: dict[int, str] = {}
    for node in reversed(order):
        kids = sorted(k for k in node if k != _END)
        body = _alternation([(k, escape_char(k) + done.pop(id(node[k]))) for k in kids]) if kids else ""
        done[id(node)] = "(?:" + body + ")?" if body and node.get(_END) else body

    pat = done[id(root)]
    if not pat:
        return "(?!)"
    # Every match starts with one of the root characters: test that first
    # (a Latin-1 class is a constant-time bit test in Java's engine).
    firsts = sorted(k for k in root if k != _END)
    if len(firsts) > 1 and (all(ord(c) < 0x100 for c in firsts) or len(firsts) <= 64):
        pat = "(?=[" + "".join(escape_char(c) for c in firsts) + "])" + pat
    return pat


# Entries whose first character is below this are "Latin"; the rest are
# guarded by a coarse class of the Unicode pages their first characters use.
LATIN_LIMIT = 0x0250


def split_by_script(terms: Iterable[str]) -> tuple[list[str], list[str]]:
    latin, other = [], []
    for t in terms:
        if t:
            (latin if ord(t[0]) < LATIN_LIMIT else other).append(t)
    return latin, other


# Pages closer than this are merged into one range of the guard class.
GUARD_GAP_PAGES = 64


def page_class(chars: Iterable[str]) -> str:
    """A character class covering the 256-code-point pages of ``chars``.

    Coarse on purpose: a handful of ranges is cheap to test at every
    position, and a superset is all a guard needs.
    """
    pages = sorted({ord(c) >> 8 for c in chars})
    ranges: list[list[int]] = []
    for pg in pages:
        if ranges and pg - ranges[-1][1] <= GUARD_GAP_PAGES:
            ranges[-1][1] = pg
        else:
            ranges.append([pg, pg])
    body = "".join(f"\\x{{{lo << 8:X}}}-\\x{{{(hi << 8) | 0xFF:X}}}" for lo, hi in ranges)
    return "[" + body + "]"


def vocab_matches(text: Column | str, pattern: str) -> Column:
    """Matched vocabulary entries in text order (``array<string>``)."""
    return F.regexp_extract_all(_col(text), F.lit(pattern), 0)


def vocab_runs(text: Column | str, pattern: str) -> Column:
    """The text between matches: one more element than ``vocab_matches``."""
    return F.split(_col(text), pattern, -1)


# Spark's ``split`` hands the pattern to ``String.split``, which compiles it
# for every row; ``regexp_replace``/``regexp_extract_all`` compile a literal
# pattern once.  The fast path therefore marks every match with the barrier
# character, byte-expands, and turns the barrier's four bytes back into one
# barrier token -- UTF-8 is self-synchronising, so those bytes can only come
# from a barrier.  A text that already contains the barrier character takes
# the exact ``split`` path instead.
BARRIER_BYTES = "".join(chr(b) for b in BARRIER.encode("utf-8"))


def _has_barrier(text: Column) -> Column:
    return F.instr(text, BARRIER) > 0


def _marked_bytes(text: Column, pattern: str) -> Column:
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(BARRIER))
    return F.replace(utf8_byte_string(marked), F.lit(BARRIER_BYTES), F.lit(BARRIER))


def bolt_token_string_counting(text: Column | str, pattern: str, rules) -> Column:
    """Bolt-on encode with every match as the barrier character (for counts)."""
    t = _col(text)
    slow = F.array_join(F.transform(vocab_runs(t, pattern), lambda r: utf8_byte_string(r)), BARRIER)
    return apply_rules(F.when(_has_barrier(t), slow).otherwise(_marked_bytes(t, pattern)), rules)


def bolt_token_count(text: Column | str, pattern: str, rules) -> Column:
    """``len(BoltOnTokenizer.tokenize(text))``."""
    return F.char_length(bolt_token_string_counting(text, pattern, rules))


def vocab_id_map(entries: Sequence[tuple[str, int]]) -> Column:
    """Literal map term -> token character of its id."""
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.map_from_arrays(F.array(*[F.lit(t) for t, _ in entries]),
                             F.array(*[F.lit(id_to_char(i)) for _, i in entries]))


def bolt_token_string(text: Column | str, pattern: str, entries: Sequence[tuple[str, int]],
                      rules) -> Column:
    """Bolt-on encode keeping the ids: each match becomes its own token.

    Vocabulary ids are above every rule id, so they also act as barriers.
    """
    t = _col(text)
    m = vocab_id_map(entries)
    marked = F.regexp_replace(t, F.lit(pattern), F.lit(BARRIER))
    runs = F.when(_has_barrier(t), vocab_runs(t, pattern)).otherwise(F.split(marked, BARRIER, -1))
    runs = F.transform(runs, lambda r: utf8_byte_string(r))
    ids = F.transform(vocab_matches(t, pattern), lambda x: F.element_at(m, x))
    joined = F.array_join(F.zip_with(runs, ids, lambda r, i: F.concat(r, F.coalesce(i, F.lit("")))), "")
    return apply_rules(joined, rules)
