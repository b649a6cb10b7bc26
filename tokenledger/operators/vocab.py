"""Bolt-on vocabulary: build the id table, match it, encode with it.

``build_vocab`` follows ``add_vocabulary`` called once per group in order:
entries of at most one UTF-8 byte are skipped, an entry whose bytes are
already present is skipped (the first group/position wins, so the first
label stays), and ids are handed out consecutively from ``first_id``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.functions import vocab as vf
from tokenledger.functions.tokens import encode_token_string, token_count, token_string_ids
from tokenledger.operators import match

# Up to this many entries a vocabulary is compiled into one regex that runs in
# a narrow projection; a larger one is matched by joins (``operators.match``).
# Both give the same matches.
REGEX_ENTRIES = 2_000

# Items ranked by one task while ids are handed out.
_RANK_BLOCK = 1 << 16


def _numbered(v: DataFrame, first_id: int) -> DataFrame:
    """Consecutive ``token_id`` from ``first_id`` in (group_ord, item_ord)
    order: ranks inside blocks of item ordinals, shifted by the counts of the
    blocks before (one row per block)."""
    v = v.withColumn("_block", F.floor(F.col("item_ord") / F.lit(_RANK_BLOCK)))
    own = Window.partitionBy("group_ord", "_block").orderBy("item_ord")
    v = v.withColumn("_rn", F.row_number().over(own))
    sizes = v.groupBy("group_ord", "_block").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("group_ord", "_block")
    offsets = sizes.select("group_ord", "_block", (F.sum("_cnt").over(before) - F.col("_cnt")).alias("_off"))
    return v.join(offsets, ["group_ord", "_block"]).select(
        (F.col("_off") + F.col("_rn") + F.lit(first_id - 1)).cast("int").alias("token_id"), "term",
        F.octet_length("term").alias("n_bytes"), "label", "group_ord", "item_ord")


def _first_wins(vocab_in: DataFrame) -> DataFrame:
    v = vocab_in.where(F.octet_length("term") > 1)
    w = Window.partitionBy("term").orderBy("group_ord", "item_ord")
    return v.withColumn("_k", F.row_number().over(w)).where(F.col("_k") == 1).drop("_k")


def build_vocab(vocab_in: DataFrame, first_id: int) -> DataFrame:
    """``(group_ord, item_ord, term, label)`` -> vocab table.

    Returns ``(token_id, term, n_bytes, label, group_ord, item_ord)``.
    """
    return _numbered(_first_wins(vocab_in), first_id)


def extend_vocab(vocab: DataFrame, vocab_in: DataFrame) -> DataFrame:
    """The rows that adding ``vocab_in`` to an existing table brings: entries
    already present are skipped (anti join on the term), ids go on after the
    largest one.  Union with ``vocab`` for the new table; ``count()`` is the
    number added."""
    top = vocab.agg(F.max("token_id")).first()[0]
    fresh = _first_wins(vocab_in).join(vocab.select("term"), "term", "left_anti")
    return _numbered(fresh, 256 if top is None else top + 1)


def vocab_added(vocab: DataFrame, vocab_in: DataFrame, total: bool = True) -> DataFrame:
    """Entries offered and added per group, with a grand-total row (rollup)."""
    offered = vocab_in.groupBy("group_ord", "label").agg(F.count(F.lit(1)).alias("offered"))
    added = vocab.groupBy("group_ord", "label").agg(F.count(F.lit(1)).alias("added"))
    per = offered.join(added, ["group_ord", "label"], "left").fillna(0, ["added"])
    if not total:
        return per
    return (per.rollup("group_ord", "label")
            .agg(F.sum("offered").alias("offered"), F.sum("added").alias("added"))
            .where(F.col("label").isNotNull() | F.col("group_ord").isNull()))


@dataclass(frozen=True)
class BoltOn:
    """A trained rule list plus a bolt-on vocabulary, ready to encode columns.

    An entry can only match in a text that contains its first character, so
    each row first tests a coarse class of the pages used by the non-Latin
    first characters (one cheap scan); rows without any of them run the much
    smaller Latin-only pattern, or no regex at all.  The result is the same
    as always running the full pattern.
    """

    rules: tuple
    entries: tuple  # (term, token_id) in id order

    @staticmethod
    def from_vocab(vocab: DataFrame, rules) -> "BoltOn":
        """For vocabularies that fit a regex; see ``bolt_on`` for any size."""
        rows = vocab.select("term", "token_id").orderBy("token_id").limit(REGEX_ENTRIES + 1).collect()
        if len(rows) > REGEX_ENTRIES:
            raise ValueError("use bolt_on(): a vocabulary of this size is matched by joins")
        _check_ids(rows[0]["token_id"] if rows else None, rules)
        return BoltOn(tuple(rules), tuple((r["term"], int(r["token_id"])) for r in rows))

    # The same operations as LargeBoltOn, row by row.
    def with_counts(self, df: DataFrame, key: Sequence[str], text: str = "text", out: str = "bolt_tokens") -> DataFrame:
        return df.withColumn(out, self.token_count(text))

    def with_token_string(self, df: DataFrame, key: Sequence[str], text: str = "text", out: str = "token_string") -> DataFrame:
        return df.withColumn(out, self.token_string(text))

    def matched(self, df: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
        """``(*key, term)``, one row per match."""
        return df.select(*key, F.explode(self.matches(text)).alias("term"))

    @cached_property
    def pattern(self) -> str:
        return vf.trie_pattern(t for t, _ in self.entries)

    @cached_property
    def _split(self) -> tuple[str | None, str | None]:
        latin, other = vf.split_by_script(t for t, _ in self.entries)
        latin_pat = vf.trie_pattern(latin) if latin else None
        guard = vf.page_class(t[0] for t in other) if other else None
        return latin_pat, guard

    def _guarded(self, text: Column | str, with_pattern, without_vocab: Column) -> Column:
        t = F.col(text) if isinstance(text, str) else text
        latin_pat, guard = self._split
        if guard is None:
            return with_pattern(self.pattern) if latin_pat else without_vocab
        cheap = with_pattern(latin_pat) if latin_pat else without_vocab
        return F.when(t.rlike(guard), with_pattern(self.pattern)).otherwise(cheap)

    def matches(self, text: Column | str) -> Column:
        t = F.col(text) if isinstance(text, str) else text
        none = F.when(t.isNotNull(), F.array().cast("array<string>"))
        return self._guarded(t, lambda p: vf.vocab_matches(t, p), none)

    @property
    def latin_pattern(self) -> str | None:
        """The pattern used on rows without any non-Latin first character."""
        latin_pat, guard = self._split
        return latin_pat if guard is not None else (self.pattern if latin_pat else None)

    def token_count(self, text: Column | str, base_count: Column | None = None,
                    latin_count: Column | None = None) -> Column:
        """Bolt-on token count.

        ``base_count`` may name an already computed plain count of the same
        text (used where no entry can match), ``latin_count`` an already
        computed count with ``latin_pattern`` (tokenizers with the same Latin
        entries share it).
        """
        plain = base_count if base_count is not None else token_count(text, self.rules)
        latin_pat, guard = self._split

        def with_pattern(p: str) -> Column:
            if latin_count is not None and p == self.latin_pattern:
                return latin_count
            return vf.bolt_token_count(text, p, self.rules)

        return self._guarded(text, with_pattern, plain)

    def token_string(self, text: Column | str) -> Column:
        return self._guarded(text, lambda p: vf.bolt_token_string(text, p, self.entries, self.rules),
                             encode_token_string(text, self.rules))

    def ids(self, text: Column | str) -> Column:
        return token_string_ids(self.token_string(text))


@dataclass(frozen=True)
class LargeBoltOn:
    """A rule list plus a vocabulary table of any size, matched by joins.

    The vocabulary stays a DataFrame; nothing of it reaches the driver but the
    distinct term lengths.  ``key`` names columns that identify a text.
    """

    rules: tuple
    vocab: DataFrame

    def with_token_string(self, df: DataFrame, key: Sequence[str], text: str = "text", out: str = "token_string") -> DataFrame:
        keep = [c for c in df.columns if c not in key]
        return match.encoded(df, self.vocab, self.rules, key, text, keep).withColumnRenamed("token_string", out)

    def with_counts(self, df: DataFrame, key: Sequence[str], text: str = "text", out: str = "bolt_tokens") -> DataFrame:
        return self.with_token_string(df, key, text, "_ts").withColumn(out, F.char_length("_ts")).drop("_ts")

    def matched(self, df: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
        """``(*key, term)``, one row per match."""
        return match.longest_matches(df, self.vocab, key, text).select(*key, "term")


def _check_ids(lowest: int | None, rules) -> None:
    if lowest is not None and lowest <= max((r.new_id for r in rules), default=255):
        raise ValueError("bolt-on ids must start above every rule id")


def bolt_on(vocab: DataFrame, rules, regex_entries: int = REGEX_ENTRIES) -> "BoltOn | LargeBoltOn":
    """A tokenizer extended by a vocabulary table: by regex up to
    ``regex_entries``, by joins beyond; the results are the same."""
    if vocab.count() <= min(regex_entries, REGEX_ENTRIES):
        return BoltOn.from_vocab(vocab, rules)
    _check_ids(vocab.agg(F.min("token_id")).first()[0], rules)
    return LargeBoltOn(tuple(rules), vocab)
