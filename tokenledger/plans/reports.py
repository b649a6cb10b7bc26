"""Cost and parity reports built from token counts.

All reports are DataFrame -> DataFrame over frames with one row per key (and
group).  A baseline is the value of the baseline key in the same frame, taken
by a window over the already aggregated rows of the group: no join, no
broadcast, and what was aggregated is computed once.  Where the reference
prints "—" (no gain) the value is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def baseline_of(value: Column | str, key: str = "lang", baseline: str = "en", by: Sequence[str] = ()) -> Column:
    """The baseline key's value, on every row of the group (null if absent)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(F.col(key) == baseline, v)).over(Window.partitionBy(*(by or [F.lit(0)])))


def vs_baseline(counts: DataFrame, value: str, key: str = "lang", baseline: str = "en",
                out: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Add ``value / value[baseline]`` (per ``by`` group); null if the baseline is absent."""
    return counts.withColumn(out or f"{value}_vs_{baseline}",
                             _div(F.col(value), baseline_of(value, key, baseline, by)))


def gap_columns(frame: DataFrame, before: str, after: str, key: str = "lang", baseline: str = "en",
                by: Sequence[str] = ()) -> DataFrame:
    """Gaps to the baseline of two value columns of one frame, and the reduction.

    ``gap = value[key] / value[baseline]``, each with its own baseline;
    ``reduction_pct = (1 - gap_after / gap_before) * 100`` (may be negative).
    """
    g = (frame.withColumn("gap_before", _div(F.col(before), baseline_of(before, key, baseline, by)))
         .withColumn("gap_after", _div(F.col(after), baseline_of(after, key, baseline, by))))
    return g.withColumn("reduction_pct",
                        (F.lit(1.0) - _div(F.col("gap_after"), F.col("gap_before"))) * F.lit(100.0))


def gap_reduction(before: DataFrame, after: DataFrame, value: str, key: str = "lang",
                  baseline: str = "en") -> DataFrame:
    """``gap_columns`` of the same value in two frames, without the baseline row."""
    both = before.select(key, F.col(value).alias("value_before")).join(
        after.select(key, F.col(value).alias("value_after")), key)
    return gap_columns(both, "value_before", "value_after", key, baseline).where(F.col(key) != baseline).select(
        key, "value_before", "gap_before", "value_after", "gap_after", "reduction_pct")


def reduction_columns(frame: DataFrame, density_before: str = "before", density_after: str = "after",
                      key: str = "lang", baseline: str = "en") -> DataFrame:
    """Before/after a vocabulary change, per key, from ``before`` and ``after``.

    ``reduction = before - after``; ``reduction_pct`` only when positive.
    Multipliers always divide by the baseline's *before* value (of the
    densities if given, e.g. tokens per byte for non-parallel text).
    """
    base = baseline_of(density_before, key, baseline)
    red = F.col("before") - F.col("after")
    return frame.select(
        key, "before", "after", red.alias("reduction"),
        F.when(red > 0, _div(red, F.col("before")) * F.lit(100.0)).alias("reduction_pct"),
        _div(F.col(density_before), base).alias("mult_before"),
        _div(F.col(density_after), base).alias("mult_after"))


def bolt_reduction(before: DataFrame, after: DataFrame, value: str, density: str | None = None,
                   key: str = "lang", baseline: str = "en") -> DataFrame:
    """``reduction_columns`` of the same value in two frames."""
    d = density or value
    both = before.select(key, F.col(value).alias("before"), F.col(d).alias("_db")).join(
        after.select(key, F.col(value).alias("after"), F.col(d).alias("_da")), key)
    return reduction_columns(both, "_db", "_da", key, baseline)


def token_cost(before_after: DataFrame, price_per_token: float, volume: int,
               before: str = "before", after: str = "after") -> DataFrame:
    """``tokens x volume x price`` before and after; ``saved`` null unless
    positive.  Products are doubles, so no corpus size overflows."""
    vol, price = F.lit(float(volume)), F.lit(float(price_per_token))
    cb = F.col(before).cast("double") * vol * price
    ca = F.col(after).cast("double") * vol * price
    return (before_after.withColumn("cost_before", cb).withColumn("cost_after", ca)
            .withColumn("saved", F.when(F.col("cost_before") - F.col("cost_after") > 0,
                                        F.col("cost_before") - F.col("cost_after"))))
