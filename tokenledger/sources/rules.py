"""Merge-rule sources and sinks.

``reference_rules(mix)`` returns the rules our trainer learns from the
reference corpus mixes (80 merges each).  They are stored as a small data
file made by ``train_bpe`` so that encode and cost jobs do not retrain on
every call; ``tests/test_goldens.py`` retrains and checks the file.
"""

from __future__ import annotations

import json
from functools import lru_cache
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.operators.train import RULES_SCHEMA, Rule, rules_df


@lru_cache(maxsize=None)
def _baked() -> dict[str, tuple[Rule, ...]]:
    raw = json.loads(resources.files("tokenledger.sources").joinpath(
        "data/reference_rules.json").read_text(encoding="utf-8"))
    return {k: tuple(Rule(*map(int, r)) for r in v) for k, v in raw.items()}


def reference_rules(mix: str = "heavy") -> list[Rule]:
    return list(_baked()[mix])


def write_rules(rules_frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist a rules table (one small file; rules are bounded by ``num_merges``)."""
    rules_frame.coalesce(1).write.mode(mode).parquet(path)


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Load a rules table in rank order.  A rule list is bounded by the token
    ids a character can stand for (about 1.1 million)."""
    df = spark.read.schema(RULES_SCHEMA).parquet(path)
    return [Rule(r["rank"], r["left"], r["right"], r["new_id"], r["n"])
            for r in df.orderBy(F.asc("rank")).collect()]


def reference_rules_df(spark: SparkSession, mix: str = "heavy") -> DataFrame:
    return rules_df(spark, reference_rules(mix))
