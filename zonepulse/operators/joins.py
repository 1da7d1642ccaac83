"""Join helpers.  Sizes are left to Spark: its byte threshold and adaptive execution choose
between a broadcast and a shuffle join, at build time nothing is counted."""

from __future__ import annotations

from pyspark.sql import DataFrame


def restrict_to(facts: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the fact rows whose ``keys`` occur in ``dim`` (a left-semi join).

    No column is added, so aggregation can run on the facts' own keys, and attributes are
    attached to the (small) result.
    """
    return facts.join(dim.select(*keys), keys, "left_semi")


def attach(agg: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Inner-join an aggregate to dimension attributes on ``keys``."""
    return agg.join(dim, keys, "inner")
