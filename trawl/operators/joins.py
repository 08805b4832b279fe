"""Lookup joins against side tables.

Plain equi-joins: Spark broadcasts a side whose size in bytes is known to be
under its own limit (statically, or by AQE once it is computed), and otherwise
shuffles, where AQE splits a domain that holds a large share of the captures.
Nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def allow_list(captures: DataFrame, domains: DataFrame, key: str = "domain") -> DataFrame:
    """Keep captures whose domain is in the list (exact string match)."""
    side = domains.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    return captures.join(side, on=key, how="left_semi")


def with_hints(captures: DataFrame, hints: DataFrame, key: str = "domain") -> DataFrame:
    """Attach the domain's date hint; no hint -> NULL. Of several hints of a
    domain the greatest is taken, so no capture is doubled."""
    one = hints.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("hint").alias("hint"))
    return captures.join(one, on=key, how="left")
