"""Keep the latest row per key (A7) and the per-file sample cap (L1).

Both are ``row_number`` over a window with a rank limit; Spark plans them
with a partial WindowGroupLimit before the shuffle, so each task ships
at most ``n`` rows per key however many copies a hot key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("file", "rec_offset", "rec_index")) -> DataFrame:
    """One row per ``key``; the one read last (greatest file, offset and
    place in the member, which together are unique) wins, which is deterministic unlike the reference's
    last-write-wins index."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def cap_per_file(df: DataFrame, n: int = 10, file: str = "file",
                 order: tuple[str, ...] = ("rec_offset", "rec_index")) -> DataFrame:
    """L1: at most ``n`` rows per source file, the first ``n`` by place."""
    w = Window.partitionBy(file).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
