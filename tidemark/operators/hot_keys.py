"""Per-key results when a few keys hold most rows (problem 1).

Every measure is algebraic, so each task folds its rows into one small state
per key in a hash table (spilling to a sort when the table is full) and only
those states are shuffled. A key with a third of all rows costs one state a
task, like any other key. Distinct counts go through (key, value) first, which
spreads a hot key over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_profile(df: DataFrame, key: Column, measures: dict[str, Column], distinct: Column | None = None) -> DataFrame:
    """One row per key: `n_rows`, the given aggregates and, if asked for, `n_distinct`.

    The null key is a key of its own. `measures` may use sum, min, max, count,
    avg and the like. An empty table gives no rows. Extra columns are ignored.
    """
    named = df.withColumn("__key", key)
    if distinct is None:
        return named.groupBy("__key").agg(F.count("*").alias("n_rows"), *(m.alias(n) for n, m in measures.items()))
    return named.groupBy("__key").agg(F.count("*").alias("n_rows"), *(m.alias(n) for n, m in measures.items()), F.count_distinct(distinct).alias("n_distinct"))


def heavy_keys(df: DataFrame, key: Column, share: float) -> DataFrame:
    """Keys (`key_value`, `n_rows`) holding at least `share` of all rows, null keys excluded but counted in the total.

    The comparison is exact for shares given in whole per mille.
    """
    profile = key_profile(df.select(key.alias("__key")), F.col("__key"), {})
    per_mille = round(share * 1000)
    total = df.agg(F.count("*").alias("n")).scalar()
    return (
        profile.where(F.col("__key").isNotNull() & (F.col("n_rows") * 1000 >= total * per_mille)).select(F.col("__key").alias("key_value"), "n_rows")
    )
