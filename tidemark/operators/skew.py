"""Joins and aggregates that do not pile up on a few keys.

A key is *hot* when it holds at least ``1 / MAX_HOT`` of the counted rows, so
there can never be more than MAX_HOT hot keys, whatever the data: what is
broadcast for them has a proven bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT = 500


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n) by partial and final aggregation; rows whose key is null are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def hot_keys(df: DataFrame, key: str, max_hot: int = MAX_HOT, least: int = 10_000) -> list:
    """Keys holding more than 1/max_hot of all rows and at least `least` rows: at most max_hot of them."""
    counts = key_counts(df, key)
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n")).limit(max_hot).collect()
    if not top:
        return []
    total = counts.agg(F.sum("n")).first()[0]
    return [r[0] for r in top if r["n"] * max_hot > total]


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: list | None = None) -> DataFrame:
    """Join on one key whose values are unique in `right`.

    Left rows of hot keys meet at most MAX_HOT broadcast rows of `right` where
    they lie; all others go through an ordinary shuffled join. Null keys match
    nothing and never shuffle. Empty sides give an empty or unmatched result.
    Columns of `right` that `left` has too get the suffix `_right`.
    """
    assert how in ("left", "inner")
    right = right.withColumnsRenamed({c: f"{c}_right" for c in right.columns if c != key and c in left.columns})
    hot = hot_keys(left, key) if hot is None else hot
    cols = [*left.columns, *(c for c in right.columns if c != key)]
    nulls = None
    if how == "left":
        types = dict(right.dtypes)
        nulls = left.where(F.col(key).isNull()).select(*left.columns, *(F.lit(None).cast(types[c]).alias(c) for c in right.columns if c != key))
    rest = left.where(F.col(key).isNotNull())
    if not hot:
        out = rest.join(right, key, how).select(cols)
    else:
        is_hot = F.col(key).isin(hot)
        small = F.broadcast(right.where(F.col(key).isin(hot)))
        out = rest.where(is_hot).join(small, key, how).select(cols).unionByName(rest.where(~is_hot).join(right.where(~F.col(key).isin(hot)), key, how).select(cols))
    return out if nulls is None else out.unionByName(nulls)
