"""Filling containers of fixed capacity with whole texts (problem 9).

Each partition is packed by best-fit decreasing. Dual feasible functions give a
lower bound of the containers it needs; a partition that meets its bound is
certified and left alone. Partitions with a gap give the texts of their
containers that are not full to a pool, which is dealt out again and packed by
best-fit decreasing, as long as that saves containers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release, ship

CAPACITY, PER_PARTITION, ROUNDS = 2048, 20_000, 3


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The largest bound of three families of dual feasible functions: identity, thresholds, rounding."""
    return lower_bound_of_counts(np.bincount(sizes, minlength=capacity + 1), capacity)


def lower_bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """The same from the number of items of each size from 0 to the capacity; empty items need no room."""
    count = count.astype(np.int64).copy()
    count[0] = 0
    if not count.any():
        return 0
    w = np.arange(capacity + 1)
    best = -(-int((count * w).sum()) // capacity)
    # thresholds a: what leaves less than a counts as full, what is smaller than a as nothing
    n_up, s_up = count[::-1].cumsum()[::-1], (count * w)[::-1].cumsum()[::-1]  # number and sum of sizes >= w
    a = np.arange(1, capacity // 2 + 1)
    above = np.where(capacity - a + 1 <= capacity, n_up[np.minimum(capacity - a + 1, capacity)], 0)
    middle = s_up[a] - s_up[np.minimum(capacity - a + 1, capacity)]
    best = max(best, int((above + -(-middle // capacity)).max()))
    for k in range(1, 33):
        scaled = (k + 1) * w
        u = np.where(scaled % capacity == 0, w * k, (scaled // capacity) * capacity)  # in units of capacity * k
        best = max(best, -(-int((count * u).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(container of each item, fill of each container). Sizes are at most the capacity; empty items open no second container."""
    order = np.argsort(-sizes, kind="stable")
    at, rooms, fills, free = np.empty(len(sizes), np.int64), [[] for _ in range(capacity + 1)], [], 0  # free: bit r is set if a container has r left
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            j = rooms[left].pop()
            if not rooms[left]:
                free ^= 1 << left
            fills[j] += size
        else:
            j, left = len(fills), capacity
            fills.append(size)
        left -= size
        rooms[left].append(j)
        free |= 1 << left
        at[i] = j
    return at, np.array(fills, np.int64)


def _pack(capacity: int, label: str):
    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["item", "part"], kind="stable", ignore_index=True)
        sizes = items["size"].to_numpy(np.int64)
        at, fills = best_fit_decreasing(sizes, capacity)
        bound = max(lower_bound(sizes, capacity), 1)
        return pd.DataFrame(
            {
                "item": items["item"], "part": items["part"], "size": items["size"],
                "container": [f"{label}-{key[0]}-{j}" for j in at], "fill": fills[at].astype(np.int32), "gap": np.int32(len(fills) - bound),
            }
        )

    return run


def pack(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, per_partition: int = PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """(key, part, start, n_tokens, container): where each item, or each part of an item above the capacity, lies.

    Every row gets a container, empty and null sizes too (they take no room);
    rows with the same key are separate items of equal key. An item above the
    capacity fills as many containers as it can alone, and its rest is packed.
    Containers never hold more than `capacity`. An empty table gives no rows.
    """
    ship(sizes.sparkSession)
    kind = sizes.schema[key].dataType.simpleString()
    n = F.coalesce(F.greatest(F.col(size), F.lit(0)), F.lit(0)).cast("int")
    # copies of a key are told apart by what they are dealt with, not by their place
    items = materialize(sizes.select(F.col(key).alias("item"), n.alias("n")), "sizes")
    alone = items.where(F.col("n") > capacity).select("item", "n", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / capacity).cast("int") - 1)).alias("part"))
    full = alone.select("item", "part", F.lit(capacity).alias("size"), F.concat_ws("-", F.lit("alone"), F.col("item").cast("string"), "part").alias("container"))
    rest = items.where((F.col("n") <= capacity) | (F.col("n") % capacity != 0)).select(
        "item", F.when(F.col("n") > capacity, F.floor(F.col("n") / capacity)).otherwise(0).cast("int").alias("part"), F.when(F.col("n") > capacity, F.col("n") % capacity).otherwise(F.col("n")).cast("int").alias("size")
    )
    schema = f"item {kind}, part int, size int, container string, fill int, gap int"

    def deal(df: DataFrame, label: str) -> DataFrame:
        groups = max(1, -(-df.count() // per_partition))
        spread = df.select("item", "part", "size", F.pmod(F.xxhash64("item", "part", F.lit(label)), F.lit(groups)).cast("int").alias("g"))
        return materialize(spread.groupBy("g").applyInPandas(_pack(capacity, label), schema), "packed")

    done, now = [], deal(rest, "r0")
    for r in range(1, rounds + 1):
        loose = (F.col("gap") > 0) & (F.col("fill") < capacity)
        before = now.where(loose).agg(F.count_distinct("container")).first()[0]
        if before < 2:
            break
        again = deal(now.where(loose).select("item", "part", "size"), f"r{r}")
        if again.agg(F.count_distinct("container")).first()[0] >= before:
            release(again)
            break
        done.append(now.where(~loose))
        now = again
    out = now
    for d in done:
        out = out.unionByName(d)
    packed = out.select("item", "part", "size", "container").unionByName(full)
    return packed.select(F.col("item").alias(key), "part", (F.col("part") * capacity).alias("start"), F.col("size").alias("n_tokens"), "container")


def containers(packed: DataFrame) -> DataFrame:
    """(container, n_items, n_tokens) of each container."""
    return packed.groupBy("container").agg(F.count("*").alias("n_items"), F.sum("n_tokens").alias("n_tokens"))


def certificates(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(part, n_items, n_tokens, n_containers, bound, gap) of each part that was packed by itself, and of `all`.

    bound is what dual feasible functions say the part's items need at least,
    so gap is the most that any packing of them could save. Items come as
    counts by size, at most capacity + 1 rows a part.
    """
    ship(packed.sparkSession)
    label = F.when(F.startswith("container", F.lit("alone-")), "alone").otherwise(F.regexp_extract("container", r"^(.*)-\d+$", 1))
    rows = packed.select(F.explode(F.array(label, F.lit("all"))).alias("part"), "n_tokens", "container")
    counts = rows.groupBy("part", "n_tokens").agg(F.count("*").alias("n"))

    def bound(key: tuple, sizes: pd.DataFrame) -> pd.DataFrame:
        count = np.bincount(sizes["n_tokens"].to_numpy(np.int64), weights=sizes["n"].to_numpy(np.int64), minlength=capacity + 1).astype(np.int64)
        return pd.DataFrame({"part": [key[0]], "n_items": [int(count.sum())], "n_tokens": [int((count * np.arange(len(count))).sum())], "bound": [max(lower_bound_of_counts(count, capacity), 1)]})

    needs = counts.groupBy("part").applyInPandas(bound, "part string, n_items bigint, n_tokens bigint, bound bigint")
    used = rows.groupBy("part", "container").agg(F.count("*").alias("k")).groupBy("part").agg(F.count("*").alias("n_containers"))
    return needs.join(used, "part").select("part", "n_items", "n_tokens", "n_containers", "bound", (F.col("n_containers") - F.col("bound")).alias("gap"))
