"""What changed between full snapshots (problem 7).

The snapshots present are numbered densely; each key's rows are windowed by
that index. A lagged hash that differs is a change, a gap in the index is a
removal and, after it, an addition. All snapshots are compared in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import instant

MAX_SNAPSHOTS = 100_000


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """(snapshot_no, file_id, change) for each pair of consecutive snapshots.

    The latest modified_time of a file in a snapshot holds, then the greatest
    full_path; an unreadable time is the oldest. The instants of modified_time
    and the strings full_path are compared, nulls being equal to nulls only.
    Rows without file_id or snapshot_no are left out. One snapshot, or none,
    has no changes.
    """
    rows = snapshots.where(F.col("file_id").isNotNull() & F.col("snapshot_no").isNotNull()).select("snapshot_no", "file_id", instant("modified_time").alias("at"), "full_path")
    state = rows.groupBy("file_id", "snapshot_no").agg(F.max(F.struct("at", "full_path")).alias("s"))
    nos = rows.select("snapshot_no").distinct()
    # one row a snapshot, numbered in one small task
    order = Window.orderBy("snapshot_no")
    index = nos.select("snapshot_no", F.row_number().over(order).alias("idx"), F.lead("snapshot_no").over(order).alias("next_no"))
    # a snapshot is a whole copy of the drive, so there are few; checked, and joined by shuffle past that
    index = F.broadcast(index) if nos.limit(MAX_SNAPSHOTS + 1).count() <= MAX_SNAPSHOTS else index
    state = state.join(index, "snapshot_no").select("file_id", "snapshot_no", "idx", "next_no", F.xxhash64(F.unix_micros("s.at"), "s.full_path").alias("h1"), F.hash("s.full_path", F.unix_micros("s.at")).alias("h2"), F.col("s.at").isNull().alias("n1"), F.col("s.full_path").isNull().alias("n2"))
    w = Window.partitionBy("file_id").orderBy("idx")
    lag = lambda c: F.lag(c).over(w)
    seen = state.select(
        "file_id", "snapshot_no", "idx", "next_no", lag("idx").alias("was"), F.lead("idx").over(w).alias("will"),
        ((F.col("h1") != lag("h1")) | (F.col("h2") != lag("h2")) | (F.col("n1") != lag("n1")) | (F.col("n2") != lag("n2"))).alias("differs"),
    )
    kinds = F.array_compact(
        F.array(
            F.when(F.when(F.col("was").isNull(), F.col("idx") > 1).otherwise(F.col("was") < F.col("idx") - 1), F.struct("snapshot_no", F.lit("added").alias("change"))),
            F.when((F.col("was") == F.col("idx") - 1) & F.col("differs"), F.struct("snapshot_no", F.lit("changed").alias("change"))),
            F.when(F.col("next_no").isNotNull() & F.coalesce(F.col("will") > F.col("idx") + 1, F.lit(True)), F.struct(F.col("next_no").alias("snapshot_no"), F.lit("removed").alias("change"))),
        )
    )
    return seen.select("file_id", F.explode(kinds).alias("c")).select("c.snapshot_no", "file_id", "c.change")
