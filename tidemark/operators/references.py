"""References to records that do not exist (problem 5).

References may be composite and may have nulls in some key columns. They are
grouped by their null mask; each mask is resolved on its non-null columns only,
under the declared match semantics of SQL:

- simple: a reference with any null is satisfied;
- partial: the non-null columns must agree with some target row;
- full: all columns null is satisfied, some but not all null is an orphan.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .skew import MAX_HOT, split_join


def null_mask(columns: list[str]):
    return F.concat(*(F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns))


def resolve(refs: DataFrame, targets: DataFrame, keys: list[str], status: dict, match: str = "partial") -> DataFrame:
    """`refs` with what is known of the targets they mean, and `found`.

    keys: the reference's columns, named alike in `targets`. status: name ->
    aggregate over the target rows a reference agrees with (null where none
    does). For each null mask the targets are first reduced to one row per
    value of the mask's columns, so that a reference is never multiplied, and
    the references to one target are spread by split_join. A reference of the
    all-null mask is found under every semantics.
    """
    out = None
    masks = list(product((0, 1), repeat=len(keys)))
    for bits in masks:
        on = [k for k, b in zip(keys, bits) if b]
        mine = refs.where(null_mask(keys) == "".join(map(str, bits)))
        satisfied = not on or (match == "simple" and len(on) < len(keys))
        broken = match == "full" and 0 < len(on) < len(keys)
        if satisfied or broken:
            types = dict(targets.agg(*(a.alias(n) for n, a in status.items())).dtypes) if status else {}
            part = mine.select("*", *(F.lit(None).cast(types[n]).alias(n) for n in status), F.lit(satisfied).alias("found"))
        else:
            one = targets.where(" and ".join(f"`{k}` is not null" for k in on)).groupBy(*on).agg(*(a.alias(n) for n, a in status.items()), F.lit(True).alias("__found"))
            if len(on) == 1:
                part = split_join(mine, one, on[0], "left")
            else:
                # several columns are one key by their JSON, so that references to a hot target are spread as well
                packed = F.to_json(F.struct(*on))
                part = split_join(mine.withColumn("__key", packed), one.withColumn("__key", packed).drop(*on), "__key", "left")
            part = part.select(*refs.columns, *status, F.coalesce("__found", F.lit(False)).alias("found"))
        out = part if out is None else out.unionByName(part)
    return out


def orphans(refs: DataFrame, targets: DataFrame, keys: list[str], match: str = "partial") -> DataFrame:
    """The rows of `refs` that mean no row of `targets`, under the given match semantics."""
    return resolve(refs, targets, keys, {}, match).where(~F.col("found")).drop("found")


def current_rows(items: DataFrame, *columns: str) -> DataFrame:
    """One row per file_id: the latest listed_at; ties go to the row not trashed, then to the greatest values in the order of `columns`.

    Also `first_listed`, the earliest listed_at. Rows without file_id are left out.
    """
    trashed = F.coalesce("trashed", F.lit(False))
    r = F.max(F.struct("listed_at", (~trashed).alias("__kept"), *columns)).alias("r")
    return items.where(F.col("file_id").isNotNull()).groupBy("file_id").agg(r, F.min("listed_at").alias("first_listed")).select("file_id", F.col("r.listed_at").alias("listed_at"), (~F.col("r.__kept")).alias("trashed"), *(F.col(f"r.{c}").alias(c) for c in columns), "first_listed")


def drive_references(items: DataFrame, drives: DataFrame, corpus: DataFrame) -> DataFrame:
    """All references of the drive's tables: (table_name, period, row_key, at, drive_key, file_key).

    A parent element that names a drive becomes a reference to the drive, any
    other text one to a file. The key is composite: of its two columns exactly
    one is filled, which gives the masks 01 and 10. Blank references are none.
    Rows whose own time is missing have a null period.
    """
    cur = current_rows(items, "parents")
    parents = cur.where(~F.col("trashed")).select(F.lit("inventory_items").alias("table_name"), F.col("listed_at").alias("at"), F.col("file_id").alias("row_key"), F.explode(F.split("parents", ";")).alias("ref"))
    both = corpus.select(F.lit("corpus_rows").alias("table_name"), F.col("sieved_at").alias("at"), F.col("file_id").alias("row_key"), F.explode(F.array("file_id", "canonical_file_id")).alias("ref"))
    refs = parents.unionByName(both).where(F.trim("ref") != "")
    ids = drives.select(F.col("drive_id").alias("ref")).where(F.col("ref").isNotNull()).distinct().withColumn("__drive", F.lit(True))
    # the roots are a fixed, short list (checked against MAX_HOT); past that they are joined by shuffle
    ids = F.broadcast(ids) if ids.limit(MAX_HOT + 1).count() <= MAX_HOT else ids
    refs = refs.join(ids, "ref", "left")
    return refs.select("table_name", F.date_format("at", "yyyy-MM").alias("period"), "row_key", "at", F.when(F.col("__drive"), F.col("ref")).alias("drive_key"), F.when(F.col("__drive").isNull(), F.col("ref")).alias("file_key"))


def broken_references(items: DataFrame, drives: DataFrame, corpus: DataFrame) -> DataFrame:
    """(table_name, period, row_key, ref_key, reason) of every reference that does not hold.

    reason: `missing` if the target was never listed; else `deleted` if its
    current row is trashed; else `late` if it was first listed after the
    referring row's time. Distinct rows; empty tables give none.
    """
    refs = materialize(drive_references(items, drives, corpus).distinct(), "references")
    files = current_rows(items).select(F.lit(None).cast("string").alias("drive_key"), F.col("file_id").alias("file_key"), F.col("trashed").alias("gone"), "first_listed")
    roots = drives.select(F.col("drive_id").alias("drive_key"), F.lit(None).cast("string").alias("file_key"), F.lit(False).alias("gone"), F.lit(None).cast("timestamp").alias("first_listed"))
    status = {"gone": F.max("gone"), "first_listed": F.min("first_listed")}
    known = resolve(refs, files.unionByName(roots.withColumn("first_listed", F.col("first_listed").cast(files.schema["first_listed"].dataType))), ["drive_key", "file_key"], status)
    reason = F.when(~F.col("found"), "missing").when(F.col("gone"), "deleted").when(F.col("first_listed") > F.col("at"), "late")
    return known.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("table_name", "period", "row_key", F.coalesce("drive_key", "file_key").alias("ref_key"), "reason").distinct()


def orphan_report(broken: DataFrame) -> DataFrame:
    """Broken references per table, month and reason."""
    return broken.groupBy("table_name", "period", "reason").agg(F.count("*").alias("n_refs"), F.count_distinct("ref_key").alias("n_targets"))
