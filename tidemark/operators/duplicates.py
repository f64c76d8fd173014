"""Exact, version and identifier duplicates, their numbering and canonical members.

A group is reduced by partial aggregates, its canonical member among them, so
a key with a third of all rows is a few partial states, not one task's window. The order of
first appearance is the caller's `order` columns; nothing depends on the
order of files or partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import distinct_matches, strip_version_markers
from ..session import materialize
from .skew import split_join


def eligible(items: DataFrame) -> DataFrame:
    """Files only: no folders, no native sheets, nothing trashed (null means not)."""
    return items.where((F.col("object_kind") == "file") & ~F.coalesce(F.col("trashed"), F.lit(False)))


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def content_key() -> Column:
    """md5 with size, else the content hash; null where neither is known."""
    return F.when(_filled("md5_checksum"), F.concat(F.lit("md5:"), F.col("md5_checksum"), F.lit(":"), F.coalesce(F.col("size").cast("string"), F.lit("")))).when(_filled("content_text_hash"), F.concat(F.lit("hash:"), F.col("content_text_hash")))


def stable_key() -> Column:
    """The content hash first, else md5 with size."""
    return F.when(_filled("content_text_hash"), F.concat(F.lit("hash:"), F.col("content_text_hash"))).when(_filled("md5_checksum"), F.concat(F.lit("md5:"), F.col("md5_checksum"), F.lit(":"), F.coalesce(F.col("size").cast("string"), F.lit(""))))


def version_key() -> Column:
    """Stripped name, extension or type, and the three suggestions."""
    base = strip_version_markers(F.regexp_replace(F.coalesce("name", F.lit("")), r"\.[^.]*$", ""))
    kind = F.when(_filled("extension"), F.col("extension")).otherwise(F.coalesce("mime_type", F.lit("")))
    return F.when(base != "", F.concat_ws(":", base, kind, F.coalesce("department_suggestion", F.lit("")), F.coalesce("document_type_suggestion", F.lit(""))))


def identifier_key() -> Column:
    """Department, type, the numbers of six digits in the name, and years; null without a number."""
    ids = F.array_join(distinct_matches(F.coalesce("name", F.lit("")), r"(?<!\d)\d{6}(?!\d)"), ",")
    years = F.array_join(distinct_matches(F.coalesce("name", F.lit("")), r"(?<!\d)(?:19|20)\d{2}(?!\d)"), ",")
    return F.when(ids != "", F.concat_ws("|", F.coalesce("department_suggestion", F.lit("")), F.coalesce("document_type_suggestion", F.lit("")), ids, years))


def groups(files: DataFrame, key: Column, prefix: str, order: tuple[str, ...] = ("listed_at", "file_id")) -> DataFrame:
    """(key, group_id, n_rows, n_files, total_size, canonical_id) of keys with two or more different ids.

    Groups are numbered in order of first appearance, PREFIX-00001 on. The
    canonical member is the one with the greatest (modified_time, size, lower
    name); ties go to the first. Rows without key belong to no group.
    """
    size = F.coalesce(F.col("size"), F.lit(0))
    rank = F.struct(F.coalesce("modified_time", F.lit("")).alias("at"), size.alias("size"), F.lower(F.coalesce("name", F.lit(""))).alias("name"))
    found = best_members(files.withColumn("__key", key).where(F.col("__key").isNotNull()), rank, order).where(F.col("n_files") >= 2)
    return number(found, "first").select(F.col("__key").alias("key"), F.format_string(prefix + "-%05d", "number").alias("group_id"), "n_rows", "n_files", "total_size", "canonical_id")


def best_members(keyed: DataFrame, rank: Column, order: tuple[str, ...]) -> DataFrame:
    """(__key, canonical_id, first, n_files, n_rows, total_size) of each key: its member of greatest rank, of equal ones the first in `order`.

    Three rounds of partial aggregates, by (key, id), by (key, rank) and by
    key: only the last one brings a key together, as one row for each task.
    """
    size = F.coalesce(F.col("size"), F.lit(0))
    per = keyed.groupBy("__key", "file_id").agg(F.max(rank).alias("rank"), F.min(F.struct(*order)).alias("first"), F.count("*").alias("n"), F.sum(size).alias("size"))
    ranked = per.groupBy("__key", "rank").agg(F.min(F.struct("first", "file_id")).alias("m"), F.count("*").alias("n_files"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    return ranked.groupBy("__key").agg(F.max_by("m.file_id", "rank").alias("canonical_id"), F.min("m.first").alias("first"), F.sum("n_files").alias("n_files"), F.sum("n").alias("n_rows"), F.sum("size").alias("total_size"))


def number(df: DataFrame, order: str, name: str = "number", parts: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 in the order of one column of distinct values, without a single-task sort of all rows.

    Rows are sorted by range into parts, as many as the session shuffles into;
    each part numbers its own, and the parts' counts, one row a part, shift them.
    """
    parts = parts or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = df.repartitionByRange(parts, order).withColumn("__p", F.spark_partition_id())
    spread = materialize(spread, "number")
    sizes = spread.groupBy("__p").agg(F.count("*").alias("n"))
    shift = sizes.withColumn("__shift", F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__shift")
    local = spread.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(order)))
    return local.join(F.broadcast(shift), "__p").withColumn(name, (F.col("__i") + F.col("__shift")).cast("int")).drop("__p", "__i", "__shift")


#: What groups() reads besides the key.
_READ = ("file_id", "modified_time", "size", "name")


def members(files: DataFrame, key: Column, prefix: str, order: tuple[str, ...] = ("listed_at", "file_id")) -> DataFrame:
    """(file_id, group_id, is_canonical) of every member of a group."""
    # the key, which may be dear, is made once
    keyed = materialize(files.select(*dict.fromkeys((*_READ, *order)), key.alias("__k")).where(F.col("__k").isNotNull()), "keyed")
    return _members(keyed, "__k", prefix, order)


def _members(keyed: DataFrame, key: str, prefix: str, order: tuple[str, ...]) -> DataFrame:
    g = groups(keyed, F.col(key), prefix, order).select(F.col("key").alias("__key"), "group_id", "canonical_id")
    # only keys of several ids have groups, and the members of a hot one meet its group where they lie
    m = keyed.select("file_id", F.col(key).alias("__key")).where(F.col("__key").isNotNull())
    return split_join(m, materialize(g, "groups"), "__key", "inner").select("file_id", "group_id", (F.col("file_id") == F.col("canonical_id")).alias("is_canonical")).distinct()


def group_paths(members: DataFrame, files: DataFrame, path: str = "full_path", most: int = 5, order: tuple[str, ...] = ("listed_at", "file_id")) -> DataFrame:
    """(group_id, n_files, paths): each group's first `most` members by `order`, their paths joined by ' | '.

    files has one row a file. The engine keeps no more than `most` rows of a
    group in a task before they meet.
    """
    placed = members.select("group_id", "file_id").join(files.select(*dict.fromkeys(("file_id", *order)), F.coalesce(path, F.lit("")).alias("__path")), "file_id")
    few = placed.withColumn("__k", F.row_number().over(Window.partitionBy("group_id").orderBy(*order))).where(F.col("__k") <= most)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__k", "__path"))), lambda x: x["__path"])
    return members.groupBy("group_id").agg(F.count("*").alias("n_files")).join(few.groupBy("group_id").agg(F.array_join(listed, " | ").alias("paths")), "group_id")


def all_duplicates(files: DataFrame, order: tuple[str, ...] = ("listed_at", "file_id")) -> DataFrame:
    """(file_id, kind, group_id, is_canonical): identifier groups override version groups, exact ones override both.

    Overridden members still count towards the size and numbering of the group they would have had.
    """
    passes = [("exact", content_key(), "EXACT"), ("semantic_candidate", identifier_key(), "SEMANTIC"), ("version_candidate", version_key(), "VERSION")]
    keyed = materialize(files.select(*dict.fromkeys((*_READ, *order)), *(k.alias(f"__{p}") for _, k, p in passes)), "keyed")
    each = [_members(keyed, f"__{p}", p, order).withColumns({"kind": F.lit(name), "rank": F.lit(i)}) for i, (name, _, p) in enumerate(passes)]
    union = reduce(DataFrame.unionByName, each)
    best = union.groupBy("file_id").agg(F.min(F.struct("rank", "kind", "group_id", "is_canonical")).alias("b"))
    return best.select("file_id", "b.kind", "b.group_id", "b.is_canonical")
