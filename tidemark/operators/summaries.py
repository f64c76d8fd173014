"""Summaries, coverage, folder statistics, samples and rate roll-ups over an inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def summary(items: DataFrame, *dimensions: str) -> DataFrame:
    """(dimension, value, n) of each dimension in one pass by grouping sets; blank values are "(empty)"."""
    cols = [F.coalesce(F.when(F.trim(F.col(d).cast("string")) != "", F.col(d).cast("string")), F.lit("(empty)")).alias(d) for d in dimensions]
    flat = items.select(F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), c.alias("value")) for d, c in zip(dimensions, cols)))).alias("x"))
    return flat.groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def ordered_counts(items: DataFrame, dimension: str, order: tuple[str, ...]) -> DataFrame:
    """(value, n, place): counts by value, the commonest first, ties by first appearance in `order`; blank values are "(empty)".

    `place` numbers the values from 1 without sorting them in one task.
    """
    from .duplicates import number

    value = F.coalesce(F.when(F.trim(F.col(dimension).cast("string")) != "", F.col(dimension).cast("string")), F.lit("(empty)"))
    counts = items.groupBy(value.alias("value")).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    return number(counts.withColumn("__at", F.struct((-F.col("n")).alias("k"), "first")), "__at", "place").select("value", "n", "place")


def cube(items: DataFrame, *dimensions: str) -> DataFrame:
    """Counts over all grouping sets of the dimensions, with the set's number."""
    return items.cube(*dimensions).agg(F.grouping_id().alias("grouping_set"), F.count("*").alias("n"))


def quality(items: DataFrame) -> DataFrame:
    """(metric, value): conditional counts, one pass."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    unknown = lambda c: F.coalesce(F.lower(F.trim(F.col(c))), F.lit("")).isin("", "unknown")
    metrics: dict[str, Column] = {
        "rows": F.lit(True),
        "files": F.col("object_kind") == "file",
        "folders": F.col("object_kind") == "folder",
        "trashed": F.coalesce(F.col("trashed"), F.lit(False)),
        "no_parent": blank("parents"),
        "no_path": blank("full_path"),
        "no_checksum": blank("md5_checksum"),
        "no_size": F.col("size").isNull(),
        "unknown_department": unknown("department_suggestion"),
        "unknown_type": unknown("document_type_suggestion"),
        "unknown_sensitivity": unknown("sensitivity_suggestion"),
        "content_extracted": F.coalesce(F.col("content_extracted"), F.lit(False)),
    }
    one = items.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(m) for m, c in metrics.items()))
    return one.unpivot([], list(metrics), "metric", "value")


def coverage(items: DataFrame) -> DataFrame:
    """(drive_id, n, n_extracted, n_files) by drive."""
    return items.groupBy("drive_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("content_extracted"), F.lit(False))).alias("n_extracted"), F.count_if(F.col("object_kind") == "file").alias("n_files"))


def coverage_rows(items: DataFrame) -> DataFrame:
    """(metric, value, notes): totals, objects by drive and files by whether their content was read."""
    done = F.coalesce(F.col("content_extracted"), F.lit(False))
    totals = items.agg(F.count("*").alias("objects"), F.count_if(F.col("object_kind") == "file").alias("files"), F.count_if(F.col("object_kind") == "folder").alias("folders"), F.count_if(F.startswith(F.coalesce("full_path", F.lit("")), F.lit("/Unmapped parent"))).alias("unmapped_parents"))
    totals = totals.unpivot([], totals.columns, "metric", "value").withColumn("notes", F.lit(""))
    drives = items.groupBy(F.coalesce("drive_id", F.lit("")).alias("notes")).agg(F.count("*").alias("value")).select(F.lit("objects_by_drive").alias("metric"), "value", "notes")
    status = F.when(F.col("object_kind") != "file", "not_attempted").when(done, "extracted").otherwise("not_extracted")
    extracted = items.groupBy(status.alias("notes")).agg(F.count("*").alias("value")).select(F.lit("content_status").alias("metric"), "value", "notes")
    return totals.unionByName(drives).unionByName(extracted)


def quality_rows(items: DataFrame, base: Column | None = None, dimensions: tuple[str, ...] = ("object_kind", "department_suggestion", "document_type_suggestion", "sensitivity_suggestion")) -> DataFrame:
    """(metric, value, notes): the counts of quality(), of the distributions of some dimensions, and of what lies inside a guarded base."""
    out = quality(items).withColumn("notes", F.lit(""))
    spread = summary(items, *dimensions)
    out = out.unionByName(spread.select(F.concat(F.lit("by_"), "dimension").alias("metric"), F.col("n").alias("value"), F.col("value").alias("notes")))
    if base is not None:
        b = items.withColumn("__base", F.coalesce(base, F.lit(False)))
        inside = {"base_rows": F.lit(True), "base_files": F.col("object_kind") == "file", "base_folders": F.col("object_kind") == "folder", "base_unknown_department": F.coalesce("department_suggestion", F.lit("")).isin("", "unknown"), "base_unknown_type": F.coalesce("document_type_suggestion", F.lit("")).isin("", "unknown")}
        one = b.agg(*(F.count_if(F.col("__base") & F.coalesce(c, F.lit(False))).alias(m) for m, c in inside.items()))
        out = out.unionByName(one.unpivot([], list(inside), "metric", "value").withColumn("notes", F.lit("")))
    return out


def folders_in_order(stats: DataFrame, tree: DataFrame) -> DataFrame:
    """Folder statistics with path and depth, ordered by depth and path; folders without a path come last."""
    placed = stats.join(tree.select(F.col("file_id").alias("parent"), "full_path", "depth"), "parent", "inner")
    return placed.orderBy(F.col("depth").asc_nulls_last(), F.col("full_path").asc_nulls_last(), "parent")


def folder_stats(items: DataFrame, duplicates: DataFrame | None = None, top: int = 5, many: int = 5) -> DataFrame:
    """Per folder that has children: counts, commonest types, and signals of disorder.

    Children are counted under every parent they name. Types are counted per
    (folder, type) first, so only the few types of a folder are ranked, never
    its children. `duplicates` (file_id) marks children in a duplicate group.
    """
    kids = items.select("file_id", "object_kind", "mime_type", "sensitivity_suggestion", "document_type_suggestion", F.explode(F.split("parents", ";")).alias("parent")).where(F.trim("parent") != "")
    if duplicates is not None:
        kids = kids.join(duplicates.select("file_id").distinct().withColumn("__dup", F.lit(True)), "file_id", "left")
    else:
        kids = kids.withColumn("__dup", F.lit(False))
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    stats = kids.groupBy("parent").agg(
        F.count_if(F.col("object_kind") == "folder").alias("n_folders"), F.count_if(F.col("object_kind") == "file").alias("n_files"),
        F.coalesce(F.bool_or("__dup"), F.lit(False)).alias("has_duplicates"), F.bool_or(~low("sensitivity_suggestion").isin("", "unknown", "public_internal", "operational")).alias("has_sensitive"), F.bool_or(low("document_type_suggestion").isin("", "unknown")).alias("has_unknown"),
    )
    types = kids.where(F.col("object_kind") == "file").groupBy("parent", "mime_type").agg(F.count("*").alias("n"))
    ranked = types.groupBy("parent").agg(F.count("*").alias("n_types"), F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.coalesce("mime_type", F.lit("")).alias("m")))), 1, top).alias("t"))
    ranked = ranked.select("parent", "n_types", F.array_join(F.transform("t", lambda x: F.concat(x["m"], F.lit(":"), (-x["k"]).cast("string"))), ";").alias("top_types"))
    out = stats.join(ranked, "parent", "left")
    return out.select("parent", "n_folders", "n_files", F.coalesce("n_types", F.lit(0)).alias("n_types"), F.coalesce("top_types", F.lit("")).alias("top_types"), "has_duplicates", "has_sensitive", "has_unknown", (F.coalesce("n_types", F.lit(0)) > many).alias("mixed_types"))


def largest_folders(stats: DataFrame, n: int = 20) -> DataFrame:
    """The n folders with most files; ties by id. A report, hence the limit."""
    return stats.orderBy(F.desc("n_files"), "parent").limit(n)


def first_within(rows: DataFrame, order: list[str], most: int, among: Column) -> DataFrame:
    """Rows marked `admitted`: the first `most` of those `among` holds for, in order; a running counter with a cap.

    Found as a bounded top-k, joined back on the order columns, which must tell
    rows apart; rows that agree in all of them are admitted together. Nulls
    come first, as they order.
    """
    chosen = rows.where(among).select(*(F.col(c).alias(f"__{c}") for c in order)).distinct().orderBy(*(f"__{c}" for c in order)).limit(most).withColumn("__in", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order])
    marked = rows.withColumn("__among", F.coalesce(among, F.lit(False))).join(chosen, same, "left")
    return marked.select(*rows.columns, (F.coalesce("__in", F.lit(False)) & F.col("__among")).alias("admitted"))


def stratified_sample(rows: DataFrame, stratum: str, key: str, per_stratum: int, seed: int) -> DataFrame:
    """The same rows for the same seed: the `per_stratum` smallest md5(seed:key) of each stratum.

    Two rounds of ranking, the first within slices of a stratum, so that a large stratum is not ranked in one task.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    r = rows.withColumn("__h", h).withColumn("__slice", F.substring("__h", 1, 2))
    w1 = Window.partitionBy(stratum, "__slice").orderBy("__h", key)
    few = r.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= per_stratum)
    w2 = Window.partitionBy(stratum).orderBy("__h", key)
    return few.withColumn("__r", F.row_number().over(w2)).where(F.col("__r") <= per_stratum).drop("__h", "__slice", "__r")


def rate_rollup(usage: DataFrame, rates: DataFrame, by: str) -> DataFrame:
    """Usage (by, kind, units) against rates (kind, unit_size, free_units, rate): units and cost by `by` and kind.

    Free units are taken off each record; a missing rate costs nothing. Rates
    are a fixed dimension of at most a few rows a kind.
    """
    r = usage.join(rates, "kind", "left")
    cost = F.greatest(F.col("units") - F.coalesce("free_units", F.lit(0)), F.lit(0)) / F.greatest(F.coalesce("unit_size", F.lit(1)), F.lit(1)) * F.coalesce("rate", F.lit(0.0))
    return r.groupBy(by, "kind").agg(F.count("*").alias("n"), F.sum("units").alias("units"), F.sum(cost).alias("cost"))


FORBIDDEN = ("DELETE", "MOVE", "RENAME", "SHARE", "TRASH_NOW")


def assert_advisory(rows: DataFrame, column: str) -> DataFrame:
    """`rows`, which fail when read if a value of `column` recommends to change a source."""
    bad = F.upper(F.coalesce(F.col(column), F.lit(""))).rlike("^(" + "|".join(FORBIDDEN) + r")(_|$)")
    return rows.where(F.coalesce(F.assert_true(~bad, F.lit("forbidden recommendation")).cast("string"), F.lit("")) == "")


def top_values(items: DataFrame, dimension: str, n: int = 20) -> DataFrame:
    """The n commonest values of a dimension; ties by value. A report, hence the limit."""
    return summary(items, dimension).select("value", "n").orderBy(F.desc("n"), "value").limit(n)


def percentiles(items: DataFrame, by: str, value: str, points: tuple[int, ...] = (50, 90, 95, 99)) -> DataFrame:
    """(by, n, p50, ...): values by nearest rank, nulls left out.

    Exact without ordering a group in one task: equal values are counted first,
    and the distinct (group, value) are sorted by range into parts that cut
    through groups; each part runs its own count, which the sums of the parts
    before it, one row for each group in a part, bring up to the group's.
    """
    counts = items.where(F.col(value).isNotNull()).groupBy(F.coalesce(by, F.lit("")).alias(by), F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    parts = max(8, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = materialize(counts.repartitionByRange(parts, by, "__v").withColumn("__p", F.spark_partition_id()), "percentiles")
    sums = spread.groupBy(by, "__p").agg(F.sum("__n").alias("__s"))
    w = Window.partitionBy(by)
    sums = sums.select(by, "__p", F.coalesce(F.sum("__s").over(w.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__s").over(w).alias("__all"))
    local = spread.withColumn("__to", F.sum("__n").over(Window.partitionBy("__p", by).orderBy("__v")))
    ranked = local.join(sums, ["__p", by]).withColumn("__to", F.col("__to") + F.col("__before"))
    need = lambda p: F.greatest(F.lit(1), F.ceil(F.col("__all") * p / 100))
    return ranked.groupBy(by).agg(F.max("__all").alias("n"), *(F.min(F.when(F.col("__to") >= need(p), F.col("__v"))).alias(f"p{p}") for p in points))
