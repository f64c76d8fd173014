"""Sieving a registry: exact groups with a canonical member, ordered decisions, and the tables that follow from them.

Decisions are data: the first whose condition holds gives a row its status.
They become one CASE expression, so a row is decided in one pass and has
exactly one status. The sieve only advises: nothing is changed at the source.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .duplicates import best_members, number
from .skew import split_join
from .summaries import summary


@dataclass(frozen=True)
class Decision:
    status: str
    reason: str
    condition: Column


def near_empty(size: Column, extension: Column, least: int = 16, small: int = 64, plain: tuple[str, ...] = ("txt", "csv", "log")) -> Column:
    """At most `least` bytes, or at most `small` for plain text; sizes that are no whole numbers are not."""
    text = size.cast("string")
    n = F.when(text.rlike(r"^\d+$"), text).try_cast("bigint")
    return F.coalesce((n <= least) | ((n <= small) & F.lower(extension).isin(*plain)), F.lit(False))


# fixed values: parts of a value that say it is unknown
UNKNOWN_PARTS = ("unknown", "неизвест", "не определ")


def known(c: Column) -> Column:
    """Neither blank nor with a word in it that says unknown."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return reduce(lambda a, b: a & b, [~F.contains(low, F.lit(p)) for p in UNKNOWN_PARTS], low != "")


def decide(rows: DataFrame, decisions: list[Decision], default: tuple[str, str] = ("KEEP", "no rule applies")) -> DataFrame:
    """`rows` with `status` and `reason` of the first decision whose condition is true; null counts as false."""
    status = reason = None
    for d in decisions:
        on = F.coalesce(d.condition, F.lit(False))
        status = F.when(on, d.status) if status is None else status.when(on, d.status)
        reason = F.when(on, d.reason) if reason is None else reason.when(on, d.reason)
    if status is None:
        return rows.withColumns({"status": F.lit(default[0]), "reason": F.lit(default[1])})
    return rows.withColumns({"status": status.otherwise(default[0]), "reason": reason.otherwise(default[1])})


def action_list(rows: DataFrame) -> DataFrame:
    """(action, status, n, bytes) of a decided registry."""
    action = F.when(F.startswith("status", F.lit("KEEP")), "keep").when(F.startswith("status", F.lit("HOLD")), "review").otherwise("exclude")
    return rows.groupBy(action.alias("action"), "status").agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


# ---- the corpus sieve ---------------------------------------------------------


@dataclass(frozen=True)
class SieveRule:
    """A status for names that match a pattern, or for extensions."""

    rule_id: str
    status: str
    reason: str = ""
    pattern: str = ""
    extensions: tuple[str, ...] = ()


@dataclass(frozen=True)
class SieveConfig:
    """What a deployment decides by: limits of emptiness, values and words that hold a file back, and rules in their order."""

    empty: int = 0
    near_empty: int = 16
    review_missing_path: bool = True
    hold_values: tuple[str, ...] = ()
    legal_categories: tuple[str, ...] = ()
    staff_words: tuple[str, ...] = ()
    name_rules: tuple[SieveRule, ...] = ()
    extension_rules: tuple[SieveRule, ...] = ()


def load_config(path: str) -> SieveConfig:
    """A configuration kept as JSON or YAML, below `corpus_sieve` or at the top."""
    text = Path(path).read_text("utf-8-sig")
    if path.endswith((".yml", ".yaml")):
        import yaml

        data = yaml.safe_load(text) or {}
    else:
        data = json.loads(text)
    return parse_config(data.get("corpus_sieve", data))


def parse_config(data: dict) -> SieveConfig:
    rule = lambda r: SieveRule(str(r.get("rule_id", "")), str(r.get("status", "CORPUS_REVIEW_UNKNOWN_VALUE")), str(r.get("reason", "")), str(r.get("filename_regex", "")), tuple(str(e).lower().lstrip(".") for e in r.get("extensions", ())))
    texts = lambda key: tuple(map(str, data.get(key) or ()))
    return SieveConfig(
        int(data.get("empty_file_max_bytes", 0)), int(data.get("near_empty_file_max_bytes", 16)), bool(data.get("review_unmapped_parent", True)), texts("sensitivity_hold_values"), texts("legal_hold_cleanup_categories"), texts("hr_markers"),
        tuple(map(rule, data.get("system_trash_rules") or ())), tuple(map(rule, data.get("extension_rules") or ())),
    )


#: The columns a registry is to have; all are texts but size, and missing ones are empty.
REGISTRY = (
    "file_id", "name", "object_kind", "mime_type", "extension", "size", "md5_checksum", "content_hash", "export_hash", "created_time", "modified_time", "full_path", "duplicate_group_id", "duplicate_kind", "canonical_candidate_id",
    "object_suggestion", "department_suggestion", "document_type_suggestion", "document_family_suggestion", "sensitivity_suggestion", "lifecycle_status", "cleanup_category", "human_review_queue",
)
# fixed values: the columns of a corpus row, in order
CORPUS_COLUMNS = (
    "file_id name path mime_type extension size_bytes created_time modified_time content_hash duplicate_group_id canonical_file_id is_canonical corpus_status exclusion_reason sieve_rule_ids "
    "object_hint department_hint document_type_hint sensitivity_hint lifecycle_hint needs_review review_reason safe_for_content_processing safe_for_physical_delete_candidate confidence"
).split()
# fixed values: reasons of the decisions that are not configured, by the id under which a row names them
REASONS = {
    "corpus_exact_duplicate_hold": "Exact duplicate held by sensitivity/legal/HR gate.",
    "corpus_exact_duplicate": "Exact duplicate suppressed from expensive downstream processing.",
    "corpus_cleanup_system_trash": "Metadata cleanup layer marked system trash.",
    "corpus_empty_or_near_empty": "Zero-byte or near-empty file is not useful for content extraction.",
    "corpus_missing_path_review": "Missing path/full_path; parent context is incomplete.",
    "corpus_sensitive_hold": "Sensitive/legal/HR file held from automatic downstream processing until policy review.",
    "corpus_keep_default": "",
}
# fixed values: reasons of what becomes of a group's members
ACTION_REASONS = {
    "canonical": "Canonical file selected for exact duplicate group.",
    "twin": "Dry-run delete candidate; also suppressed from downstream processing.",
    "other": "Suppressed from downstream processing.",
}
# fixed values: words of paths and names by which the member to keep is chosen
PASSING_PATHS = ("temp", "tmp", "copy", "export", "whatsapp", "telegram", "download")
FINAL_WORDS = ("signed", "final", "contract", "legal", "договор")
DULL_NAMES = ("scan", "image", "copy", "new", "final2")


def _has_any(c: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p.lower())) for p in parts], F.lit(False))


def registry(rows: DataFrame) -> DataFrame:
    """`rows` with every column of REGISTRY, texts and never null, and those of `rows` that are left; rows of other kinds than file are left out."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c)
    kind = F.coalesce(F.col("object_kind"), F.lit("file")) if "object_kind" in rows.columns else F.lit("file")
    return rows.where(kind == "file").select(*(text(c) for c in REGISTRY), *(c for c in rows.columns if c not in REGISTRY))


def stable_content_key() -> Column:
    """Of a registry: the content's hash, else the export's, else md5 with size; '' where none is known."""
    return F.when(F.col("content_hash") != "", F.concat(F.lit("content:"), "content_hash")).when(F.col("export_hash") != "", F.concat(F.lit("export:"), "export_hash")).when((F.col("md5_checksum") != "") & (F.col("size") != ""), F.concat(F.lit("md5:"), "md5_checksum", F.lit(":"), "size")).otherwise("")


def canonical_score() -> Column:
    """What makes a member the one to keep, the greatest first: a final mark, no passing place, known context, a telling name, size, time, name."""
    path, name = F.lower("full_path"), F.lower("name")
    context = [known(F.col(c)).cast("int") for c in ("object_suggestion", "department_suggestion", "document_type_suggestion")]
    return F.struct(
        (_has_any(path, FINAL_WORDS) | _has_any(name, FINAL_WORDS)).cast("int").alias("final"), (~_has_any(path, PASSING_PATHS)).cast("int").alias("placed"), reduce(lambda a, b: a + b, context).alias("known"),
        (~_has_any(name, DULL_NAMES)).cast("int").alias("telling"), F.coalesce(F.col("size").try_cast("bigint"), F.lit(0)).alias("size"), F.col("modified_time").alias("at"), name.alias("name"),
    )


def sieve_groups(rows: DataFrame, order: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """`rows` (a registry with `__key`) with `group_id` and `group_canonical`, null outside groups; and the groups (group_id, n_rows).

    Groups of the registry stay where two or more rows name them as exact.
    Other rows group by content; a group with a member in a kept one is left
    out whole. Groups by content are numbered on, in order of appearance.
    """
    score = canonical_score()
    files = lambda on: rows.withColumn("__key", on).where(F.col("__key").isNotNull()).select("__key", "file_id", score.alias("__score"), F.lit(0).alias("size"), *(c for c in order if c != "file_id"))
    best = lambda on: best_members(files(on), F.col("__score"), order).where(F.col("n_rows") > 1).select("__key", "canonical_id", "first", "n_rows")
    named = materialize(best(F.when((F.col("duplicate_kind") == "exact") & (F.col("duplicate_group_id") != ""), F.col("duplicate_group_id"))), "named")
    in_kept = split_join(rows.withColumn("__gid", F.when(F.col("duplicate_group_id") != "", F.col("duplicate_group_id"))), named.select(F.col("__key").alias("__gid"), F.lit(True).alias("__kept"), F.col("canonical_id").alias("__kept_best")), "__gid", "left")
    in_kept = materialize(in_kept.withColumn("__hash", F.when(F.col("__key") != "", F.col("__key"))), "sieve_rows")
    taken = in_kept.where("__hash is not null").groupBy("__hash").agg(F.coalesce(F.bool_or("__kept"), F.lit(False)).alias("__taken")).where("__taken").select(F.col("__hash").alias("__key"))
    free = best(F.when(F.col("__key") != "", F.col("__key"))).join(taken, "__key", "left_anti")
    numbered = number(free, "first").select(F.col("__key").alias("__hash"), F.format_string("EXACT-SIEVE-%05d", F.col("number") + F.lit(named.count()).cast("int")).alias("__new"), F.col("canonical_id").alias("__new_best"), "n_rows")
    numbered = materialize(numbered, "hashed")
    placed = split_join(in_kept, numbered.drop("n_rows"), "__hash", "left")
    mine = F.coalesce(F.col("__kept"), F.lit(False)) & (F.col("duplicate_kind") == "exact")
    out = placed.withColumns({"group_id": F.when(mine, F.col("duplicate_group_id")).otherwise(F.col("__new")), "group_canonical": F.when(mine, F.col("__kept_best")).otherwise(F.col("__new_best"))})
    groups = named.select(F.col("__key").alias("group_id"), "n_rows").unionByName(numbered.select(F.col("__new").alias("group_id"), "n_rows"))
    return out.drop("__gid", "__kept", "__kept_best", "__hash", "__new", "__new_best"), groups


_OUTCOME = "struct<status:string,reason:string,rule_id:string,needs_review:boolean,content_safe:boolean,delete_safe:boolean,confidence:string>"


def _outcome(status, reason: str | Column, rule_id: str, review, safe: bool, gone, confidence: str) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(status).alias("status"), lit(reason).alias("reason"), F.lit(rule_id).alias("rule_id"), lit(review).alias("needs_review"), F.lit(safe).alias("content_safe"), lit(gone).alias("delete_safe"), F.lit(confidence).alias("confidence")).cast(_OUTCOME)


def hold_status(config: SieveConfig) -> Column:
    """The status that holds a row back, '' if none: words of staff matters, legal ones, then values held back."""
    flat = F.lower(F.concat_ws(" ", "sensitivity_suggestion", "cleanup_category", "document_family_suggestion", "document_type_suggestion", "department_suggestion", "human_review_queue"))
    held = _held(config)
    legal = F.col("cleanup_category").isin(*config.legal_categories) if config.legal_categories else F.lit(False)
    return F.when(_has_any(flat, config.staff_words), "CORPUS_HOLD_HR").when(legal | F.contains(flat, F.lit("legal")) | F.contains(flat, F.lit("contract")), "CORPUS_HOLD_LEGAL").when(held, "CORPUS_HOLD_SENSITIVE").otherwise("")


def _held(config: SieveConfig) -> Column:
    return (F.col("sensitivity_suggestion").isin(*config.hold_values) | F.col("cleanup_category").isin(*config.hold_values)) if config.hold_values else F.lit(False)


def corpus_sieve(rows: DataFrame, config: SieveConfig = SieveConfig(), order: tuple[str, ...] = ("listed_at", "file_id")) -> tuple[DataFrame, DataFrame]:
    """(corpus rows with CORPUS_COLUMNS, groups): every file of a registry decided.

    `order` names the columns that say which row came first; they are to tell
    rows apart. Missing columns count as empty. An empty registry gives no rows.
    """
    keyed = registry(rows).withColumn("__key", stable_content_key())
    placed, groups = sieve_groups(keyed, order)
    in_group = F.col("group_id").isNotNull()
    canonical = F.coalesce("group_canonical", F.when(F.col("canonical_candidate_id") != "", F.col("canonical_candidate_id")), "file_id")
    placed = placed.withColumns({"__canonical": canonical, "__hold": hold_status(config), "__ext": F.regexp_replace(F.lower("extension"), r"^\.+", "")}).withColumn("__is", F.col("file_id") == F.col("__canonical"))
    twin = in_group & ~F.col("__is")
    chain: list[tuple[Column, Column]] = [
        (twin & (F.col("__hold") != ""), _outcome(F.col("__hold"), REASONS["corpus_exact_duplicate_hold"], "corpus_exact_duplicate_hold", True, False, False, "high")),
        (twin, _outcome("CORPUS_SUPPRESS_EXACT_DUPLICATE", REASONS["corpus_exact_duplicate"], "corpus_exact_duplicate", False, False, True, "high")),
    ]
    for r in config.name_rules:
        if r.pattern:
            chain.append((F.col("name").rlike(r.pattern), _outcome(r.status, r.reason, r.rule_id, r.status.startswith("CORPUS_HOLD_"), False, True, "high")))
    for r in config.extension_rules:
        review = r.status.startswith("CORPUS_HOLD_") or r.status == "CORPUS_REVIEW_UNKNOWN_VALUE"
        gone = ~_held(config) if r.status.startswith("CORPUS_EXCLUDE_") else F.lit(False)
        chain.append(((F.col("__ext") != "") & (F.col("__ext").isin(*r.extensions) if r.extensions else F.lit(False)), _outcome(r.status, r.reason, r.rule_id, review, False, gone, "high")))
    chain += [
        (F.col("cleanup_category") == "system_trash_candidate", _outcome("CORPUS_EXCLUDE_SYSTEM_TRASH", REASONS["corpus_cleanup_system_trash"], "corpus_cleanup_system_trash", False, False, True, "high")),
        (near_empty(F.col("size"), F.col("extension"), config.empty, config.near_empty), _outcome("CORPUS_EXCLUDE_EMPTY", REASONS["corpus_empty_or_near_empty"], "corpus_empty_or_near_empty", False, False, True, "medium")),
        (F.lit(config.review_missing_path) & (F.col("full_path") == ""), _outcome("CORPUS_REVIEW_UNKNOWN_VALUE", REASONS["corpus_missing_path_review"], "corpus_missing_path_review", True, False, False, "medium")),
        (F.col("__hold") != "", _outcome(F.col("__hold"), REASONS["corpus_sensitive_hold"], "corpus_sensitive_hold", True, False, False, "medium")),
    ]
    keep = _outcome("CORPUS_KEEP_CANONICAL", REASONS["corpus_keep_default"], "corpus_keep_default", False, True, False, "medium")
    case = reduce(lambda c, x: F.when(x[0], x[1]) if c is None else c.when(x[0], x[1]), chain, None).otherwise(keep)
    d = placed.withColumn("d", case)
    truth = lambda c: F.lower(c.cast("string"))
    out = d.select(
        "file_id", "name", F.col("full_path").alias("path"), "mime_type", "extension", F.col("size").alias("size_bytes"), "created_time", "modified_time", F.col("__key").alias("content_hash"), F.coalesce("group_id", F.lit("")).alias("duplicate_group_id"),
        F.col("__canonical").alias("canonical_file_id"), truth(F.col("__is")).alias("is_canonical"), F.col("d.status").alias("corpus_status"), F.when(F.col("d.status") == "CORPUS_KEEP_CANONICAL", "").otherwise(F.col("d.reason")).alias("exclusion_reason"), F.col("d.rule_id").alias("sieve_rule_ids"),
        F.col("object_suggestion").alias("object_hint"), F.col("department_suggestion").alias("department_hint"), F.col("document_type_suggestion").alias("document_type_hint"), F.col("sensitivity_suggestion").alias("sensitivity_hint"), F.col("lifecycle_status").alias("lifecycle_hint"),
        truth(F.col("d.needs_review")).alias("needs_review"), F.when(F.col("d.needs_review"), F.col("d.reason")).otherwise("").alias("review_reason"), truth(F.col("d.content_safe")).alias("safe_for_content_processing"),
        truth(F.col("d.delete_safe")).alias("safe_for_physical_delete_candidate"), F.col("d.confidence").alias("confidence"),
    )
    return out, groups


def kept(corpus: DataFrame) -> DataFrame:
    return corpus.where(F.col("corpus_status") == "CORPUS_KEEP_CANONICAL")


def excluded(corpus: DataFrame) -> DataFrame:
    return corpus.where(F.startswith("corpus_status", F.lit("CORPUS_EXCLUDE_")) | (F.col("corpus_status") == "CORPUS_SUPPRESS_EXACT_DUPLICATE"))


def review_queue(corpus: DataFrame) -> DataFrame:
    return corpus.where((F.col("needs_review") == "true") | F.startswith("corpus_status", F.lit("CORPUS_HOLD_")) | (F.col("corpus_status") == "CORPUS_REVIEW_UNKNOWN_VALUE"))


def _with_action(corpus: DataFrame) -> DataFrame:
    """Members of groups with `dedup_action` and `reason`."""
    status = F.col("corpus_status")
    held = status.isin("CORPUS_HOLD_HR", "CORPUS_HOLD_LEGAL", "CORPUS_HOLD_SENSITIVE")
    canonical, twin = F.col("is_canonical") == "true", status == "CORPUS_SUPPRESS_EXACT_DUPLICATE"
    action = F.when(canonical, "CANONICAL_KEEP").when(held, F.replace(status, F.lit("CORPUS_"), F.lit("DEDUP_"))).when(twin, "EXACT_DUPLICATE_DELETE_CANDIDATE").otherwise("EXACT_DUPLICATE_SUPPRESS_FROM_PROCESSING")
    reason = (
        F.when(canonical, ACTION_REASONS["canonical"]).when(held, F.col("review_reason")).when(twin, ACTION_REASONS["twin"])
        .when(F.col("exclusion_reason") != "", F.col("exclusion_reason")).otherwise(ACTION_REASONS["other"])
    )
    return corpus.where(F.col("duplicate_group_id") != "").withColumns({"dedup_action": action, "reason": reason})


def dedup_actions(corpus: DataFrame) -> DataFrame:
    """(duplicate_group_id, file_id, canonical_file_id, dedup_action, dry_run_only, safe_for_physical_delete_candidate, reason) of every member of a group."""
    return _with_action(corpus).select("duplicate_group_id", "file_id", "canonical_file_id", "dedup_action", F.lit("true").alias("dry_run_only"), "safe_for_physical_delete_candidate", "reason")


def canonical_map(corpus: DataFrame) -> DataFrame:
    """(duplicate_group_id, file_id, canonical_file_id, is_canonical, name, path, content_hash, dedup_action, dedup_reason) of every member of a group."""
    return _with_action(corpus).select("duplicate_group_id", "file_id", "canonical_file_id", "is_canonical", "name", "path", "content_hash", "dedup_action", F.col("reason").alias("dedup_reason"))


def manifest(corpus: DataFrame) -> DataFrame:
    """(file_id, name, corpus_status, canonical_file_id, dry_run_only, safe_for_content_processing, safe_for_physical_delete_candidate, reason) of every file."""
    reason = F.when(F.col("exclusion_reason") != "", F.col("exclusion_reason")).otherwise(F.col("review_reason"))
    return corpus.select("file_id", "name", "corpus_status", "canonical_file_id", F.lit(True).alias("dry_run_only"), "safe_for_content_processing", "safe_for_physical_delete_candidate", reason.alias("reason"))


def sieve_summary(corpus: DataFrame) -> DataFrame:
    """(dimension, value, n) over nine dimensions; blank values are "(empty)"."""
    return summary(corpus, "corpus_status", "safe_for_content_processing", "safe_for_physical_delete_candidate", "sieve_rule_ids", "mime_type", "extension", "object_hint", "department_hint", "document_type_hint")


def metrics(corpus: DataFrame) -> DataFrame:
    """One row of sixteen totals of a sieved registry."""
    status, safe = F.col("corpus_status"), F.col("safe_for_content_processing") == "true"
    of = lambda *s: F.count_if(status.isin(*s))
    starts = lambda p: F.count_if(F.startswith(status, F.lit(p)))
    n, n_safe = F.count("*"), F.count_if(safe)
    return corpus.agg(
        n.alias("total_files_considered"), of("CORPUS_KEEP_CANONICAL").alias("canonical_keep"), F.count_distinct(F.when(F.col("duplicate_group_id") != "", F.col("duplicate_group_id"))).alias("exact_duplicate_groups"), F.count_if((F.col("duplicate_group_id") != "") & (F.col("is_canonical") == "false") & ~safe).alias("exact_duplicate_files_suppressed"),
        starts("CORPUS_EXCLUDE_").alias("excluded_files"), starts("CORPUS_HOLD_").alias("hold_files"), F.count_if(F.col("needs_review") == "true").alias("review_queue"), n_safe.alias("safe_for_content_processing"),
        (n - n_safe).alias("estimated_processing_load_reduction_files"), F.coalesce(F.round((n - n_safe) / F.nullif(n, F.lit(0)) * 100, 2), F.lit(0.0)).alias("estimated_processing_load_reduction_percent"),
        of("CORPUS_EXCLUDE_SYSTEM_TRASH").alias("system_trash_excluded"), of("CORPUS_EXCLUDE_TEMP", "CORPUS_EXCLUDE_CACHE_PREVIEW").alias("temp_cache_excluded"), of("CORPUS_EXCLUDE_INSTALLER", "CORPUS_EXCLUDE_APP_BINARY").alias("installers_binaries_excluded"),
        of("CORPUS_EXCLUDE_MAIL_ARCHIVE").alias("mail_archives_excluded"), of("CORPUS_HOLD_ARCHIVE_CONTAINER").alias("archive_containers_held"), of("CORPUS_ERROR").alias("errors"),
    )
