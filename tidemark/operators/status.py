"""What a classified item comes to: family, status, confidence, retention, reason, and the report views it belongs to.

All of it is a function of the row, from columns of rules.classify(): ordered
decisions over votes, confidences and conflicts. What differs from one
deployment to the next (families, neutral values, retention) is in Settings.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = ("", "unknown")


@dataclass(frozen=True)
class Settings:
    """`core` fields decide whether an item is known at all; `known` ones also count for high confidence; `retention` is tried in order."""

    families: dict[str, str] = field(default_factory=lambda: {"contract": "legal_document", "act": "legal_document", "invoice": "finance_document", "estimate": "finance_document", "timesheet": "staff_document", "report": "report", "plan": "drawing", "minutes": "report", "sop": "procedure"})
    core: tuple[str, ...] = ("department", "document_type", "family")
    known: tuple[str, ...] = ("department", "document_type", "family", "sensitivity")
    least_unknown: int = 2
    least_known: int = 3
    neutral: tuple[str, ...] = ("", "unknown", "operational", "public_internal")
    system: tuple[str, ...] = ("system",)
    media_families: tuple[str, ...] = ("media",)
    retention: tuple[tuple[str, str, tuple[str, ...]], ...] = (("short_term_review", "cleanup", ("system", "unnamed")), ("controlled_retention_review", "sensitivity", ("legal", "financial", "personal")), ("archive_review", "lifecycle", ("archive",)))
    told: tuple[str, ...] = ("department", "document_type", "family", "sensitivity", "lifecycle", "cleanup", "media")


def lookup(c: Column, table: dict[str, str], default: Column) -> Column:
    """The entry of a small fixed table, or the default."""
    if not table:
        return default
    pairs = F.create_map(*(F.lit(x) for kv in sorted(table.items()) for x in kv))
    return F.coalesce(F.try_element_at(pairs, c), default)


def unknown(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")).isin(*UNKNOWN)


def is_media(settings: Settings) -> Column:
    """By family or by subtype."""
    return F.col("family").isin(*settings.media_families) | ~unknown("media")


def normal_confidence(c: Column) -> Column:
    """high, medium, low and needs_review stay; blank and unknown are unknown; anything else is medium."""
    v = F.coalesce(c, F.lit(""))
    return F.when(v.isin("high", "medium", "low", "needs_review"), v).when(v.isin(*UNKNOWN), "unknown").otherwise("medium")


def class_of_flags(flags: Column, classes: list[tuple[str, tuple[str, ...]]], default: str = "unknown") -> Column:
    """The first class one of whose flags is in a ';'-joined list."""
    have = F.split(F.coalesce(flags, F.lit("")), ";")
    out = None
    for name, wanted in classes:
        on = F.arrays_overlap(have, F.array(*map(F.lit, wanted)))
        out = F.when(on, name) if out is None else out.when(on, name)
    return F.lit(default) if out is None else out.otherwise(default)


def _count(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("int") for c in conditions])


def finish(classified: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`classified` with family by type, `final_status`, `combined_confidence`, `retention`, `recommendation` and `final_reason`."""
    s = settings
    out = classified.withColumn("family", lookup(F.col("document_type"), s.families, F.col("family")))
    conflict, hits = F.size("conflict_fields") > 0, F.size("hits") > 0
    system, sensitive = F.col("cleanup").isin(*s.system), ~F.col("sensitivity").isin(*s.neutral)
    first = (
        F.when(system, "system").when(conflict, "conflict").when(sensitive, "sensitive").when(F.col("path_confidence") == "high", "by_path").when(F.col("filename_confidence") == "high", "by_name")
        .when(F.col("extension_confidence") != "", "by_extension_only").when(is_media(s), "media").when(hits, "weak").otherwise("unknown")
    )
    lost = _count([unknown(c) for c in s.core]) >= s.least_unknown
    status = F.when(~system & lost, F.when(hits, "needs_review").otherwise("unknown")).otherwise(first)
    sure = ("medium", "high")
    named = F.col("filename_confidence").isin(*sure)
    confidence = (
        F.when(conflict, "needs_review").when((F.col("path_confidence") == "high") & named & (_count([~unknown(c) for c in s.known]) >= s.least_known), "high")
        .when(F.col("path_confidence").isin(*sure) | named, "medium").when(F.col("extension_confidence") != "", "low").otherwise("unknown")
    )
    keep = None
    for label, c, values in s.retention:
        keep = F.when(F.col(c).isin(*values), label) if keep is None else keep.when(F.col(c).isin(*values), label)
    keep = F.lit("standard_review") if keep is None else keep.otherwise("standard_review")
    said = [F.when(~unknown(c), F.concat(F.lit(f"{c}="), F.col(c))) for c in s.told]
    sources = F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["source"]))), ",")
    told = F.array_join(F.array_compact(F.array(*said, F.concat(F.lit("sources="), sources), F.when(conflict, F.concat(F.lit("conflicts="), F.array_join("conflict_fields", ";"))))), "; ")
    reason = F.when(hits, told).otherwise("No confident metadata classification rule matched.")
    return out.withColumns({"final_status": status, "combined_confidence": confidence, "retention": keep, "recommendation": F.when(sensitive, "SENSITIVE_REVIEW_REQUIRED").otherwise("REVIEW_REQUIRED"), "final_reason": reason})


def views(settings: Settings = Settings()) -> dict[str, Column]:
    """Report view -> its predicate, over finish() with `duplicate_kind` joined on ('' outside groups)."""
    return {
        "exact_duplicates": F.col("duplicate_kind") == "exact",
        "version_duplicates": F.col("duplicate_kind") == "version_candidate",
        "semantic_duplicates": F.col("duplicate_kind") == "semantic_candidate",
        "classification_review": F.col("combined_confidence").isin("low", "medium") | unknown("document_type"),
        "sensitivity_review": F.col("recommendation") == "SENSITIVE_REVIEW_REQUIRED",
        "cleanup_candidates": ~unknown("cleanup"),
        "system_files": F.col("cleanup").isin(*settings.system),
        "unknown": F.col("final_status").isin("unknown", "needs_review") | F.col("combined_confidence").isin("unknown", "needs_review"),
        "not_classified": F.col("final_status").isin("unknown", "needs_review"),
        "conflicts": F.size("conflict_fields") > 0,
        "sensitive": ~F.col("sensitivity").isin(*settings.neutral),
        "media": is_media(settings),
        "archive": F.col("lifecycle") == "archive",
        "by_extension_only": F.col("final_status") == "by_extension_only",
        "native_documents": F.startswith(F.coalesce("mime_type", F.lit("")), F.lit("application/vnd.google-apps.")),
    }


def view_rows(finished: DataFrame, key: str = "file_id", settings: Settings = Settings()) -> DataFrame:
    """(view, key): the rows of every view, all predicates in one pass. A null predicate is false."""
    named = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(v)) for v, c in views(settings).items())))
    return finished.select(key, F.explode(named).alias("view")).select("view", key)
