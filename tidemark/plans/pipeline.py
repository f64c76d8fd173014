"""The whole inventory run: the inventory and the classified frame are written once each, and every output is derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import first_element
from ..operators import content, duplicates, hierarchy, rules, sieve, status, summaries
from ..operators.references import current_rows
from ..operators.skew import split_join
from ..packs import DEFAULT
from ..session import materialize
from ..sources import readers, sinks

MODES = ("inventory", "duplicates", "classify", "full", "sieve", "validate-rules")
#: Statuses that a run reports when no text of a file is at hand.
NOT_ATTEMPTED = "not_attempted"


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Current rows of the listed objects with the path, depth and root that their folders really have."""
    raw = spark.read.parquet(f"{folder}/inventory_items.parquet")
    drives = spark.read.parquet(f"{folder}/shared_drives.parquet")
    keep = [c for c in raw.columns if c not in ("file_id", "listed_at", "trashed")]
    items = current_rows(raw, *keep)
    tree = hierarchy.resolve_hierarchy(hierarchy.folder_links(raw, drives), paths=True)
    folders = tree.select(F.col("file_id").alias("__up"), F.col("full_path").alias("__path"))
    roots = drives.select(F.col("drive_id").alias("__up"), F.concat(F.lit("/"), F.col("shared_drive_name")).alias("__path")).dropDuplicates(["__up"])
    placed = split_join(items.withColumn("__up", first_element("parents")), folders.unionByName(roots), "__up", "left")
    name = F.coalesce("name", F.lit(""))
    path = F.when(F.col("__path").isNotNull(), F.concat("__path", F.lit("/"), name)).when(F.col("__up").isNull(), F.concat(F.lit("/"), name)).otherwise(F.concat(F.lit("/Unmapped parent "), F.col("__up"), F.lit("/"), name))
    return placed.withColumnRenamed("full_path", "listed_path").withColumn("full_path", path).drop("__up", "__path")


def _once(make: Callable[[], DataFrame], label: str) -> Callable[[], DataFrame]:
    """`make`, whose frame is written at its first use and read from then on."""
    held: list[DataFrame] = []

    def get() -> DataFrame:
        if not held:
            held.append(materialize(make(), label))
        return held[0]

    return get


def content_stage(items: DataFrame, documents: DataFrame, pack: list[content.ContentRule] | None = None) -> DataFrame:
    """Files with the votes of content rules over their texts, merged with what metadata says; the text itself is dropped.

    documents: (file_id, text). A file with several texts is inspected by the
    longest, then the greatest; files without one are `not_attempted`.
    """
    texts = documents.where(F.col("file_id").isNotNull() & F.col("text").isNotNull()).groupBy("file_id").agg(F.max(F.struct(F.length("text").alias("n"), "text"))["text"].alias("text"))
    voted = content.content_vote(content.match_content(texts, pack, "file_id"), pack)
    votes = [c for c in voted.columns if c.startswith("content_")]
    joined = items.drop(*(c for c in votes if c in items.columns)).join(voted.withColumn("__read", F.lit(True)), "file_id", "left")
    filled = joined.withColumns({c: F.coalesce(c, F.lit("")) for c in votes} | {"content_status": F.when(F.col("__read"), "extracted").otherwise(NOT_ATTEMPTED)})
    out = content.merge_with_metadata(filled, "document_type", F.col("document_type_suggestion")).withColumnsRenamed({"merged": "merged_document_type"})
    return out.select("file_id", "content_status", "matches", *votes, "merged_document_type", "content_conflict")


def sieve_registry(items: DataFrame) -> DataFrame:
    """The inventory as a registry for the sieve: exact groups as found, system files marked."""
    files = duplicates.eligible(items)
    found = duplicates.members(files, duplicates.content_key(), "EXACT").select("file_id", F.col("group_id").alias("duplicate_group_id"), F.lit("exact").alias("duplicate_kind"))
    trash = F.when(F.lower(F.coalesce("name", F.lit(""))).isin("thumbs.db", "desktop.ini", ".ds_store"), "system_trash_candidate").otherwise("")
    hashed = F.col("content_text_hash") if "content_text_hash" in items.columns else F.lit("")
    return items.drop("duplicate_group_id", "duplicate_kind").join(found, "file_id", "left").withColumns({"content_hash": hashed, "cleanup_category": trash})


def outputs(spark: SparkSession, items: DataFrame, mode: str, pack: list[rules.Rule], documents: DataFrame | None = None, config: sieve.SieveConfig = sieve.SieveConfig()) -> dict[str, Callable[[], DataFrame]]:
    """Name -> table, as far as the mode goes. Nothing is computed before a table is asked for, and nothing dear twice."""
    files = duplicates.eligible(items)
    if mode == "sieve":
        corpus = _once(lambda: sieve.corpus_sieve(sieve_registry(items), config)[0], "corpus")
        return {
            "corpus_inventory": corpus, "corpus_keep_canonical": lambda: sieve.kept(corpus()), "corpus_excluded": lambda: sieve.excluded(corpus()), "corpus_review_queue": lambda: sieve.review_queue(corpus()), "canonical_map": lambda: sieve.canonical_map(corpus()),
            "dedup_actions": lambda: sieve.dedup_actions(corpus()), "sieve_summary": lambda: sieve.sieve_summary(corpus()), "sieve_manifest": lambda: sieve.manifest(corpus()), "sieve_metrics": lambda: sieve.metrics(corpus()),
        }
    stats = _once(lambda: summaries.folder_stats(items), "folders")
    out: dict[str, Callable[[], DataFrame]] = {
        "all_objects": lambda: items,
        "skipped_sheets": lambda: items.where(F.col("mime_type") == readers.SHEET),
        "folders": stats,
        "largest_folders": lambda: summaries.largest_folders(stats()),
        "summary": lambda: summaries.summary(items, "object_kind", "department_suggestion", "document_type_suggestion", "sensitivity_suggestion"),
        "quality": lambda: summaries.quality_rows(items),
        "coverage": lambda: summaries.coverage_rows(items),
    }
    found = _once(lambda: duplicates.all_duplicates(files), "duplicates")
    if mode in ("duplicates", "full"):
        out |= {"duplicates": found, "exact_groups": lambda: duplicates.groups(files, duplicates.content_key(), "EXACT").drop("key")}
    if mode in ("classify", "full"):
        flat = items.withColumnsRenamed({c: f"listed_{c}" for c in (*rules.fields_of(pack), "family", "hits", "status", "evidence") if c in items.columns})
        scored = _once(lambda: status.finish(_with_fields(rules.classify(pack, flat))), "classified")
        viewed = lambda: scored().join(found().select("file_id", F.col("kind").alias("duplicate_kind")), "file_id", "left").na.fill({"duplicate_kind": ""})
        of_view = lambda name: viewed().where(F.coalesce(status.views()[name], F.lit(False))).drop("hits")
        out |= {
            "classified": lambda: scored().drop("hits"),
            "rule_performance": lambda: rules.rule_performance(spark, pack, scored()).join(rules.rule_examples(scored()), ["source", "rule_id"], "left"),
            "suspicious_rules": lambda: rules.suspicious_rules(rules.rule_performance(spark, pack, scored()), rules.validate(pack, spark)),
            "strategy_differences": lambda: rules.compare_strategies(pack, flat),
            **{f"view_{name}": (lambda name=name: of_view(name)) for name in status.views()},
        }
        if documents is not None:
            inspected = _once(lambda: content_stage(files, documents), "content")
            out |= {
                "content_inspection": lambda: inspected().drop("matches"),
                "content_rule_matches": lambda: rules.exploded(inspected(), "matches").select("file_id", "h.rule_id", "h.n", "h.score"),
                "content_flags": lambda: inspected().select("file_id", F.explode(F.split("content_flags", ";")).alias("flag")).where("flag <> ''"),
            }
    return out


def _with_fields(classified: DataFrame) -> DataFrame:
    """A pack need not vote on every field that the final status reads."""
    wanted = {*status.Settings().told, *status.Settings().core}
    return classified.withColumns({c: F.lit("unknown") for c in sorted(wanted) if c not in classified.columns})


def run(spark: SparkSession, source: str, target: str, mode: str = "full", pack: list[rules.Rule] | None = None, csv: bool = False, config: sieve.SieveConfig = sieve.SieveConfig()) -> dict[str, int]:
    """Write every output of a mode below `target`; returns the rows of each. `validate-rules` writes the findings only.

    The texts of `documents.parquet`, if the source has one, are what `full`
    inspects. A report in markdown goes along, of counts only.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    pack = DEFAULT if pack is None else pack
    findings = spark.createDataFrame(rules.validate(pack, spark) or [], "level string, rule_id string, message string")
    tables: dict[str, Callable[[], DataFrame]] = {"rule_findings": lambda: findings}
    if mode != "validate-rules":
        documents = None
        if mode == "full" and readers.exists(spark, f"{source}/documents.parquet"):
            documents = spark.read.parquet(f"{source}/documents.parquet").select("file_id", "text")
        tables |= outputs(spark, materialize(inventory(spark, source), "items"), mode, rules.usable(pack, spark), documents, config)
    counts = {}
    for name, make in tables.items():
        (sinks.write_csv if csv else sinks.write_parquet)(make(), f"{target}/{name}")
        counts[name] = (readers.read_registry(spark, f"{target}/{name}") if csv else spark.read.parquet(f"{target}/{name}")).count()
    made = spark.createDataFrame(sorted(counts.items()), "output string, rows bigint")
    sinks.write_text(spark, sinks.markdown_report(f"Run: {mode}", ["Nothing was changed at the source."], {"Outputs": made}), f"{target}/report.md")
    sinks.append_jsonl(spark.createDataFrame([(mode, source, sum(counts.values()))], "mode string, source string, rows bigint").withColumn("finished_at", F.current_timestamp()), f"{target}/run_log")
    return counts
