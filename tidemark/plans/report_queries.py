"""Registered queries of the sieve's tables, final status, report views, sources and sinks, with their SQL."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import text
from ..functions.common import table
from ..operators import duplicates, hierarchy, rules, sieve, status, summaries
from ..session import forget_later, materialize, shared_folder, ship
from ..sources import extract, readers, sinks
from .reference_queries import _CUR, _EXACT, _TEXTS, RULES, _docs, _ext, _files, _hits_cte, _items, _norm, _q, _texts, _votes_sql
from .problem_queries import _CURRENT, _TREE
from .reference_queries import _KIDS
from .reference_queries import _KNOWN as KNOWN_SQL

# ---- sieve ------------------------------------------------------------------

#: A neutral configuration, in the form that files of it have.
CONFIG = {
    "near_empty_file_max_bytes": 64,
    "sensitivity_hold_values": ["personal_data", "financial", "owner_data", "guest_data"],
    "legal_hold_cleanup_categories": ["legal_hold_review"],
    "hr_markers": ["hr", "timesheet"],
    "system_trash_rules": [{"rule_id": "name_temp", "status": "CORPUS_EXCLUDE_TEMP", "reason": "Temporary file.", "filename_regex": r"^~\$|(?i)\.tmp$"}],
    "extension_rules": [
        {"rule_id": "ext_archive", "status": "CORPUS_HOLD_ARCHIVE_CONTAINER", "reason": "Archive container.", "extensions": ["zip", ".7z"]},
        {"rule_id": "ext_binary", "status": "CORPUS_EXCLUDE_APP_BINARY", "reason": "No text inside.", "extensions": ["mp4", "exe"]},
    ],
}
SIEVE = sieve.parse_config(CONFIG)
ORDER = ("listed_at", "file_id")
_LAST = ("sieved_at", "name", "path", "mime_type", "extension", "size_bytes", "created_time", "modified_time", "content_hash", "duplicate_group_id", "canonical_file_id", "object_hint", "department_hint", "document_type_hint", "sensitivity_hint", "lifecycle_hint")


def _registry(spark, sf_dir):
    """The last state of each file of an earlier sieve as a registry; groups count as exact where a canonical file is named."""
    last = readers.last_per_key(table(spark, sf_dir, "corpus_rows", "file_id", *_LAST).where(F.col("file_id").isNotNull()), "file_id", "sieved_at")
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    trash = F.when(F.lower(F.coalesce("name", F.lit(""))).isin("thumbs.db", "desktop.ini", ".ds_store"), "system_trash_candidate").otherwise("")
    renamed = {"path": "full_path", "size_bytes": "size", "object_hint": "object_suggestion", "department_hint": "department_suggestion", "document_type_hint": "document_type_suggestion", "sensitivity_hint": "sensitivity_suggestion", "lifecycle_hint": "lifecycle_status"}
    kinds = {"duplicate_kind": F.when(filled("canonical_file_id") & filled("duplicate_group_id"), "exact").otherwise(""), "duplicate_group_id": F.when(filled("duplicate_group_id"), F.col("duplicate_group_id")).otherwise(""), "cleanup_category": trash}
    return last.withColumns(kinds).drop("canonical_file_id").withColumnsRenamed(renamed)


def _corpus(spark, sf_dir):
    return materialize(sieve.corpus_sieve(_registry(spark, sf_dir), SIEVE, ("sieved_at", "file_id"))[0], "corpus")


def corpus_row(spark, sf_dir):
    return _corpus(spark, sf_dir)


def canonical_map(spark, sf_dir):
    return sieve.canonical_map(_corpus(spark, sf_dir))


def dedup_actions(spark, sf_dir):
    return sieve.dedup_actions(_corpus(spark, sf_dir))


def sieve_manifest(spark, sf_dir):
    return sieve.manifest(_corpus(spark, sf_dir))


def sieve_lists(spark, sf_dir):
    """Which of the three lists (kept, excluded, to review) each file is in; it may be in several."""
    corpus = _corpus(spark, sf_dir)
    lists = {"keep_canonical": sieve.kept, "excluded": sieve.excluded, "review_queue": sieve.review_queue}
    out = None
    for name, of in lists.items():
        part = of(corpus).select(F.lit(name).alias("list"), "file_id", "corpus_status")
        out = part if out is None else out.unionByName(part)
    return out


def sieve_summary(spark, sf_dir):
    return sieve.sieve_summary(_corpus(spark, sf_dir))


def sieve_metrics(spark, sf_dir):
    return sieve.metrics(_corpus(spark, sf_dir))


# ---- status and views ---------------------------------------------------------

SETTINGS = status.Settings()
GUARD = "договоры"


def _finished(spark, sf_dir):
    """Classified and finished, written once for all that is derived from it."""
    return materialize(status.finish(rules.classify(RULES, _items(spark, sf_dir)), SETTINGS), "finished")


def _viewed(spark, sf_dir):
    kinds = duplicates.all_duplicates(_files(spark, sf_dir)).select("file_id", F.col("kind").alias("__kind"))
    return _finished(spark, sf_dir).join(kinds, "file_id", "left").withColumn("duplicate_kind", F.coalesce("__kind", F.lit("")))


def final_status(spark, sf_dir):
    return status.finish(rules.classify(RULES, _items(spark, sf_dir)), SETTINGS).select("file_id", "family", "final_status", "combined_confidence", "retention", "recommendation", "final_reason")


def report_view_rows(spark, sf_dir):
    return status.view_rows(_viewed(spark, sf_dir), settings=SETTINGS)


def report_views(spark, sf_dir):
    """Rows of each report view; views without rows are there with none."""
    names = spark.createDataFrame([(v,) for v in status.views(SETTINGS)], "view string")
    counts = report_view_rows(spark, sf_dir).groupBy("view").agg(F.count("*").alias("n"))
    return names.join(counts, "view", "left").select("view", F.coalesce("n", F.lit(0)).alias("n"))


def guarded_hits(spark, sf_dir):
    """Hits where what lies inside a guarded base is left alone."""
    h = rules.exploded(rules.score(RULES, _items(spark, sf_dir), guard=GUARD))
    return h.select("file_id", "h.source", "h.rule_id", "h.score")


def rule_examples(spark, sf_dir):
    return rules.rule_examples(rules.score(RULES, _items(spark, sf_dir)))


def types_in_order(spark, sf_dir):
    return summaries.ordered_counts(_items(spark, sf_dir), "mime_type", ORDER)


def coverage_rows(spark, sf_dir):
    return summaries.coverage_rows(_items(spark, sf_dir))


def quality_rows(spark, sf_dir):
    return summaries.quality_rows(_items(spark, sf_dir), rules.inside_base(F.col("full_path"), GUARD))


def folder_order(spark, sf_dir):
    """Folders with children, by their true depth and path, and the place that gives them."""
    stats = summaries.folder_stats(_items(spark, sf_dir))
    links = hierarchy.folder_links(table(spark, sf_dir, "inventory_items"), table(spark, sf_dir, "shared_drives"))
    tree = hierarchy.resolve_hierarchy(links, paths=True).where(F.col("full_path").isNotNull())
    placed = summaries.folders_in_order(stats, tree).withColumn("__at", F.struct("depth", "full_path", "parent"))
    return duplicates.number(placed, "__at", "place").select("place", "parent", "depth", "n_folders", "n_files")


def group_paths(spark, sf_dir):
    """Groups of equal texts with their first members."""
    texts = materialize(_texts(spark, sf_dir), "texts")
    return duplicates.group_paths(duplicates.members(texts, duplicates.content_key(), "EXACT"), texts, "name")


def folder_subtree(spark, sf_dir):
    """The three folders with most files, and all folders below them."""
    links = hierarchy.folder_links(table(spark, sf_dir, "inventory_items"), table(spark, sf_dir, "shared_drives"))
    tree = materialize(hierarchy.resolve_hierarchy(links, paths=True), "tree_paths")
    stats = summaries.folder_stats(_items(spark, sf_dir)).join(tree.where(F.col("full_path").isNotNull()).select(F.col("file_id").alias("parent")), "parent", "left_semi")
    roots = [r["parent"] for r in summaries.largest_folders(stats, 3).select("parent").collect()]
    return hierarchy.subtree(tree, roots).select("file_id", "root_id", "depth", "full_path")


def classified_flags(spark, sf_dir):
    """Class of each document by the sensitivity words in it, and confidences in their normal form."""
    flags = F.array_join(F.array_compact(F.array(*(F.when(text.entity("text", e) != "", F.lit(e)) for e in ("email", "phone", "long_number")))), ";")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "document_type").select("doc_id", flags.alias("flags"), "document_type")
    classes = [("personal_data", ("email", "phone")), ("financial", ("long_number",))]
    return docs.select("doc_id", "flags", status.class_of_flags(F.col("flags"), classes).alias("class"), status.normal_confidence(F.col("document_type")).alias("confidence"))


# ---- sources and sinks --------------------------------------------------------


def _scratch(spark, label):
    return forget_later(spark, f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}")


def _listing(spark, sf_dir):
    """The inventory as nested objects, as a listing has them."""
    t = table(spark, sf_dir, "inventory_items").where(F.col("file_id").isNotNull())
    person = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.lit("").alias("displayName"), F.col(c).alias("emailAddress")))
    return t.select(
        F.col("file_id").alias("id"), "name", F.col("mime_type").alias("mimeType"), F.col("size").cast("string").alias("size"), F.col("md5_checksum").alias("md5Checksum"), F.col("created_time").alias("createdTime"), F.col("modified_time").alias("modifiedTime"),
        F.col("drive_id").alias("driveId"), F.array_compact(F.array(person("owners"))).alias("owners"), person("last_modifying_user").alias("lastModifyingUser"), F.split("parents", ";").alias("parents"), "trashed", "starred", "shared",
        F.struct(F.col("starred").alias("canEdit"), F.lit(False).alias("canShare"), F.col("shared").alias("canDelete")).alias("capabilities"),
    )


_ITEM = ("file_id", "name", "mime_type", "object_kind", "extension", "size", "md5_checksum", "created_time", "modified_time", "owners", "last_modifying_user", "parents", "drive_id", "trashed", "starred", "shared", "permissions", "is_native")


def source_listing(spark, sf_dir):
    """Every listed object written as JSON lines, read back and flattened; trashed ones are left out at the source."""
    at = _scratch(spark, "listing")
    _listing(spark, sf_dir).write.json(at)
    return readers.to_items(readers.read_listing(spark, at)).select(*_ITEM)


def source_pages(spark, sf_dir):
    """The same through the paged source, whose filter on the drive is pushed down."""
    at = _scratch(spark, "pages")
    listing = _listing(spark, sf_dir).where(F.col("driveId").isNotNull())
    listing.coalesce(1).write.json(at)  # one file, as the source reads one in pages
    readers.register_listing(spark)
    one = next(f"{at}/{n}" for n in readers.names_in(spark, at) if n.endswith(".json"))
    paged = spark.read.format("paged_listing").option("path", one).option("pageSize", str(1 << 18)).load()
    return paged.where("trashed = false").groupBy("driveId").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"), F.sum(F.size("parents")).alias("n_parents")).withColumnRenamed("driveId", "drive_id")


def sink_registry(spark, sf_dir):
    """The current rows as CSV with translated headers and a byte order mark, read back, typed and joined to flags."""
    at = _scratch(spark, "registry")
    columns = ["file_id", "name", "size", "trashed", "department_suggestion"]
    sinks.write_csv(_items(spark, sf_dir), at, columns, {"department_suggestion": "Отдел"}, mark=True)
    registry = readers.typed_registry(readers.read_registry(spark, at), ("size",), ("trashed",))
    flags = table(spark, sf_dir, "corpus_rows", "file_id", "needs_review", "sieved_at").where(F.col("file_id").isNotNull()).select("file_id", F.struct("sieved_at", "needs_review").alias("seq"), "needs_review")
    return readers.with_flags(registry, flags).withColumnRenamed("Отдел", "department")


def sink_reports(spark, sf_dir):
    """A report table through markdown, JSON lines and a workbook, and the numbers read back from each."""
    counts = materialize(summaries.top_values(_items(spark, sf_dir), "extension", 20).orderBy(F.desc("n"), "value"), "report")
    at = _scratch(spark, "reports")
    sinks.append_jsonl(counts, f"{at}/log")
    sinks.append_jsonl(counts, f"{at}/log")
    sinks.write_text(spark, sinks.markdown_report("Kinds", ["one row a kind"], {"Extensions": counts}), f"{at}/report.md")
    sinks.write_workbook({"extensions": counts}, f"{at}/book.xlsx")
    logged = spark.read.json(f"{at}/log").groupBy("value").agg(F.count("*").alias("lines"), F.max("n").alias("n")).select(F.lit("jsonl").alias("sink"), "value", "n", "lines")
    cells = F.split(F.regexp_replace("value", r"^\| | \|$", ""), r" \| ")
    md = spark.read.text(f"{at}/report.md").where(F.col("value").rlike(r"^\| .* \| \d+ \|$")).select(F.lit("markdown").alias("sink"), cells[0].alias("value"), cells[1].cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("lines"))
    book = spark.read.format("binaryFile").load(f"{at}/book.xlsx").select(F.lit("b").alias("file_id"), F.lit("xlsx").alias("extension"), F.lit("").alias("mime_type"), "content")
    rows = extract.extract(book).select(F.explode(F.slice(F.split("text", "\n"), 2, 1_000_000)).alias("r"))
    xlsx = rows.select(F.lit("workbook").alias("sink"), F.split("r", r" \| ")[0].alias("value"), F.split("r", r" \| ")[1].cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("lines"))
    return logged.unionByName(md).unionByName(xlsx)


KINDS = ("txt", "html", "rtf", "csv", "docx", "pptx", "xlsx")


def as_file(kind: str, body: str) -> bytes:
    """A small file of a kind that holds a text of letters, digits, punctuation and spaces."""
    if kind == "txt":
        return b"\xef\xbb\xbf" + body.encode()
    if kind == "html":
        return f"<html><head><style>p {{x}}</style></head><!-- c --><p>{escape(body)}</p><script>var a;</script></html>".encode()
    if kind == "rtf":
        plain = "".join(f"\\{c}" if c in "\\{}" else c if " " <= c <= "~" else "".join(f"\\u{int.from_bytes(u, 'little', signed=True)}?" for u in (c.encode("utf-16-le")[i : i + 2] for i in range(0, len(c.encode("utf-16-le")), 2))) for c in body)
        return (r"{\rtf1\ansi\ansicpg1251{\fonttbl{\f0 Arial;}}{\*\generator none;}\f0 " + plain + r"\par}").encode("ascii")
    if kind == "csv":
        return ('"' + body.replace('"', '""') + '"\n').encode()
    parts = {
        "docx": {"word/document.xml": f"<w:d xmlns:w='u'><w:t>{escape(body)}</w:t></w:d>", "word/styles.xml": "<s><t>no text</t></s>"},
        "pptx": {"ppt/slides/slide1.xml": f"<a:s xmlns:a='u'><a:t>{escape(body)}</a:t></a:s>"},
        "xlsx": {"xl/sharedStrings.xml": f"<s><si><t xml:space='preserve'>{escape(body)}</t></si></s>", "xl/worksheets/sheet1.xml": "<w><row><c t='s'><v>0</v></c></row></w>"},
    }[kind]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, xml in parts.items():
            z.writestr(name, xml)
    return out.getvalue()


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, bodies = b.column(0).to_pylist(), b.column(1).to_pylist()
        for kind in KINDS:
            yield pa.RecordBatch.from_arrays([pa.array([f"{i}.{kind}" for i in ids]), pa.array([kind] * len(ids)), pa.array([as_file(kind, x) for x in bodies], pa.binary())], ["file_id", "extension", "content"])


def extracted_files(spark, sf_dir):
    """Every document as a file of each kind, and its text read back: whole, so that all kinds have one hash."""
    ship(spark)
    body = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}\p{Nd}\p{P} ]", " "), " +", " "))
    files = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), body.alias("body")).mapInArrow(_encode, "file_id string, extension string, content binary").withColumn("mime_type", F.lit(""))
    read = extract.extract(readers.content_hashes(files).drop("content_hash", "export_hash")).withColumn("text", text.normalize_spaces("text"))
    return extract.describe(read).select("file_id", "status", "content_length", "content_text_hash")


QUERIES = {
    f.__name__: f
    for f in (
        corpus_row, canonical_map, dedup_actions, sieve_manifest, sieve_lists, sieve_summary, sieve_metrics, final_status, report_view_rows, report_views, guarded_hits, rule_examples, types_in_order, coverage_rows, quality_rows, folder_order, group_paths, folder_subtree,
        classified_flags, source_listing, source_pages, sink_registry, sink_reports, extracted_files,
    )
}

# ---- SQL ---------------------------------------------------------------------


def _any_sql(c: str, parts: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({c}, {_q(p.lower())})" for p in parts) + ")"


def _in(c: str, values: tuple[str, ...]) -> str:
    return f"{c} in ({', '.join(map(_q, values))})" if values else "false"


def _corpus_sql() -> str:
    known = [KNOWN_SQL.format(c) for c in ("object_suggestion", "department_suggestion", "document_type_suggestion")]
    path, name = "lower(full_path)", "lower(name)"
    score = f"""(cast({_any_sql(path, sieve.FINAL_WORDS)} or {_any_sql(name, sieve.FINAL_WORDS)} as int), cast(not {_any_sql(path, sieve.PASSING_PATHS)} as int), {" + ".join(f"cast({k} as int)" for k in known)},
      cast(not {_any_sql(name, sieve.DULL_NAMES)} as int), coalesce(try_cast(size as bigint), 0), modified_time, {name})"""
    flat = "lower(concat_ws(' ', sensitivity_suggestion, cleanup_category, '', document_type_suggestion, department_suggestion, ''))"
    held = f"({_in('sensitivity_suggestion', SIEVE.hold_values)} or {_in('cleanup_category', SIEVE.hold_values)})"
    hold = f"case when {_any_sql(flat, SIEVE.staff_words)} then 'CORPUS_HOLD_HR' when {_in('cleanup_category', SIEVE.legal_categories)} or contains({flat}, 'legal') or contains({flat}, 'contract') then 'CORPUS_HOLD_LEGAL' when {held} then 'CORPUS_HOLD_SENSITIVE' else '' end"
    twin = "gid is not null and file_id <> canon"
    arms = [
        (f"{twin} and hold <> ''", "hold", sieve.REASONS["corpus_exact_duplicate_hold"], "corpus_exact_duplicate_hold", "true", "false", "false", "high"),
        (twin, "'CORPUS_SUPPRESS_EXACT_DUPLICATE'", sieve.REASONS["corpus_exact_duplicate"], "corpus_exact_duplicate", "false", "false", "true", "high"),
        *((f"regexp_matches(name, {_q(r.pattern)})", _q(r.status), r.reason, r.rule_id, str(r.status.startswith("CORPUS_HOLD_")).lower(), "false", "true", "high") for r in SIEVE.name_rules),
        *((_in("ltrim(lower(extension), '.')", r.extensions), _q(r.status), r.reason, r.rule_id, str(r.status.startswith("CORPUS_HOLD_") or r.status == "CORPUS_REVIEW_UNKNOWN_VALUE").lower(), "false", f"not {held}" if r.status.startswith("CORPUS_EXCLUDE_") else "false", "high") for r in SIEVE.extension_rules),
        ("cleanup_category = 'system_trash_candidate'", "'CORPUS_EXCLUDE_SYSTEM_TRASH'", sieve.REASONS["corpus_cleanup_system_trash"], "corpus_cleanup_system_trash", "false", "false", "true", "high"),
        (f"try_cast(size as bigint) <= {SIEVE.empty} or (try_cast(size as bigint) <= {SIEVE.near_empty} and lower(extension) in ('txt', 'csv', 'log'))", "'CORPUS_EXCLUDE_EMPTY'", sieve.REASONS["corpus_empty_or_near_empty"], "corpus_empty_or_near_empty", "false", "false", "true", "medium"),
        ("full_path = ''", "'CORPUS_REVIEW_UNKNOWN_VALUE'", sieve.REASONS["corpus_missing_path_review"], "corpus_missing_path_review", "true", "false", "false", "medium"),
        ("hold <> ''", "hold", sieve.REASONS["corpus_sensitive_hold"], "corpus_sensitive_hold", "true", "false", "false", "medium"),
        ("true", "'CORPUS_KEEP_CANONICAL'", "", "corpus_keep_default", "false", "true", "false", "medium"),
    ]
    pick = "case " + " ".join(f"when {c} then {i}" for i, (c, *_) in enumerate(arms)) + " end"
    col = lambda k, quote: "case arm " + " ".join(f"when {i} then {_q(a[k]) if quote else a[k]}" for i, a in enumerate(arms)) + " end"
    texts = {"name": "name", "mime_type": "mime_type", "extension": "extension", "size_bytes": "size", "created_time": "created_time", "modified_time": "modified_time", "path": "full_path", "content_hash": "ch", "object_hint": "object_suggestion", "department_hint": "department_suggestion", "document_type_hint": "document_type_suggestion", "sensitivity_hint": "sensitivity_suggestion", "lifecycle_hint": "lifecycle_status"}
    return f"""with
last as (select * from (select *, row_number() over (partition by file_id order by {", ".join(f"{c} desc nulls last" for c in _LAST)}) as k from corpus_rows where file_id is not null) where k = 1),
reg as (select file_id, sieved_at as listed_at, {", ".join(f"coalesce({c}, '') as {a}" for c, a in texts.items())}, '' as md5, case when trim(duplicate_group_id) <> '' then duplicate_group_id end as any_group,
    case when trim(duplicate_group_id) <> '' and trim(canonical_file_id) <> '' then duplicate_group_id end as named,
    case when lower(coalesce(name, '')) in ('thumbs.db', 'desktop.ini', '.ds_store') then 'system_trash_candidate' else '' end as cleanup_category from last),
keyed as (select *, case when ch <> '' then 'content:' || ch when md5 <> '' and size <> '' then 'md5:' || md5 || ':' || size else '' end as key, {score} as score from reg),
kept as (select named as g from keyed where named is not null group by 1 having count(*) > 1),
kbest as (select named as g, file_id as canon from (select named, file_id, row_number() over (partition by named order by score desc, listed_at, file_id) as k from keyed where named in (select g from kept)) where k = 1),
hashed as (select key, min((listed_at, file_id)) as first from keyed where key <> '' group by key having count(*) > 1 and not coalesce(bool_or(any_group in (select g from kept)), false)),
hbest as (select key, file_id as canon from (select key, file_id, row_number() over (partition by key order by score desc, listed_at, file_id) as k from keyed where key in (select key from hashed)) where k = 1),
hnum as (select h.key, b.canon, printf('EXACT-SIEVE-%05d', (select count(*) from kept) + row_number() over (order by h.first)) as g from hashed h join hbest b using (key)),
placed as (select k.*, coalesce(kb.g, hn.g) as gid, coalesce(kb.canon, hn.canon, k.file_id) as canon, {hold} as hold from keyed k left join kbest kb on kb.g = k.named left join hnum hn on hn.key = k.key),
arm as (select *, {pick} as arm from placed),
d as (select *, {col(1, False)} as st, {col(2, True)} as reason, {col(3, True)} as rule, {col(4, False)} as review, {col(5, False)} as content_safe, {col(6, False)} as gone, {col(7, True)} as conf from arm),
corpus as (select file_id, name, full_path as path, mime_type, extension, size as size_bytes, created_time, modified_time, key as content_hash, coalesce(gid, '') as duplicate_group_id, canon as canonical_file_id, cast(file_id = canon as varchar) as is_canonical, st as corpus_status,
  case when st = 'CORPUS_KEEP_CANONICAL' then '' else reason end as exclusion_reason, rule as sieve_rule_ids, object_suggestion as object_hint, department_suggestion as department_hint, document_type_suggestion as document_type_hint, sensitivity_suggestion as sensitivity_hint, lifecycle_status as lifecycle_hint,
  cast(review as varchar) as needs_review, case when review then reason else '' end as review_reason, cast(content_safe as varchar) as safe_for_content_processing, cast(gone as varchar) as safe_for_physical_delete_candidate, conf as confidence from d),
acts as (select *, case when is_canonical = 'true' then 'CANONICAL_KEEP' when corpus_status in ('CORPUS_HOLD_HR', 'CORPUS_HOLD_LEGAL', 'CORPUS_HOLD_SENSITIVE') then replace(corpus_status, 'CORPUS_', 'DEDUP_') when corpus_status = 'CORPUS_SUPPRESS_EXACT_DUPLICATE' then 'EXACT_DUPLICATE_DELETE_CANDIDATE' else 'EXACT_DUPLICATE_SUPPRESS_FROM_PROCESSING' end as dedup_action,
  case when is_canonical = 'true' then {_q(sieve.ACTION_REASONS["canonical"])} when corpus_status in ('CORPUS_HOLD_HR', 'CORPUS_HOLD_LEGAL', 'CORPUS_HOLD_SENSITIVE') then review_reason when corpus_status = 'CORPUS_SUPPRESS_EXACT_DUPLICATE' then {_q(sieve.ACTION_REASONS["twin"])}
    when exclusion_reason <> '' then exclusion_reason else {_q(sieve.ACTION_REASONS["other"])} end as reason from corpus where duplicate_group_id <> '')"""


def _metrics_sql() -> str:
    n = lambda c: f"count(*) filter (where {c})"
    cols = {
        "total_files_considered": "count(*)", "canonical_keep": n("corpus_status = 'CORPUS_KEEP_CANONICAL'"), "exact_duplicate_groups": "count(distinct nullif(duplicate_group_id, ''))",
        "exact_duplicate_files_suppressed": n("duplicate_group_id <> '' and is_canonical = 'false' and safe_for_content_processing = 'false'"), "excluded_files": n("starts_with(corpus_status, 'CORPUS_EXCLUDE_')"), "hold_files": n("starts_with(corpus_status, 'CORPUS_HOLD_')"),
        "review_queue": n("needs_review = 'true'"), "safe_for_content_processing": n("safe_for_content_processing = 'true'"), "estimated_processing_load_reduction_files": n("safe_for_content_processing <> 'true'"),
        "estimated_processing_load_reduction_percent": "coalesce(round(count(*) filter (where safe_for_content_processing <> 'true') / nullif(count(*), 0) * 100, 2), 0.0)", "system_trash_excluded": n("corpus_status = 'CORPUS_EXCLUDE_SYSTEM_TRASH'"),
        "temp_cache_excluded": n("corpus_status in ('CORPUS_EXCLUDE_TEMP', 'CORPUS_EXCLUDE_CACHE_PREVIEW')"), "installers_binaries_excluded": n("corpus_status in ('CORPUS_EXCLUDE_INSTALLER', 'CORPUS_EXCLUDE_APP_BINARY')"), "mail_archives_excluded": n("corpus_status = 'CORPUS_EXCLUDE_MAIL_ARCHIVE'"),
        "archive_containers_held": n("corpus_status = 'CORPUS_HOLD_ARCHIVE_CONTAINER'"), "errors": n("corpus_status = 'CORPUS_ERROR'"),
    }
    return "select " + ", ".join(f"{v} as {k}" for k, v in cols.items()) + " from corpus"


def _finish_sql() -> str:
    s = SETTINGS
    fam = "case document_type " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in s.families.items()) + " else family end"
    unk = lambda c: f"{c} in ('', 'unknown')"
    lost = " + ".join(f"cast({unk(c)} as int)" for c in s.core)
    known = " + ".join(f"cast(not {unk(c)} as int)" for c in s.known)
    keep = "case " + " ".join(f"when {_in(c, v)} then {_q(label)}" for label, c, v in s.retention) + " else 'standard_review' end"
    media, sensitive, system = f"({_in('family', s.media_families)} or not {unk('media')})", f"not {_in('sensitivity', s.neutral)}", _in("cleanup", s.system)
    named = "filename_confidence in ('medium', 'high')"
    told = ", ".join(f"case when not {unk(c)} then '{c}=' || {c} end" for c in s.told)
    return f"""{_votes_sql()},
srcs as (select file_id, string_agg(source, ',' order by source) as sources from (select distinct file_id, source from hits) group by 1),
joined as (select v.* exclude (family), {fam} as family, c.path_confidence, c.filename_confidence, c.extension_confidence, c.n_hits, s.sources, u.mime_type from voted v join conf c using (file_id) join cur u using (file_id) left join srcs s using (file_id)),
fin as (select *, case when not ({system}) and {lost} >= {s.least_unknown} then case when n_hits > 0 then 'needs_review' else 'unknown' end
    when {system} then 'system' when conflict_fields <> '' then 'conflict' when {sensitive} then 'sensitive' when path_confidence = 'high' then 'by_path' when filename_confidence = 'high' then 'by_name' when extension_confidence <> '' then 'by_extension_only' when {media} then 'media' when n_hits > 0 then 'weak' else 'unknown' end as final_status,
  case when conflict_fields <> '' then 'needs_review' when path_confidence = 'high' and {named} and {known} >= {s.least_known} then 'high' when path_confidence in ('medium', 'high') or {named} then 'medium' when extension_confidence <> '' then 'low' else 'unknown' end as combined_confidence,
  {keep} as retention, case when {sensitive} then 'SENSITIVE_REVIEW_REQUIRED' else 'REVIEW_REQUIRED' end as recommendation,
  case when n_hits > 0 then concat_ws('; ', {told}, 'sources=' || sources, case when conflict_fields <> '' then 'conflicts=' || conflict_fields end) else 'No confident metadata classification rule matched.' end as final_reason from joined)"""


def _views_sql() -> str:
    s = SETTINGS
    unk = lambda c: f"{c} in ('', 'unknown')"
    where = {
        "exact_duplicates": "kind = 'exact'", "version_duplicates": "kind = 'version_candidate'", "semantic_duplicates": "kind = 'semantic_candidate'", "classification_review": f"combined_confidence in ('low', 'medium') or {unk('document_type')}", "sensitivity_review": "recommendation = 'SENSITIVE_REVIEW_REQUIRED'",
        "cleanup_candidates": f"not {unk('cleanup')}", "system_files": _in("cleanup", s.system), "unknown": "final_status in ('unknown', 'needs_review') or combined_confidence in ('unknown', 'needs_review')", "not_classified": "final_status in ('unknown', 'needs_review')", "conflicts": "conflict_fields <> ''",
        "sensitive": f"not {_in('sensitivity', s.neutral)}", "media": f"{_in('family', s.media_families)} or not {unk('media')}", "archive": "lifecycle = 'archive'", "by_extension_only": "final_status = 'by_extension_only'", "native_documents": "starts_with(coalesce(mime_type, ''), 'application/vnd.google-apps.')",
    }
    return ", ".join(f"v_{v} as (select '{v}' as view, file_id from z where {c})" for v, c in where.items()) + ", rows_ as (" + " union all ".join(f"select * from v_{v}" for v in where) + "), names(view) as (values " + ", ".join(f"('{v}')" for v in where) + ")"


def _kinds_sql() -> str:
    from .reference_queries import _EXACT, _IDENT, _VERS

    return f"""files as (select * from cur where object_kind = 'file' and not trashed), {_EXACT}, {_VERS}, {_IDENT},
      u as (select file_id, 'exact' as kind, 0 as r from me union all select file_id, 'semantic_candidate', 1 from ms union all select file_id, 'version_candidate', 2 from mv),
      kinds as (select file_id, kind from (select *, row_number() over (partition by file_id order by r) as k from u) where k = 1),
      z as (select f.*, coalesce(k.kind, '') as kind from fin f left join kinds k using (file_id))"""


_CORPUS, _FIN = _corpus_sql(), _finish_sql()
_DIMS = ["corpus_status", "safe_for_content_processing", "safe_for_physical_delete_candidate", "sieve_rule_ids", "mime_type", "extension", "object_hint", "department_hint", "document_type_hint"]
_Q_DIMS = ["object_kind", "department_suggestion", "document_type_suggestion", "sensitivity_suggestion"]


def _dims(src: str, dims: list[str]) -> str:
    return " union all ".join(f"select {_q(d)} as dimension, case when trim(cast({d} as varchar)) <> '' then cast({d} as varchar) else '(empty)' end as value, count(*) as n from {src} group by 2" for d in dims)


def _quality_sql() -> str:
    from .reference_queries import _Q

    base = f"list_contains(list_transform(string_split(coalesce(full_path, ''), '/'), lambda s: {_norm('s')}), {_q(GUARD)})"
    inside = {"base_rows": "true", "base_files": "object_kind = 'file'", "base_folders": "object_kind = 'folder'", "base_unknown_department": "coalesce(department_suggestion, '') in ('', 'unknown')", "base_unknown_type": "coalesce(document_type_suggestion, '') in ('', 'unknown')"}
    parts = [f"select {_q(m)} as metric, count(*) filter (where {c}) as value, '' as notes from cur" for m, c in _Q.items()]
    parts += [f"select {_q(m)}, count(*) filter (where b and {c}), '' from based" for m, c in inside.items()]
    return f"with {_CUR}, based as (select *, {base} as b from cur), s as ({_dims('cur', _Q_DIMS)}) " + " union all ".join(parts) + " union all select 'by_' || dimension, n, value from s"


_OF_LISTING = f"""select file_id, coalesce(name, '') as name, coalesce(mime_type, '') as mime_type, case mime_type when 'application/vnd.google-apps.folder' then 'folder' when 'application/vnd.google-apps.spreadsheet' then 'skipped_sheet' else 'file' end as object_kind,
  {_ext("coalesce(name, '')", "mime_type")} as extension, size, coalesce(md5_checksum, '') as md5_checksum, coalesce(created_time, '') as created_time, coalesce(modified_time, '') as modified_time, coalesce(owners, '') as owners, coalesce(last_modifying_user, '') as last_modifying_user,
  coalesce(parents, '') as parents, coalesce(drive_id, '') as drive_id, coalesce(trashed, false) as trashed, coalesce(starred, false) as starred, coalesce(shared, false) as shared,
  concat_ws(';', case when starred then 'canEdit' end, case when shared then 'canDelete' end) as permissions, starts_with(coalesce(mime_type, ''), 'application/vnd.google-apps.') as is_native
  from inventory_items where file_id is not null and not coalesce(trashed, false)"""
_BODY = r"trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^\p{L}\p{Nd}\p{P} ]', ' ', 'g'), ' +', ' ', 'g'))"
_E = text.ENTITIES
_FLAGS = "concat_ws(';', " + ", ".join(f"case when coalesce(regexp_extract(text, {_q(_E[e][0])}, {_E[e][1]}), '') <> '' then '{e}' end" for e in ("email", "phone", "long_number")) + ")"

SQL = {
    "corpus_row": f"{_CORPUS} select * from corpus",
    "canonical_map": f"{_CORPUS} select duplicate_group_id, file_id, canonical_file_id, is_canonical, name, path, content_hash, dedup_action, reason as dedup_reason from acts",
    "dedup_actions": f"{_CORPUS} select duplicate_group_id, file_id, canonical_file_id, dedup_action, 'true' as dry_run_only, safe_for_physical_delete_candidate, reason from acts",
    "sieve_manifest": f"{_CORPUS} select file_id, name, corpus_status, canonical_file_id, true as dry_run_only, safe_for_content_processing, safe_for_physical_delete_candidate, case when exclusion_reason <> '' then exclusion_reason else review_reason end as reason from corpus",
    "sieve_lists": f"""{_CORPUS} select 'keep_canonical' as list, file_id, corpus_status from corpus where corpus_status = 'CORPUS_KEEP_CANONICAL'
      union all select 'excluded', file_id, corpus_status from corpus where starts_with(corpus_status, 'CORPUS_EXCLUDE_') or corpus_status = 'CORPUS_SUPPRESS_EXACT_DUPLICATE'
      union all select 'review_queue', file_id, corpus_status from corpus where needs_review = 'true' or starts_with(corpus_status, 'CORPUS_HOLD_') or corpus_status = 'CORPUS_REVIEW_UNKNOWN_VALUE'""",
    "sieve_summary": f"{_CORPUS} {_dims('corpus', _DIMS)}",
    "sieve_metrics": f"{_CORPUS} {_metrics_sql()}",
    "final_status": f"{_FIN} select file_id, family, final_status, combined_confidence, retention, recommendation, final_reason from fin",
    "report_view_rows": f"{_FIN}, {_kinds_sql()}, {_views_sql()} select * from rows_",
    "report_views": f"{_FIN}, {_kinds_sql()}, {_views_sql()} select n.view, count(r.file_id) as n from names n left join rows_ r using (view) group by 1",
    "guarded_hits": f"{_hits_cte(GUARD)} select file_id, source, rule_id, score from hits",
    "rule_examples": f"""{_hits_cte()}, p as (select distinct h.source, h.rule_id, coalesce(c.full_path, '') as p from hits h join cur c using (file_id)), k as (select *, row_number() over (partition by source, rule_id order by p) as k from p)
      select source, rule_id, string_agg(p, ' | ' order by k) as examples from k where k <= 3 group by 1, 2""",
    "types_in_order": f"""with {_CUR}, c as (select case when trim(mime_type) <> '' then mime_type else '(empty)' end as value, count(*) as n, min((listed_at, file_id)) as first from cur group by 1)
      select value, n, cast(row_number() over (order by n desc, first) as int) as place from c""",
    "coverage_rows": f"""with {_CUR} select 'objects' as metric, count(*) as value, '' as notes from cur union all select 'files', count(*) filter (where object_kind = 'file'), '' from cur union all select 'folders', count(*) filter (where object_kind = 'folder'), '' from cur
      union all select 'unmapped_parents', count(*) filter (where starts_with(full_path, '/Unmapped parent')), '' from cur union all select 'objects_by_drive', count(*), coalesce(drive_id, '') from cur group by 3
      union all select 'content_status', count(*), case when object_kind is distinct from 'file' then 'not_attempted' when content_extracted then 'extracted' else 'not_extracted' end from cur group by 3""",
    "quality_rows": _quality_sql(),
    "folder_order": f"""{_TREE.replace(_CURRENT, _CURRENT.rstrip() + ", " + _CUR.replace("cur as (", "whole as (", 1))}, {_KIDS.replace("from cur)", "from whole)")},
      st as (select parent, count(*) filter (where object_kind = 'folder') as n_folders, count(*) filter (where object_kind = 'file') as n_files from kids group by 1)
      select cast(row_number() over (order by t.depth, t.full_path, st.parent) as int) as place, st.parent, cast(t.depth as int) as depth, n_folders, n_files from st join t on t.file_id = st.parent""",
    "group_paths": f"""with {_TEXTS}, {_EXACT}, p as (select m.group_id, f.name, f.listed_at, row_number() over (partition by m.group_id order by f.listed_at, f.file_id) as k from me m join files f using (file_id))
      select group_id, count(*) as n_files, string_agg(coalesce(name, ''), ' | ' order by k) filter (where k <= 5) as paths from p group by 1""",
    "folder_subtree": f"""{_TREE.replace(_CURRENT, _CURRENT.rstrip() + ", " + _CUR.replace("cur as (", "whole as (", 1))}, {_KIDS.replace("from cur)", "from whole)")},
      top as (select parent from kids where parent in (select file_id from t) group by 1 order by count(*) filter (where object_kind = 'file') desc, parent limit 3)
      select file_id, root as root_id, cast(depth as int) as depth, full_path from t where file_id in (select parent from top) or file_id in (select a.file_id from a where a.anc in (select parent from top))""",
    "classified_flags": f"""with f as (select doc_id, {_FLAGS} as flags, document_type from documents)
      select doc_id, flags, case when contains(flags, 'email') or contains(flags, 'phone') then 'personal_data' when contains(flags, 'long_number') then 'financial' else 'unknown' end as class,
        case when document_type in ('high', 'medium', 'low', 'needs_review') then document_type when coalesce(document_type, '') in ('', 'unknown') then 'unknown' else 'medium' end as confidence from f""",
    "source_listing": _OF_LISTING,
    "source_pages": "select drive_id, count(*) as n, count(distinct file_id) as n_ids, cast(sum(len(string_split(parents, ';'))) as bigint) as n_parents from inventory_items where file_id is not null and drive_id is not null and not coalesce(trashed, false) group by 1",
    "sink_registry": f"""with {_CUR}, f as (select file_id, needs_review from (select file_id, needs_review, row_number() over (partition by file_id order by sieved_at desc nulls last, needs_review desc nulls last) as k from corpus_rows where file_id is not null) where k = 1)
      select c.file_id, coalesce(c.name, '') as name, coalesce(c.size, 0) as size, c.trashed, coalesce(c.department_suggestion, '') as department, coalesce(f.needs_review, '') as needs_review from cur c left join f using (file_id)""",
    "sink_reports": f"""with {_CUR}, t as (select case when trim(extension) <> '' then extension else '(empty)' end as value, count(*) as n from cur group by 1 order by n desc, value limit 20)
      select 'jsonl' as sink, value, n, 2 as lines from t union all select 'markdown', value, n, 1 from t union all select 'workbook', value, n, 1 from t""",
    "extracted_files": f"""with b as (select doc_id, {_BODY} as body from documents), k(kind) as (values {", ".join(f"('{k}')" for k in KINDS)})
      select doc_id || '.' || kind as file_id, 'extracted' as status, length(body) as content_length, case when body <> '' then sha256(body) else '' end as content_text_hash from b join k on true""",
}
