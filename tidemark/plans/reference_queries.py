"""Registered queries of the inventory operators, with their SQL."""

from __future__ import annotations

import dataclasses
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.common import table
from ..operators import content, duplicates, hierarchy, rules, sieve, summaries
from ..operators.references import current_rows
from ..packs import DEFAULT
from ..session import materialize
from ..streaming import listing_stream

COLUMNS = ("name", "mime_type", "object_kind", "extension", "size", "md5_checksum", "modified_time", "parents", "full_path", "drive_id", "department_suggestion", "document_type_suggestion", "sensitivity_suggestion", "content_extracted", "content_text_hash")
RULES = rules.usable(DEFAULT)
SEED, SAMPLE, CAP, TOP = 7, 5, 500, 20


def _items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "inventory_items", "file_id", "trashed", "listed_at", *COLUMNS), *COLUMNS)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.eligible(_items(spark, sf_dir))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def name_forms(spark, sf_dir):
    names = table(spark, sf_dir, "inventory_items", "name", "mime_type").distinct()
    return names.select("name", "mime_type", text.normalize_name("name").alias("norm"), text.strip_version_markers("name").alias("base"), text.split_extension("name", "mime_type").alias("ext"))


def name_features(spark, sf_dir):
    names = table(spark, sf_dir, "inventory_items", "name").distinct().withColumn("norm", text.normalize_name(F.coalesce("name", F.lit(""))))
    return names.select("name", *(F.array_join(c, ",").alias(f) for f, c in text.name_features("norm").items()), F.size(text.words("norm")).alias("n_words"))


def name_entities(spark, sf_dir):
    """What the path and name of each object tell."""
    place = _items(spark, sf_dir).select("file_id", F.concat_ws(" ", F.coalesce("full_path", F.lit("")), F.coalesce("name", F.lit(""))).alias("place"))
    return place.select("file_id", *(text.entity("place", e, table=text.NAME_ENTITIES).alias(f"{e}_detected") for e in text.NAME_ENTITIES))


def entities(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *(text.entity("text", e).alias(f"{e}_detected") for e in text.ENTITIES))


def text_profile(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.text_hash("text").alias("hash"), F.coalesce(F.length("text"), F.lit(0)).alias("n"), text.guess_language("text").alias("language"), F.length(text.normalize_spaces(F.coalesce("text", F.lit("")))).alias("n_compact"))


def markup_text(spark, sf_dir):
    page = F.concat(F.lit("<html><style>p {x}</style><h1>"), F.coalesce("title", F.lit("")), F.lit("</h1><p>"), F.coalesce("text", F.lit("")), F.lit("</p>&amp;&nbsp;<script>var a;</script></html>"))
    return table(spark, sf_dir, "documents", "doc_id", "title", "text").select("doc_id", F.sha2(text.strip_markup(page), 256).alias("hash"))


def path_forms(spark, sf_dir):
    return _items(spark, sf_dir).select("file_id", text.path_depth("full_path").alias("depth"), text.sanitize_path("full_path").alias("short_path"))


def rule_hits(spark, sf_dir):
    h = rules.exploded(rules.score(RULES, _items(spark, sf_dir)))
    return h.select("file_id", "h.source", "h.rule_id", "h.score")


def rule_vote(spark, sf_dir):
    return rules.vote(RULES, rules.score(RULES, _items(spark, sf_dir))).select("file_id", *sorted(rules.fields_of(RULES)), F.array_join("conflict_fields", ";").alias("conflict_fields"))


def rule_status(spark, sf_dir):
    return rules.classify(RULES, _items(spark, sf_dir)).select("file_id", "path_confidence", "filename_confidence", "extension_confidence", "status", "evidence")


def rule_match_summary(spark, sf_dir):
    return rules.rule_matches(rules.score(RULES, _items(spark, sf_dir)))


def rule_performance(spark, sf_dir):
    return rules.rule_performance(spark, RULES, rules.score(RULES, _items(spark, sf_dir)))


#: The pack with changes to be noticed: a weight, words added and taken away, a pattern and a kind.
CHANGED = {
    "name_draft": {"weight": 6},
    "name_final": {"tokens": ("final", "финал")},
    "path_archive": {"patterns": (r"архив",)},
    "ext_text": {"extensions": ("docx", "pdf")},
    "sens_guest": {"tokens": ("guest", "гость")},
}
PLANTED = [dataclasses.replace(r, **CHANGED.get(r.rule_id, {})) for r in RULES]


def rule_strategies(spark, sf_dir):
    """The compiled pack against a full scan of all its rules, which agree, and of a changed pack, which differ in the changes."""
    items = materialize(_items(spark, sf_dir), "items")
    same, other = rules.compare_strategies(RULES, items), rules.compare_strategies(RULES, items, PLANTED)
    return same.withColumn("pack", F.lit("same")).unionByName(other.withColumn("pack", F.lit("changed")))


def rule_validation(spark, sf_dir):
    return spark.createDataFrame(rules.validate(DEFAULT) or [], "level string, rule_id string, message string")


def content_matches(spark, sf_dir):
    m = rules.exploded(content.match_content(_docs(spark, sf_dir)), "matches", "doc_id")
    return m.select("doc_id", "h.rule_id", "h.n", "h.score")


def content_vote(spark, sf_dir):
    return content.content_vote(content.match_content(_docs(spark, sf_dir))).drop("matches")


def content_conflicts(spark, sf_dir):
    voted = content.content_vote(content.match_content(_docs(spark, sf_dir))).join(table(spark, sf_dir, "documents", "doc_id", "document_type"), "doc_id")
    return content.merge_with_metadata(voted, "document_type", F.lower(F.trim("document_type"))).select("doc_id", "merged", "content_conflict")


def _texts(spark, sf_dir):
    """The documents as files, in order of their ids, with the hash of their text; null texts have none."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "title", "n_chars", "modified_time")
    return d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file_id"), F.col("doc_id").alias("listed_at"), F.col("title").alias("name"), F.col("n_chars").alias("size"), "modified_time", F.lit("").alias("md5_checksum"), F.sha2("text", 256).alias("content_text_hash"))


def exact_groups(spark, sf_dir):
    return duplicates.groups(_texts(spark, sf_dir), duplicates.content_key(), "EXACT").drop("key")


def exact_members(spark, sf_dir):
    return duplicates.members(_texts(spark, sf_dir), duplicates.content_key(), "EXACT")


def version_groups(spark, sf_dir):
    return duplicates.groups(_files(spark, sf_dir), duplicates.version_key(), "VERSION").drop("key")


def identifier_groups(spark, sf_dir):
    return duplicates.groups(_files(spark, sf_dir), duplicates.identifier_key(), "SEMANTIC").drop("key")


def duplicate_kinds(spark, sf_dir):
    return duplicates.all_duplicates(_files(spark, sf_dir))


def _sieved(spark, sf_dir):
    items = _items(spark, sf_dir).where(F.col("object_kind") != "folder")
    twins = duplicates.members(_files(spark, sf_dir), duplicates.stable_key(), "EXACT-SIEVE").select("file_id", F.col("is_canonical"))
    rows = items.join(twins, "file_id", "left")
    low = F.lower(F.coalesce("name", F.lit("")))
    return sieve.decide(
        rows,
        [
            sieve.Decision("SUPPRESS_EXACT_DUPLICATE", "copy of the canonical file", ~F.col("is_canonical")),
            sieve.Decision("EXCLUDE_SYSTEM", "system file", low.isin("thumbs.db", "desktop.ini", ".ds_store")),
            sieve.Decision("EXCLUDE_KIND", "kind without text", F.lower(F.coalesce("extension", F.lit(""))).isin("zip", "mp4", "db")),
            sieve.Decision("EXCLUDE_TRASHED", "in the trash", F.col("trashed")),
            sieve.Decision("EXCLUDE_NEAR_EMPTY", "hardly any content", sieve.near_empty(F.col("size"), F.col("extension"))),
            sieve.Decision("REVIEW_NO_PATH", "no path", F.trim(F.coalesce("full_path", F.lit(""))) == ""),
            sieve.Decision("HOLD_SENSITIVE", "sensitive", sieve.known(F.col("sensitivity_suggestion")) & ~F.col("sensitivity_suggestion").isin("public_internal", "operational")),
        ],
        ("KEEP_CANONICAL", "no rule applies"),
    )


def sieve_status(spark, sf_dir):
    return _sieved(spark, sf_dir).select("file_id", "status", "reason")


def sieve_actions(spark, sf_dir):
    return sieve.action_list(_sieved(spark, sf_dir))


def top_types(spark, sf_dir):
    return summaries.top_values(_items(spark, sf_dir), "mime_type", TOP)


def size_percentiles(spark, sf_dir):
    return summaries.percentiles(_items(spark, sf_dir), "extension", "size")


def folder_children(spark, sf_dir):
    return hierarchy.children(_items(spark, sf_dir))


def event_sessions(spark, sf_dir):
    """Sessions of users with gaps below half an hour."""
    s = listing_stream.sessions(table(spark, sf_dir, "events"), "ts", "user_id")
    return s.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


def summary_by_dimension(spark, sf_dir):
    return summaries.summary(_items(spark, sf_dir), "object_kind", "department_suggestion", "document_type_suggestion", "sensitivity_suggestion", "drive_id")


def dimension_cube(spark, sf_dir):
    c = summaries.cube(_items(spark, sf_dir).select("object_kind", F.coalesce("sensitivity_suggestion", F.lit("(none)")).alias("sensitivity")), "object_kind", "sensitivity")
    return c.select("object_kind", "sensitivity", F.col("grouping_set").cast("int").alias("grouping_set"), "n")


def quality_summary(spark, sf_dir):
    return summaries.quality(_items(spark, sf_dir))


def access_coverage(spark, sf_dir):
    return summaries.coverage(_items(spark, sf_dir))


def folder_stats(spark, sf_dir):
    return summaries.folder_stats(_items(spark, sf_dir), duplicates.members(_files(spark, sf_dir), duplicates.content_key(), "EXACT"))


def largest_folders(spark, sf_dir):
    return summaries.largest_folders(summaries.folder_stats(_items(spark, sf_dir)), TOP).select("parent", "n_folders", "n_files")


def content_cap(spark, sf_dir):
    rows = _items(spark, sf_dir).select("file_id", "listed_at", "object_kind")
    return summaries.first_within(rows, ["listed_at", "file_id"], CAP, F.col("object_kind") == "file").select("file_id", "admitted")


def sample_plan(spark, sf_dir):
    return summaries.stratified_sample(_files(spark, sf_dir).select("file_id", F.coalesce("extension", F.lit("")).alias("extension")), "extension", "file_id", SAMPLE, SEED)


RATES = [("pdf", 100_000, 1, 0.5), ("docx", 50_000, 0, 0.25), ("png", 1_000_000, 2, 1.5)]


def unit_rates(spark, sf_dir):
    usage = _files(spark, sf_dir).select(F.coalesce("department_suggestion", F.lit("")).alias("department"), F.coalesce("extension", F.lit("")).alias("kind"), F.coalesce("size", F.lit(0)).alias("units"))
    rates = spark.createDataFrame(RATES, "kind string, unit_size bigint, free_units bigint, rate double")
    out = summaries.rate_rollup(usage, rates, "department")
    return out.select("department", "kind", "n", "units", F.round("cost", 4).alias("cost"))


def events_by_hour(spark, sf_dir):
    return listing_stream.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type").select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n")


def listing_table(spark, sf_dir):
    """Flat rows of every listed object, with the extension taken anew from the name."""
    t = table(spark, sf_dir, "inventory_items", "file_id", "name", "mime_type", "size", "owners", "starred")
    return t.select("file_id", text.split_extension("name", "mime_type").alias("extension"), F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("starred", F.lit(False)).alias("starred"), text.entity("owners", "email").alias("owner_email"))


QUERIES = {
    f.__name__: f
    for f in (
        name_forms, name_features, name_entities, entities, text_profile, markup_text, path_forms, listing_table, rule_hits, rule_vote, rule_status, rule_match_summary, rule_performance, rule_strategies, rule_validation,
        content_matches, content_vote, content_conflicts, exact_groups, exact_members, version_groups, identifier_groups, duplicate_kinds, sieve_status, sieve_actions,
        top_types, size_percentiles, folder_children, event_sessions, summary_by_dimension, dimension_cube, quality_summary, access_coverage, folder_stats, largest_folders, content_cap, sample_plan, unit_rates, events_by_hour,
    )
}

# ---- SQL -------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_ORDER = ", ".join(f"{c} desc nulls last" for c in COLUMNS)
_CUR = f"""cur as (select * exclude (k, trashed), coalesce(trashed, false) as trashed from (select file_id, trashed, listed_at, {", ".join(COLUMNS)},
    min(listed_at) over (partition by file_id) as first_listed,
    row_number() over (partition by file_id order by listed_at desc nulls last, coalesce(trashed, false), {_ORDER}) as k from inventory_items where file_id is not null) where k = 1)"""
_FILES = f"{_CUR}, files as (select * from cur where object_kind = 'file' and not trashed)"
_WS = r"[\s\x0B\x{85}\p{Z}]"


def _compat() -> tuple[str, str]:
    """Characters of the basic plane whose NFKC form is one other character, and those forms; by rule from Unicode."""
    pairs = [(chr(i), unicodedata.normalize("NFKC", chr(i))) for i in range(0x80, 0x10000) if not 0xD800 <= i < 0xE000]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1 and ord(b) < 0x10000 and not 0x1100 <= ord(a) < 0x1200]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _expansions() -> list[tuple[str, str]]:
    """Ligatures, signs, Roman numerals and units, with their NFKC forms of several characters."""
    blocks = ((0x2000, 0x2200), (0xFB00, 0xFB07), (0x1C4, 0x1F4), (0xBC, 0xBF), (0x3371, 0x33E0))
    forms = [(chr(i), unicodedata.normalize("NFKC", chr(i))) for a, b in blocks for i in range(a, b)]
    return [(a, b) for a, b in forms if len(b) > 1]


def _replaced(x: str) -> str:
    x = f"translate({x}, {_q(_compat()[0])}, {_q(_compat()[1])})"
    for a, b in _expansions():
        x = f"replace({x}, {_q(a)}, {_q(b)})"
    return f"nfc_normalize({x})"


def _spaces(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def _norm(x: str) -> str:
    return rf"trim(regexp_replace(replace(lower({_replaced(_spaces(x))}), 'ё', 'е'), '[\s\x0B\x{{85}}\p{{Z}}_\-]+', ' ', 'g'))"


def _base(x: str) -> str:
    """Marker words are cut out word by word, as this dialect cannot look around."""
    words = "|".join(text.VERSION_WORDS)
    x = rf"regexp_replace({_norm(x)}, '\(\s*(?:{words})\s*\)', ' ', 'g')"
    # each pass replaces every other of adjacent markers, so two passes replace all; the marks around stay
    mark = rf"(^|[^\p{{L}}\p{{N}}_])(?:{words}|(?:v|ver|rev) ?[\p{{Nd}}]+)($|[^\p{{L}}\p{{N}}_])"
    for _ in range(2):
        x = rf"regexp_replace({x}, '{mark}', '\1 \2', 'g')"
    x = rf"regexp_replace({x}, '\([\p{{Nd}}]+\)', ' ', 'g')"
    date = rf"(^|[^\p{{Nd}}]){text.date_pattern()}($|[^\p{{Nd}}])"
    x = rf"regexp_replace({x}, '{date}', '\1 \2', 'g')"
    return _spaces(x)


def _ext(name: str, mime: str | None = None) -> str:
    e = rf"lower(regexp_extract({_spaces(name)}, '^.*[^./\\]\.([^./\\\s]+)$', 1))"
    out = f"case when length({e}) <= 12 then {e} else '' end"
    return f"coalesce(case when starts_with(coalesce({mime}, ''), 'application/vnd.google-apps.') then '' else {out} end, '')" if mime else f"coalesce({out}, '')"


def _token_sql(t: str, norm: str) -> str:
    t = t.lower()
    if t.replace("_", "").isalnum():
        return rf"regexp_matches({norm}, '(^|[^\p{{L}}\p{{N}}_]){t}($|[^\p{{L}}\p{{N}}_])')"
    return f"contains(' ' || {norm} || ' ', {_q(t)})"


def _text_sql(r: rules.Rule, norm: str, raw: str) -> str:
    bs = lambda p: p.replace(r"\b", r"\b")
    veto = [f"contains(' ' || {norm} || ' ', {_q(t.lower())})" for t in r.negative_tokens] + [f"regexp_matches({raw}, {_q('(?i)' + bs(p))})" for p in r.negative_patterns]
    hit = [_token_sql(t, norm) for t in r.tokens] + [f"regexp_matches({raw}, {_q('(?i)' + bs(p))})" for p in r.patterns]
    return f"(not ({' or '.join(veto) or 'false'}) and ({' or '.join(hit) or 'false'}))"


def _kind_sql(r: rules.Rule) -> str:
    return "(" + (" or ".join([f"ext in ({', '.join(map(_q, r.extensions))})"] * bool(r.extensions) + [f"starts_with(mime, {_q(p)})" for p in r.mime_prefixes]) or "false") + ")"


def _hits_sql(pack: list[rules.Rule] | None = None) -> str:
    parts = []
    for i, r in enumerate(x for s in rules.SOURCES for x in (RULES if pack is None else pack) if x.source == s):
        head = f"select {i} as ord, file_id, {_q(r.source)} as source, {_q(r.rule_id)} as rule_id"
        if r.source == "path":
            parts.append(f"""{head}, cast(sum({r.weight} * (case when i <= 2 then 17 when i > n - 2 then 14 else 10 end)) as int) as score from segs
              where {_text_sql(r, "norm", "raw")} group by file_id""")
            continue
        wide = r.source in ("sensitivity", "media", "cleanup")
        t, k = _text_sql(r, "bnorm" if wide else "norm", "both_" if wide else "raw"), _kind_sql(r)
        on = f"{t} and {k}" if r.has_text and r.has_kind else k if r.has_kind else t
        parts.append(f"{head}, {rules.FACTORS[r.source] * r.weight} as score from base where {on}")
    return " union all ".join(parts)


def _hits_cte(guard: str | None = None) -> str:
    both = "coalesce(full_path, '') || ' ' || coalesce(name, '')"
    if guard is not None:
        both = f"case when file_id in (select file_id from guarded) then coalesce(name, '') else {both} end"
    below = "" if guard is None else f" where i <= coalesce((select min(g.i) from every g where g.file_id = every.file_id and g.norm = {_q(guard)}), n)"
    return f"""with {_CUR},
parts as (select file_id, list_filter(string_split(coalesce(full_path, ''), '/'), lambda s: s <> '') as p from cur),
flat as (select file_id, len(p) as n, unnest(p) as raw, generate_subscripts(p, 1) as i from parts),
every as (select file_id, n, i, raw, {_norm("raw")} as norm from flat),
guarded as (select distinct file_id from every where norm = {_q(guard or "")}),
segs as (select * from every{below}),
base as (select file_id, coalesce(name, '') as raw, {_norm("coalesce(name, '')")} as norm, {both} as both_, {_norm(both)} as bnorm, coalesce(lower(extension), '') as ext, coalesce(mime_type, '') as mime, full_path from cur),
hits as ({_hits_sql()})"""


_HITS = _hits_cte()


def _votes_sql() -> str:
    rows = [(f, v, r.rule_id, r.source) for f, vs in rules.fields_of(RULES).items() for v, ids in vs.items() for r in RULES if r.rule_id in ids]
    values = ", ".join(f"({_q(f)}, {_q(v)}, {_q(i)}, {_q(s)})" for f, v, i, s in rows)
    fields = sorted(rules.fields_of(RULES))
    return f"""{_HITS},
targets(field, value, rule_id, src) as (values {values}),
said as (select h.file_id, t.field, t.value, sum(h.score) as s, bool_or(t.src = 'path') as by_path, bool_or(t.src = 'filename') as by_name from hits h join targets t using (rule_id) group by 1, 2, 3),
best as (select file_id, field, value from (select *, row_number() over (partition by file_id, field order by s desc, value) as k from said) where k = 1),
clash as (select file_id, field from said group by 1, 2 having bool_or(by_path) and bool_or(by_name) and not bool_or(by_path and by_name)),
clashes as (select file_id, string_agg(field, ';' order by field) as conflict_fields from clash group by 1),
wide as (select file_id, {", ".join(f"max(value) filter (where field = {_q(f)}) as {f}" for f in fields)} from best group by 1),
voted as (select c.file_id, {", ".join(f"coalesce(w.{f}, 'unknown') as {f}" for f in fields)}, coalesce(x.conflict_fields, '') as conflict_fields
  from cur c left join wide w using (file_id) left join clashes x using (file_id)),
by_source as (select c.file_id, {", ".join(f"sum(score) filter (where source = {_q(s)}) as {s}_s" for s in ("path", "filename", "extension"))}, count(h.rule_id) as n_hits, coalesce(string_agg(rule_id, ';' order by ord), '') as evidence
  from cur c left join hits h using (file_id) group by 1),
conf as (select file_id, n_hits, evidence, {", ".join(f"case when {s}_s is null then '' when {s}_s >= {rules.HIGH} then 'high' when {s}_s >= {rules.MEDIUM} then 'medium' else 'low' end as {s}_confidence" for s in ("path", "filename", "extension"))} from by_source)"""


def _content_sql() -> str:
    parts = []
    for r in content.DEFAULT:
        n = " + ".join([f"cast(contains(norm, {_q(k)}) as int)" for k in r.keywords] + [f"len(regexp_extract_all(raw, {_q(p)}))" for p in r.patterns])
        veto = " or ".join(f"regexp_matches(norm, {_q(p)})" for p in r.negatives)
        parts.append(f"select doc_id, {_q(r.rule_id)} as rule_id, cast({f'case when {veto} then 0 else {n} end' if veto else n} as int) as n, {r.weight} as w from base")
    return f"with base as (select doc_id, coalesce(text, '') as raw, lower(coalesce(text, '')) as norm from documents), every as ({' union all '.join(parts)}), m as (select doc_id, rule_id, n, n * w as score from every where n > 0)"


def _content_vote_sql() -> str:
    values = ", ".join(f"({_q(r.rule_id)}, {_q(f)}, {_q(v)})" for r in content.DEFAULT for f, v in r.targets.items())
    flags = ", ".join(f"({_q(r.rule_id)}, {_q(x)})" for r in content.DEFAULT for x in r.flags)
    fields = sorted({f for r in content.DEFAULT for f in r.targets})
    return f"""{_content_sql()}, t(rule_id, field, value) as (values {values}), fl(rule_id, flag) as (values {flags}),
s as (select doc_id, field, value, sum(score) as s from m join t using (rule_id) group by 1, 2, 3),
b as (select doc_id, field, value from (select *, row_number() over (partition by doc_id, field order by s desc, value) as k from s) where k = 1),
v as (select d.doc_id, {", ".join(f"coalesce((select value from b where b.doc_id = d.doc_id and field = {_q(f)}), '') as content_{f}" for f in fields)},
  coalesce((select string_agg(flag, ';' order by flag) from (select distinct flag from m join fl using (rule_id) where m.doc_id = d.doc_id)), '') as content_flags,
  case when (select count(*) from m where m.doc_id = d.doc_id) >= 3 then 'high' when exists (select 1 from m where m.doc_id = d.doc_id) then 'medium' else '' end as content_confidence from documents d)"""


_MD5 = "case when coalesce(md5_checksum, '') <> '' then 'md5:' || md5_checksum || ':' || coalesce(cast(size as varchar), '') end"
_CH = "case when coalesce(content_text_hash, '') <> '' then 'hash:' || content_text_hash end"
_CONTENT_KEY, _STABLE_KEY = f"coalesce({_MD5}, {_CH})", f"coalesce({_CH}, {_MD5})"
_NAME_BASE = _base("regexp_replace(coalesce(name, ''), '\\.[^.]*$', '')")
_VERSION_KEY = f"case when {_NAME_BASE} <> '' then concat_ws(':', {_NAME_BASE}, case when coalesce(extension, '') <> '' then extension else coalesce(mime_type, '') end, coalesce(department_suggestion, ''), coalesce(document_type_suggestion, '')) end"
_IDS = r"list_sort(list_distinct(list_filter(regexp_extract_all(coalesce(name, ''), '\d+'), lambda x: length(x) = 6)))"
_YEARS = r"list_sort(list_distinct(list_filter(regexp_extract_all(coalesce(name, ''), '\d+'), lambda x: length(x) = 4 and (starts_with(x, '19') or starts_with(x, '20')))))"
_IDENT_KEY = f"case when len({_IDS}) > 0 then concat_ws('|', coalesce(department_suggestion, ''), coalesce(document_type_suggestion, ''), array_to_string({_IDS}, ','), array_to_string({_YEARS}, ',')) end"


def _group_sql(key: str, prefix: str, tag: str) -> str:
    return f"""k{tag} as (select *, {key} as key from files),
g{tag} as (select key, count(*) as n_rows, count(distinct file_id) as n_files, cast(sum(coalesce(size, 0)) as bigint) as total_size, min((listed_at, file_id)) as first from k{tag} where key is not null group by key having count(distinct file_id) >= 2),
r{tag} as (select key, file_id as canonical_id from (select key, file_id, row_number() over (partition by key order by coalesce(modified_time, '') desc, coalesce(size, 0) desc, lower(coalesce(name, '')) desc, listed_at, file_id) as k from k{tag}) where k = 1),
n{tag} as (select g.*, r.canonical_id, printf('{prefix}-%05d', row_number() over (order by g.first)) as group_id from g{tag} g join r{tag} r using (key)),
m{tag} as (select distinct f.file_id, n.group_id, f.file_id = n.canonical_id as is_canonical from k{tag} f join n{tag} n using (key))"""


_EXACT, _VERS, _IDENT, _SIEVE_TWINS = (_group_sql(k, p, t) for k, p, t in ((_CONTENT_KEY, "EXACT", "e"), (_VERSION_KEY, "VERSION", "v"), (_IDENT_KEY, "SEMANTIC", "s"), (_STABLE_KEY, "EXACT-SIEVE", "z")))
_TEXTS = "files as (select 'd' || doc_id as file_id, doc_id as listed_at, title as name, n_chars as size, modified_time, '' as md5_checksum, sha256(text) as content_text_hash from documents)"
_GROUP_COLS = "group_id, n_rows, n_files, total_size, canonical_id"
_KNOWN = "(lower(trim(coalesce({0}, ''))) <> ''" + "".join(f" and not contains(lower(trim(coalesce({{0}}, ''))), '{p}')" for p in sieve.UNKNOWN_PARTS) + ")"
_SIEVE = f"""with {_FILES}, {_SIEVE_TWINS},
d as (select c.*, z.is_canonical, case
    when not z.is_canonical then 'SUPPRESS_EXACT_DUPLICATE|copy of the canonical file'
    when lower(coalesce(name, '')) in ('thumbs.db', 'desktop.ini', '.ds_store') then 'EXCLUDE_SYSTEM|system file'
    when lower(coalesce(extension, '')) in ('zip', 'mp4', 'db') then 'EXCLUDE_KIND|kind without text'
    when trashed then 'EXCLUDE_TRASHED|in the trash'
    when size <= 16 or (size <= 64 and extension in ('txt', 'csv', 'log')) then 'EXCLUDE_NEAR_EMPTY|hardly any content'
    when trim(coalesce(full_path, '')) = '' then 'REVIEW_NO_PATH|no path'
    when {_KNOWN.format("sensitivity_suggestion")} and sensitivity_suggestion not in ('public_internal', 'operational') then 'HOLD_SENSITIVE|sensitive'
    else 'KEEP_CANONICAL|no rule applies' end as sr
  from cur c left join mz z using (file_id) where object_kind <> 'folder'),
s as (select *, split_part(sr, '|', 1) as status, split_part(sr, '|', 2) as reason from d)"""


def _summary_sql(src: str, dims: list[str]) -> str:
    return " union all ".join(f"select {_q(d)} as dimension, case when trim(cast({d} as varchar)) <> '' then cast({d} as varchar) else '(empty)' end as value, count(*) as n from {src} group by 2" for d in dims)


def _entity_sql(c: str = "text", table: dict | None = None) -> str:
    return ", ".join(f"coalesce(substring(regexp_extract({c}, {_q(p)}, {g}), 1, 120), '') as {e}_detected" for e, (p, g) in (text.ENTITIES if table is None else table).items())


_KIDS = f"""kids as (select * from (select file_id, object_kind, mime_type, sensitivity_suggestion, document_type_suggestion, unnest(string_split(parents, ';')) as parent from cur) where trim(parent) <> ''),
types as (select parent, coalesce(mime_type, '') as m, count(*) as n from kids where object_kind = 'file' group by parent, mime_type),
ranked as (select parent, count(*) as n_types, array_to_string(list_slice(list(m || ':' || n order by n desc, m), 1, 5), ';') as top_types from types group by parent)"""
_UNK = "lower(trim(coalesce({0}, '')))"
_Q = {
    "rows": "true", "files": "object_kind = 'file'", "folders": "object_kind = 'folder'", "trashed": "trashed", "no_parent": "coalesce(trim(parents), '') = ''", "no_path": "coalesce(trim(full_path), '') = ''",
    "no_checksum": "coalesce(trim(md5_checksum), '') = ''", "no_size": "size is null", "unknown_department": f"{_UNK.format('department_suggestion')} in ('', 'unknown')", "unknown_type": f"{_UNK.format('document_type_suggestion')} in ('', 'unknown')",
    "unknown_sensitivity": f"{_UNK.format('sensitivity_suggestion')} in ('', 'unknown')", "content_extracted": "content_extracted",
}
_DIMS = ["object_kind", "department_suggestion", "document_type_suggestion", "sensitivity_suggestion", "drive_id"]
_FEATURES = ", ".join(f"array_to_string(list_sort(list_distinct(regexp_extract_all(replace(norm, ' ', '  '), {_q(p)}, {g}))), ',') as {f}" for f, (p, g) in text.NAME_FEATURES.items())
_PAGE = "'<html><style>p {x}</style><h1>' || coalesce(title, '') || '</h1><p>' || coalesce(text, '') || '</p>&amp;&nbsp;<script>var a;</script></html>'"


def _markup_sql(x: str) -> str:
    x = rf"regexp_replace({x}, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {_q(a)}, {_q(b)})"
    return _spaces(x)


SQL = {
    "name_forms": f"select name, mime_type, {_norm('name')} as norm, {_base('name')} as base, {_ext('name', 'mime_type')} as ext from (select distinct name, mime_type from inventory_items)",
    "name_features": rf"select name, {_FEATURES}, len(regexp_extract_all(norm, '[\p{{L}}\p{{N}}_]+')) as n_words from (select name, {_norm("coalesce(name, '')")} as norm from (select distinct name from inventory_items))",
    "name_entities": f"with {_CUR}, p as (select file_id, coalesce(full_path, '') || ' ' || coalesce(name, '') as place from cur) select file_id, {_entity_sql('place', text.NAME_ENTITIES)} from p",
    "entities": f"select doc_id, {_entity_sql()} from documents",
    "text_profile": f"""select doc_id, sha256(coalesce(text, '')) as hash, coalesce(length(text), 0) as n,
      case when len(regexp_extract_all(coalesce(text, ''), '[А-Яа-яЁё]')) > len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]')) then 'ru' when regexp_matches(coalesce(text, ''), '[A-Za-z]') then 'en' else 'unknown' end as language,
      length({_spaces("coalesce(text, '')")}) as n_compact from documents""",
    "markup_text": f"select doc_id, sha256({_markup_sql(_PAGE)}) as hash from documents",
    "path_forms": f"""with {_CUR}, p as (select file_id, coalesce(full_path, '') as f, list_filter(string_split(coalesce(full_path, ''), '/'), lambda s: s <> '') as s from cur)
      select file_id, greatest(0, length(f) - length(replace(f, '/', '')) - 1) as depth, case when len(s) <= 2 then '/' || array_to_string(s, '/') else '/' || s[1] || '/.../' || s[len(s)] end as short_path from p""",
    "listing_table": f"select file_id, {_ext('name', 'mime_type')} as extension, coalesce(size, 0) as size, coalesce(starred, false) as starred, coalesce(substring(regexp_extract(owners, {_q(text.ENTITIES['email'][0])}), 1, 120), '') as owner_email from inventory_items",
    "rule_hits": f"{_HITS} select file_id, source, rule_id, score from hits",
    "rule_vote": f"{_votes_sql()} select * from voted",
    "rule_status": f"""{_votes_sql()} select c.file_id, path_confidence, filename_confidence, extension_confidence, evidence,
      case when v.conflict_fields <> '' then 'conflict' when path_confidence = 'high' then 'by_path' when filename_confidence = 'high' then 'by_name' when extension_confidence <> '' then 'by_extension_only' when n_hits > 0 then 'weak' else 'unknown' end as status
      from conf c join voted v using (file_id)""",
    "rule_match_summary": f"{_HITS} select source, rule_id, count(*) as n_hits, count(distinct file_id) as n_files, cast(sum(score) as bigint) as total_score from hits group by 1, 2",
    "rule_performance": f"""{_HITS}, pack(source, rule_id, weight) as (values {", ".join(f"({_q(r.source)}, {_q(r.rule_id)}, {r.weight})" for r in RULES)})
      select p.source, p.rule_id, p.weight, count(h.file_id) as n_hits, count(distinct h.file_id) as n_files, cast(coalesce(sum(h.score), 0) as bigint) as total_score, count(h.file_id) = 0 as zero_hit from pack p left join hits h using (rule_id) group by 1, 2, 3""",
    "rule_strategies": f"""{_HITS}, other as ({_hits_sql(PLANTED)})
      select coalesce(h.file_id, o.file_id) as file_id, coalesce(h.source, o.source) as source, coalesce(h.rule_id, o.rule_id) as rule_id, h.score as compiled, o.score as full_scan, 'changed' as pack
      from hits h full join other o on h.file_id = o.file_id and h.source = o.source and h.rule_id = o.rule_id where h.score is distinct from o.score""",
    "content_matches": f"{_content_sql()} select * from m",
    "content_vote": f"{_content_vote_sql()} select * from v",
    "content_conflicts": f"""{_content_vote_sql()}, x as (select v.doc_id, content_document_type as c, coalesce(lower(trim(d.document_type)), '') as s from v join documents d using (doc_id))
      select doc_id, case when s in ('', 'unknown') and c <> '' then c else s end as merged, s not in ('', 'unknown') and c <> '' and c <> s as content_conflict from x""",
    "exact_groups": f"with {_TEXTS}, {_EXACT} select {_GROUP_COLS} from ne",
    "exact_members": f"with {_TEXTS}, {_EXACT} select * from me",
    "version_groups": f"with {_FILES}, {_VERS} select {_GROUP_COLS} from nv",
    "identifier_groups": f"with {_FILES}, {_IDENT} select {_GROUP_COLS} from ns",
    "duplicate_kinds": f"""with {_FILES}, {_EXACT}, {_VERS}, {_IDENT},
      u as (select *, 'exact' as kind, 0 as r from me union all select *, 'semantic_candidate', 1 from ms union all select *, 'version_candidate', 2 from mv)
      select file_id, kind, group_id, is_canonical from (select *, row_number() over (partition by file_id order by r) as k from u) where k = 1""",
    "sieve_status": f"{_SIEVE} select file_id, status, reason from s",
    "sieve_actions": f"{_SIEVE} select case when starts_with(status, 'KEEP') then 'keep' when starts_with(status, 'HOLD') then 'review' else 'exclude' end as action, status, count(*) as n, cast(coalesce(sum(size), 0) as bigint) as bytes from s group by 1, 2",
    "top_types": f"with {_CUR} select case when trim(mime_type) <> '' then mime_type else '(empty)' end as value, count(*) as n from cur group by 1 order by n desc, value limit {TOP}",
    "size_percentiles": f"""with {_CUR}, x as (select coalesce(extension, '') as extension, size, row_number() over (partition by coalesce(extension, '') order by size) as k, count(*) over (partition by coalesce(extension, '')) as n from cur where size is not null)
      select extension, max(n) as n, {", ".join(f"max(size) filter (where k = greatest(1, ceil(n * {p} / 100))) as p{p}" for p in (50, 90, 95, 99))} from x group by 1""",
    "folder_children": f"with {_CUR} select distinct parent, file_id from (select file_id, unnest(string_split(parents, ';')) as parent from cur) where trim(parent) <> ''",
    "event_sessions": """with a as (select user_id, ts, case when ts < lag(ts) over (partition by user_id order by ts) + interval 30 minutes then 0 else 1 end as opens from events),
      b as (select user_id, ts, sum(opens) over (partition by user_id order by ts rows unbounded preceding) as s from a)
      select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as session_start, count(*) as n from b group by user_id, s""",
    "summary_by_dimension": f"with {_CUR} {_summary_sql('cur', _DIMS)}",
    "dimension_cube": f"""with {_CUR}, x as (select object_kind, coalesce(sensitivity_suggestion, '(none)') as sensitivity from cur)
      select object_kind, sensitivity, cast(grouping_id(object_kind, sensitivity) as int) as grouping_set, count(*) as n from x group by cube (object_kind, sensitivity)""",
    "quality_summary": f"with {_CUR} " + " union all ".join(f"select {_q(m)} as metric, count(*) filter (where {c}) as value from cur" for m, c in _Q.items()),
    "access_coverage": f"with {_CUR} select drive_id, count(*) as n, count(*) filter (where content_extracted) as n_extracted, count(*) filter (where object_kind = 'file') as n_files from cur group by 1",
    "folder_stats": f"""with {_FILES}, {_EXACT}, {_KIDS},
      st as (select parent, count(*) filter (where object_kind = 'folder') as n_folders, count(*) filter (where object_kind = 'file') as n_files, bool_or(file_id in (select file_id from me)) as has_duplicates,
        bool_or({_UNK.format("sensitivity_suggestion")} not in ('', 'unknown', 'public_internal', 'operational')) as has_sensitive, bool_or({_UNK.format("document_type_suggestion")} in ('', 'unknown')) as has_unknown from kids group by 1)
      select parent, n_folders, n_files, coalesce(n_types, 0) as n_types, coalesce(top_types, '') as top_types, has_duplicates, has_sensitive, has_unknown, coalesce(n_types, 0) > 5 as mixed_types from st left join ranked using (parent)""",
    "largest_folders": f"with {_CUR}, {_KIDS} select parent, count(*) filter (where object_kind = 'folder') as n_folders, count(*) filter (where object_kind = 'file') as n_files from kids group by 1 order by n_files desc, parent limit {TOP}",
    "content_cap": f"with {_CUR}, a as (select file_id from cur where object_kind = 'file' order by listed_at, file_id limit {CAP}) select file_id, file_id in (select file_id from a) as admitted from cur",
    "sample_plan": f"""with {_FILES} select file_id, extension from (select file_id, coalesce(extension, '') as extension, row_number() over (partition by coalesce(extension, '') order by md5('{SEED}:' || file_id), file_id) as k from files) where k <= {SAMPLE}""",
    "unit_rates": f"""with {_FILES}, r(kind, unit_size, free_units, rate) as (values {", ".join(map(str, RATES))}), u as (select coalesce(department_suggestion, '') as department, coalesce(extension, '') as kind, coalesce(size, 0) as units from files)
      select department, u.kind, count(*) as n, cast(sum(units) as bigint) as units, round(sum(greatest(units - coalesce(free_units, 0), 0) / cast(greatest(coalesce(unit_size, 1), 1) as double) * coalesce(rate, 0)), 4) as cost from u left join r using (kind) group by 1, 2""",
    "events_by_hour": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as hour, event_type, count(*) as n from events group by 1, 2",
}
