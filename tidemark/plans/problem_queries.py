"""Registered queries of the general data problems, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import first_element, table, unblank
from ..operators import hierarchy, hot_keys, incremental, references, snapshots
from ..session import forget_later, shared_folder

SHARE = 0.03


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "inventory_items", "parents")
    corpus = table(spark, sf_dir, "corpus_rows", "duplicate_group_id")
    one = hot_keys.heavy_keys(items, first_element("parents"), SHARE).select(F.lit("inventory_items").alias("table_name"), "key_value")
    return one.unionByName(hot_keys.heavy_keys(corpus, unblank("duplicate_group_id"), SHARE).select(F.lit("corpus_rows").alias("table_name"), "key_value"))


def p1_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "inventory_items", "file_id", "parents", "size", "modified_time", "trashed", "listed_at")
    out = hot_keys.key_profile(
        items,
        first_element("parents"),
        {
            "total_size": F.coalesce(F.sum("size"), F.lit(0)),
            "largest": F.coalesce(F.max("size"), F.lit(0)),
            "n_trashed": F.count_if(F.coalesce("trashed", F.lit(False))),
            "first_listed": F.min("listed_at"),
            "last_listed": F.max("listed_at"),
        },
        F.col("file_id"),
    )
    return out.withColumnsRenamed({"__key": "parent_id", "n_distinct": "n_objects"})


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "corpus_rows", "file_id", "duplicate_group_id", "size_bytes", "needs_review", "sieved_at")
    out = hot_keys.key_profile(
        rows,
        unblank("duplicate_group_id"),
        {"total_size": F.coalesce(F.sum(F.col("size_bytes").try_cast("bigint")), F.lit(0)), "n_review": F.count_if(F.coalesce(F.lower("needs_review") == "true", F.lit(False))), "first_sieved": F.min("sieved_at"), "last_sieved": F.max("sieved_at")},
        F.col("file_id"),
    )
    return out.withColumnsRenamed({"__key": "group_id", "n_distinct": "n_files"})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.changed_files(table(spark, sf_dir, "listing_feed"), table(spark, sf_dir, "run_log")).select("run_id", "file_id")


def p4_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = incremental.changed_files(table(spark, sf_dir, "listing_feed"), table(spark, sf_dir, "run_log"))
    return cases.groupBy("run_id").agg(F.count("*").alias("n_cases"), F.count("content").alias("n_with_content"))


#: Runs after which p4_incremental calls the store; what a call does not see yet is delivered to the next.
CALLS = (12, 13, 30)


def p4_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cases, found in several calls on one store, each with the feed as it stood."""
    feed, log = table(spark, sf_dir, "listing_feed"), table(spark, sf_dir, "run_log")
    store = incremental.IncrementalStore(spark, forget_later(spark, f"{shared_folder(spark)}/tidemark/store-{uuid.uuid4().hex}"))
    for upto in CALLS:
        store.process(feed.where(F.col("run_id") <= upto), log.where(F.col("run_id") <= upto))
    store.process(feed, log)
    return store.published().select("run_id", "file_id")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        table(spark, sf_dir, "inventory_items", "file_id", "parents", "trashed", "listed_at"),
        table(spark, sf_dir, "shared_drives", "drive_id"),
        table(spark, sf_dir, "corpus_rows", "file_id", "canonical_file_id", "sieved_at"),
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.broken_references(*_tables(spark, sf_dir))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(references.broken_references(*_tables(spark, sf_dir)))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = hierarchy.folder_links(table(spark, sf_dir, "inventory_items"), table(spark, sf_dir, "shared_drives"))
    return hierarchy.resolve_hierarchy(links)


def p6_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = hierarchy.folder_links(table(spark, sf_dir, "inventory_items"), table(spark, sf_dir, "shared_drives"))
    return hierarchy.resolve_hierarchy(links, paths=True).select("file_id", "root_id", "depth", "full_path")


def p6_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = hierarchy.folder_links(table(spark, sf_dir, "inventory_items"), table(spark, sf_dir, "shared_drives"))
    return hierarchy.descendants(hierarchy.resolve_hierarchy(links, paths=True))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, sf_dir, "inventory_snapshots", "snapshot_no", "file_id", "modified_time", "full_path"))


def p7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_found(spark, sf_dir).groupBy("snapshot_no").pivot("change", ["added", "changed", "removed"]).agg(F.count(F.lit(1))).na.fill(0)


QUERIES = {f.__name__: f for f in (p1_found, p1_folders, p1_groups, p4_found, p4_per_run, p4_incremental, p5_found, p5_report, p6_found, p6_paths, p6_descendants, p7_found, p7_summary)}

_FEED = """
good as (select distinct run_id from run_log where lower(trim(status)) = 'success' and run_id is not null),
seen as (select f.file_id, f.feed_seq, try_cast(upper(trim(f.modified_time)) as timestamptz) as mt,
    case when trim(f.content_text_hash) <> '' then f.content_text_hash end as h,
    (select min(g.run_id) from good g where g.run_id >= f.run_id) as run_id
  from listing_feed f where f.file_id is not null and f.run_id is not null),
best as (select * from (select *, row_number() over (partition by run_id, file_id order by mt desc nulls last, feed_seq desc nulls last, h desc nulls last) as k
    from seen where run_id is not null) where k = 1),
ord as (select *, row_number() over (partition by file_id order by run_id) as rn from best),
fold(file_id, rn, run_id, hit, lmt, lh) as (
  select file_id, rn, run_id, true, mt, h from ord where rn = 1
  union all
  select o.file_id, o.rn, o.run_id, c.hit, case when c.hit then o.mt else f.lmt end, case when c.hit then o.h else f.lh end
  from fold f join ord o on o.file_id = f.file_id and o.rn = f.rn + 1
  cross join lateral (select coalesce(o.mt, timestamptz '0001-01-01 00:00:00+00') >= coalesce(f.lmt, timestamptz '0001-01-01 00:00:00+00')
    and case when o.h is not null and f.lh is not null then o.h <> f.lh
        else coalesce(o.mt, timestamptz '0001-01-01 00:00:00+00') > coalesce(f.lmt, timestamptz '0001-01-01 00:00:00+00') end as hit) c)
"""

_CURRENT = """
cur as (select * from (select *, row_number() over (partition by file_id order by listed_at desc nulls last,
      coalesce(trashed, false), object_kind desc nulls last, parents desc nulls last, name desc nulls last) as k,
    min(listed_at) over (partition by file_id) as first_listed from inventory_items where file_id is not null) where k = 1)
"""

_BROKEN = f"""
with {_CURRENT},
refs as (
  select 'inventory_items' as table_name, listed_at as at, file_id as row_key, unnest(string_split(parents, ';')) as ref from cur where not coalesce(trashed, false)
  union all select 'corpus_rows', sieved_at, file_id, file_id from corpus_rows
  union all select 'corpus_rows', sieved_at, file_id, canonical_file_id from corpus_rows),
broken as (
  select distinct r.table_name, strftime(r.at, '%Y-%m') as period, r.row_key, r.ref as ref_key,
    case when c.file_id is null then 'missing' when coalesce(c.trashed, false) then 'deleted' when c.first_listed > r.at then 'late' end as reason
  from refs r left join cur c on c.file_id = r.ref
  where trim(r.ref) <> '' and r.ref not in (select drive_id from shared_drives where drive_id is not null))
"""

_TREE = f"""
with recursive {_CURRENT},
f as (select file_id, case when trim(split_part(parents, ';', 1)) <> '' then split_part(parents, ';', 1) end as up, name from cur where object_kind = 'folder'),
l as (select f.file_id, f.name, case when d.drive_id is null and p.file_id is not null then f.up end as parent,
    case when d.drive_id is not null then f.up when p.file_id is null then f.file_id end as root,
    case when d.drive_id is not null then 1 else 0 end as step, coalesce('/' || d.shared_drive_name, '') as root_path
  from f left join (select drive_id, max(shared_drive_name) as shared_drive_name from shared_drives group by drive_id) d on d.drive_id = f.up
    left join f p on p.file_id = f.up),
t as (select file_id, root, step as depth, root_path || '/' || coalesce(name, '') as full_path from l where root is not null
  union all select l.file_id, t.root, t.depth + 1, t.full_path || '/' || coalesce(l.name, '') from t join l on l.parent = t.file_id),
a as (select l.file_id, l.parent as anc, 1 as distance from l join t using (file_id) where l.parent is not null
  union all select a.file_id, l.parent, a.distance + 1 from a join l on l.file_id = a.anc where l.parent is not null),
c as (select file_id, parent from l where file_id not in (select file_id from t)),
w as (select file_id as start, parent as at from c union select w.start, c.parent from w join c on c.file_id = w.at)
"""

_SNAP = """
with best as (select * from (select snapshot_no, file_id, try_cast(upper(trim(modified_time)) as timestamptz) as mt, full_path,
    row_number() over (partition by snapshot_no, file_id order by try_cast(upper(trim(modified_time)) as timestamptz) desc nulls last, full_path desc nulls last) as k
  from inventory_snapshots where file_id is not null and snapshot_no is not null) where k = 1),
n as (select snapshot_no, lag(snapshot_no) over (order by snapshot_no) as prev from (select distinct snapshot_no from best)),
d as (
  select b.snapshot_no, b.file_id, case when p.file_id is null then 'added' else 'changed' end as change
  from best b join n on n.snapshot_no = b.snapshot_no and n.prev is not null left join best p on p.file_id = b.file_id and p.snapshot_no = n.prev
  where p.file_id is null or p.mt is distinct from b.mt or p.full_path is distinct from b.full_path
  union all
  select n.snapshot_no, p.file_id, 'removed' from best p join n on n.prev = p.snapshot_no
  left join best b on b.file_id = p.file_id and b.snapshot_no = n.snapshot_no where b.file_id is null)
"""

SQL = {
    "p1_found": """
      select 'inventory_items' as table_name, k as key_value from (select split_part(parents, ';', 1) as k, count(*) as n from inventory_items group by 1)
      where trim(k) <> '' and n * 1000 >= 30 * (select count(*) from inventory_items)
      union all select 'corpus_rows', duplicate_group_id from corpus_rows where trim(duplicate_group_id) <> ''
      group by duplicate_group_id having count(*) * 1000 >= 30 * (select count(*) from corpus_rows)""",
    "p1_folders": """
      select case when trim(split_part(parents, ';', 1)) <> '' then split_part(parents, ';', 1) end as parent_id, count(*) as n_rows, count(distinct file_id) as n_objects,
        cast(coalesce(sum(size), 0) as bigint) as total_size, coalesce(max(size), 0) as largest, count(*) filter (where trashed) as n_trashed, min(listed_at) as first_listed, max(listed_at) as last_listed
      from inventory_items group by 1""",
    "p1_groups": """
      select case when trim(duplicate_group_id) <> '' then duplicate_group_id end as group_id, count(*) as n_rows, count(distinct file_id) as n_files,
        cast(coalesce(sum(try_cast(size_bytes as bigint)), 0) as bigint) as total_size, count(*) filter (where lower(needs_review) = 'true') as n_review, min(sieved_at) as first_sieved, max(sieved_at) as last_sieved
      from corpus_rows group by 1""",
    "p4_found": f"with recursive {_FEED} select run_id, file_id from fold where hit",
    "p4_incremental": f"with recursive {_FEED} select run_id, file_id from fold where hit",
    "p4_per_run": f"with recursive {_FEED} select run_id, count(*) as n_cases, count(lh) as n_with_content from fold where hit group by run_id",
    "p5_found": f"{_BROKEN} select * from broken where reason is not null",
    "p5_report": f"{_BROKEN} select table_name, period, reason, count(*) as n_refs, count(distinct ref_key) as n_targets from broken where reason is not null group by 1, 2, 3",
    "p6_found": f"""{_TREE}
      select t.file_id, t.root as root_id, cast(t.depth as int) as depth, cast(coalesce(b.n, 0) as int) as n_below, 0 as on_cycle
      from t left join (select anc, count(*) as n from a group by anc) b on b.anc = t.file_id
      union all select c.file_id, 'CYCLE', -1, -1, case when exists (select 1 from w where w.start = c.file_id and w.at = c.file_id) then 1 else 0 end from c""",
    "p6_paths": f"""{_TREE} select file_id, root as root_id, cast(depth as int) as depth, full_path from t
      union all select file_id, 'CYCLE', -1, null from c""",
    "p6_descendants": f"{_TREE} select anc as ancestor, file_id, cast(distance as int) as distance from a",
    "p7_found": f"{_SNAP} select * from d",
    "p7_summary": f"""{_SNAP} select snapshot_no, count(*) filter (where change = 'added') as added, count(*) filter (where change = 'changed') as changed,
      count(*) filter (where change = 'removed') as removed from d group by snapshot_no""",
}
