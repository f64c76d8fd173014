"""Registered queries of this subpackage, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import table
from ..session import materialize
from . import lookalike, packing, residue, survivor, tokenizer


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "corpus_rows", "file_id", "duplicate_group_id", "modified_time", *survivor.FIELDS)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the fusion's posteriors under a prior of infinite odds, as the order asked for is strict."""
    out = survivor.survivors(_corpus(spark, sf_dir), ("path",), survivor.STRICT)
    return out.select(F.col("g").alias("duplicate_group_id"), F.col("id").alias("canonical_file_id"), "path")


def p2_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By finite odds: votes decide, discounted for copying."""
    return survivor.fused_values(survivor.fuse(_corpus(spark, sf_dir))).withColumnRenamed("g", "duplicate_group_id")


def p2_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record of each group, chosen and completed by the votes."""
    return survivor.survivors(_corpus(spark, sf_dir), survivor.FIELDS, survivor.Prior()).withColumnsRenamed({"g": "duplicate_group_id", "id": "canonical_file_id"})


def p2_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = survivor.fuse(_corpus(spark, sf_dir))
    pairs = f.copies.select("i", F.col("first").alias("c")).unionByName(f.copies.select(F.col("j").alias("i"), F.col("second").alias("c")))
    most = pairs.groupBy(F.col("i").alias("id")).agg(F.max("c").alias("c"), F.count("*").alias("met"))
    # of sources never met nothing is known but the prior
    others = f.accuracy.count() - 1
    unmet = F.when(F.coalesce("met", F.lit(0)) < others, survivor.PRIOR_COPY).otherwise(0.0)
    return f.accuracy.join(most, "id", "left").select("source", "accuracy", F.greatest(F.coalesce("c", F.lit(0.0)), unmet).alias("most_copied"))


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    objects = materialize(lookalike.current_names(table(spark, sf_dir, "inventory_items", "file_id", "name", "listed_at")), "objects")
    return objects, lookalike.classes(objects)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.look_alike_pairs(*_names(spark, sf_dir))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.canonical_names(*_names(spark, sf_dir))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an object: how many others have a name that looks the same and is written differently."""
    return lookalike.links(*_names(spark, sf_dir)).select("file_id", "n_links")


def p3_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of normalized_name, per distinct value."""
    forms = lookalike.classes(table(spark, sf_dir, "inventory_items", "normalized_name"), "normalized_name")
    return forms.select(F.col("name").alias("normalized_name"), "n", F.col("canonical").alias("canonical_name"), "n_forms")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer.encode_corpus(table(spark, sf_dir, "documents", "doc_id", "text"))


def p8_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokenizer.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"))
    docs = table(spark, sf_dir, "documents", "doc_id", "source")
    return counts.join(docs, "doc_id").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("longest"), F.count_if(F.col("n_tokens") == 0).alias("n_empty"))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(tokenizer.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text")))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(p9_pack(spark, sf_dir))


def p9_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bound and gap of each part and of the whole corpus."""
    return packing.certificates(p9_pack(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find_residue(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id")


def p10_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find_residue(table(spark, sf_dir, "documents", "doc_id", "text"))


def p10_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the documents of each source when residue is excluded."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    bad = p10_found(spark, sf_dir)
    return docs.join(bad, "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("n_chars"))


QUERIES = {f.__name__: f for f in (p2_found, p2_fused, p2_survivors, p2_sources, p3_found, p3_canonical, p3_links, p3_normalized, p8_ids, p8_summary, p9_pack, p9_containers, p9_certificate, p10_found, p10_kinds, p10_clean)}

_UNKNOWN = ", ".join(f"'{w}'" for w in survivor.UNKNOWN)


def _filled(c: str) -> str:
    core = rf"regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    rooted = rf" or coalesce(regexp_matches({c}, '^\s*/.*[\p{{L}}\p{{N}}]'), false)" if c == "path" else ""
    return f"(coalesce(coalesce(trim({c}), '') <> '' and {core} <> '' and {core} not in ({_UNKNOWN}) and not regexp_matches({core}, '{survivor.UNKNOWN_START}'), false){rooted})"




def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _looks_like(c: str) -> str:
    c = rf"regexp_replace({c}, '[\t\n\r\x0B\x0C\x{{85}}\p{{Z}}]+', ' ', 'g')"
    c = rf"regexp_replace({c}, '[\p{{Cf}}\p{{Cc}}\x{{34F}}\x{{115F}}\x{{1160}}\x{{17B4}}\x{{17B5}}\x{{180B}}-\x{{180F}}\x{{3164}}\x{{FE00}}-\x{{FE0F}}\x{{FFA0}}\x{{E0100}}-\x{{E01EF}}]', '', 'g')"
    c = f"translate(trim(regexp_replace({c}, ' +', ' ', 'g')), {_q(lookalike._map()[0])}, {_q(lookalike._map()[1])})"
    for a, b in lookalike._several().items():
        c = f"replace({c}, {_q(a)}, {_q(b)})"
    return f"nfc_normalize({c})"


_NAMES = f"""with o as (select file_id, name, {_looks_like("name")} as k from (select *, row_number() over (partition by file_id order by listed_at desc nulls last, name desc nulls last) as r
  from inventory_items where file_id is not null) where r = 1)"""

_ODD = r"""length(name) - length(regexp_replace(name, '[\p{Cf}\p{Cc}\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}\x{E0100}-\x{E01EF}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FF01}-\x{FF5E}\p{M}]', '', 'g'))
  + length(name) - length(trim(regexp_replace(name, ' {2,}', ' ', 'g')))"""
_MIXED = r"cast(regexp_matches(name, '\p{Latin}\p{M}*[\p{Cyrillic}\p{Greek}]|[\p{Cyrillic}\p{Greek}]\p{M}*\p{Latin}') as int)"

SQL = {
    "p3_canonical": f"""{_NAMES}, d as (select name, k, count(*) as n, {_ODD} as odd, {_MIXED} as mixed from o where name is not null group by name, k),
      c as (select name, first_value(name) over (partition by k order by odd, mixed, n desc, name) as canonical_name from d)
      select o.file_id, o.name, c.canonical_name from o left join c using (name)""",
    "p3_links": f"""{_NAMES}, c as (select k, count(*) as n from o where name is not null group by k), m as (select name, count(*) as n from o where name is not null group by name)
      select o.file_id, coalesce(c.n - m.n, 0) as n_links from o left join c using (k) left join m using (name)""",
    "p3_found": f"{_NAMES} select a.file_id as file_id_a, b.file_id as file_id_b from o a join o b on a.k = b.k and a.name <> b.name and a.file_id < b.file_id",
    "p2_found": f"""
      with r as (select *, try_cast(upper(trim(modified_time)) as timestamptz) as mt, {" + ".join(f"cast({_filled(c)} as int)" for c in survivor.FIELDS)} as n_filled
          from corpus_rows where trim(duplicate_group_id) <> '' and file_id is not null),
      c as (select duplicate_group_id, file_id from (select *, row_number() over (partition by duplicate_group_id order by n_filled desc, mt desc nulls last, file_id) as k from r) where k = 1),
      p as (select duplicate_group_id, path from (select *, row_number() over (partition by duplicate_group_id order by mt desc nulls last, file_id, path) as k from r where {_filled("path")}) where k = 1),
      g as (select duplicate_group_id from r group by 1 having count(distinct file_id) >= 2)
      select g.duplicate_group_id, c.file_id as canonical_file_id, coalesce(p.path, '') as path from g join c using (duplicate_group_id) left join p using (duplicate_group_id)""",
}
