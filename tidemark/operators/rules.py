"""Weighted rule packs: matching, voting, confidence, conflicts and evidence.

A pack is compiled on the driver to column expressions. Every rule yields one
score expression, words are looked up in an array of the text's distinct words,
phrases by substring, and patterns by regular expression only where the cheaper
tests leave it open. The vote over (field, value) is then a fixed sum in the
row itself: no join, no shuffle, one pass over the data for the whole pack.
Scores are whole tenths, so that sums are exact in any order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_name, words
from ..session import materialize

# fixed values: factor of each source, in tenths (paths go by the place of the segment instead), and the sums from which confidence is high or medium
FACTORS = {"filename": 20, "sensitivity": 25, "media": 15, "cleanup": 20, "extension": 10}
SOURCES = ("path", "filename", "extension", "sensitivity", "media", "cleanup")
HIGH, MEDIUM = 250, 80
_SLASH = "\x01"


@dataclass(frozen=True)
class Rule:
    """One rule. `tokens` without spaces or marks match whole words, others substrings; any negative vetoes the text."""

    rule_id: str
    source: str
    targets: dict[str, str] = field(default_factory=dict)
    weight: int = 10
    tokens: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    negative_tokens: tuple[str, ...] = ()
    negative_patterns: tuple[str, ...] = ()
    extensions: tuple[str, ...] = ()
    mime_prefixes: tuple[str, ...] = ()

    @property
    def has_text(self) -> bool:
        return bool(self.tokens or self.patterns)

    @property
    def has_kind(self) -> bool:
        return bool(self.extensions or self.mime_prefixes)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def _is_word(token: str) -> bool:
    return token.replace("_", "").isalnum()


def matches_text(rule: Rule, norm: Column, raw: Column, found: Column) -> Column:
    """Negatives first, then tokens, then patterns; Unicode and case-insensitive. `found`: the pack's words that the text has."""
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    veto = [F.contains(padded, F.lit(t.lower())) for t in rule.negative_tokens] + [raw.rlike(f"(?iuU){p}") for p in rule.negative_patterns]
    single = [F.array_contains(found, t.lower()) for t in rule.tokens if _is_word(t)]
    hit = single + [F.contains(padded, F.lit(t.lower())) for t in rule.tokens if not _is_word(t)] + [raw.rlike(f"(?iuUm){p}") for p in rule.patterns]
    return ~_any(veto) & _any(hit) if veto else _any(hit)


def _found(rules: list[Rule], word_list: Column) -> Column:
    """Of a text's words those that any of the rules asks for; mostly none, which makes every rule's own test cheap."""
    asked = sorted({t.lower() for r in rules for t in r.tokens if _is_word(t)})
    return F.array_intersect(word_list, F.array(*map(F.lit, asked))) if asked else F.array().cast("array<string>")


def matches_kind(rule: Rule, extension: Column, mime: Column) -> Column:
    return _any(([extension.isin(*(e.lower() for e in rule.extensions))] if rule.extensions else []) + [F.startswith(mime, F.lit(p)) for p in rule.mime_prefixes])


def matches(rule: Rule, norm: Column, raw: Column, found: Column, extension: Column, mime: Column) -> Column:
    """Both selectors must hold where a rule has both, else the one it has."""
    if rule.has_text and rule.has_kind:
        return matches_text(rule, norm, raw, found) & matches_kind(rule, extension, mime)
    return matches_kind(rule, extension, mime) if rule.has_kind else matches_text(rule, norm, raw, found)


def depth_factor(i: Column, n: Column) -> Column:
    """First two segments 1.7, last two 1.4, others 1.0, in tenths."""
    return F.when(i <= 1, 17).when(i >= n - 2, 14).otherwise(10)


def _segments(r: Rule, guard: str | None = None) -> tuple[Column, Column]:
    """(whether a rule hits any path segment, its points over all that it hits); none below a guarded base, whose depth still counts."""
    n = F.size("__psegs")
    hit = lambda s: matches_text(r, s["norm"], s["raw"], s["found"])
    base = F.lit(None).cast("int") if guard is None else F.array_position(F.transform("__psegs", lambda s: s["norm"]), guard) - 1
    seen = lambda i: F.lit(True) if guard is None else (base < 0) | (i <= base)
    at = F.transform("__psegs", lambda s, i: F.when(seen(i) & hit(s), F.struct(F.lit(True).alias("on"), (depth_factor(i, n) * r.weight).alias("p"))).otherwise(F.struct(F.lit(False).alias("on"), F.lit(0).alias("p"))))
    points = F.aggregate(at, F.lit(0), lambda a, x: a + x["p"])
    return (points > 0 if r.weight > 0 else F.exists(at, lambda x: x["on"])), points


def inside_base(path: Column, marker: str) -> Column:
    """Whether a segment of a path is the marker, in its normal form."""
    norm = normalize_name(F.translate(F.coalesce(path, F.lit("")), "/" + _SLASH, _SLASH + " "))
    return F.exists(F.split(norm, _SLASH), lambda s: F.trim(s) == marker)


def score(rules: list[Rule], items: DataFrame, name: str = "name", path: str = "full_path", extension: str = "extension", mime: str = "mime_type", guard: str | None = None) -> DataFrame:
    """`items` with `hits`: an array of (rule_id, source, score) in order of sources and rules, score in tenths.

    Each path segment is matched alone, and a rule's score is the sum over the
    segments it hits, weighted by place. Null texts count as empty; a row
    without hits has an empty array. Helper columns are dropped again.
    """
    # paths and names are brought to normal form once; a mark keeps the slashes of the path apart from characters that become one
    raw_path, raw_name = F.coalesce(F.col(path), F.lit("")), F.coalesce(F.col(name), F.lit(""))
    prepared = items.withColumns({"__raw": raw_name, "__path": raw_path, "__norm": normalize_name(raw_name), "__pnorm": normalize_name(F.translate(raw_path, "/" + _SLASH, _SLASH + " ")), "__ext": F.coalesce(F.lower(F.col(extension)), F.lit("")), "__mime": F.coalesce(F.col(mime), F.lit(""))})
    wide = [r for r in rules if r.source in ("sensitivity", "media", "cleanup")]
    both, bnorm, bwords = F.concat("__path", F.lit(" "), "__raw"), F.trim(F.concat_ws(" ", F.translate("__pnorm", _SLASH, "/"), "__norm")), F.concat(words("__pnorm"), words("__norm"))
    if guard is not None:
        base = F.exists(F.split("__pnorm", _SLASH), lambda s: F.trim(s) == guard)
        both, bnorm, bwords = F.when(base, F.col("__raw")).otherwise(both), F.when(base, F.col("__norm")).otherwise(bnorm), F.when(base, words("__norm")).otherwise(bwords)
    prepared = prepared.withColumns(
        {
            "__both": both, "__bnorm": bnorm,
            "__found": _found([r for r in rules if r.source == "filename" or r.source == "extension"], words("__norm")),
            "__bfound": _found(wide, bwords),
            "__psegs": F.filter(F.arrays_zip(F.split("__path", "/").alias("raw"), F.transform(F.split("__pnorm", _SLASH), lambda s: F.trim(s)).alias("norm")), lambda s: s["raw"] != ""),
        }
    )
    prepared = prepared.withColumn("__psegs", F.transform("__psegs", lambda s: F.struct(s["raw"].alias("raw"), s["norm"].alias("norm"), _found([r for r in rules if r.source == "path"], words(s["norm"])).alias("found"))))
    hits = []
    for source in SOURCES:
        for r in (r for r in rules if r.source == source):
            if source == "path":
                on, points = _segments(r, guard)
            else:
                wide = source in ("sensitivity", "media", "cleanup")
                on = matches(r, F.col("__bnorm" if wide else "__norm"), F.col("__both" if wide else "__raw"), F.col("__bfound" if wide else "__found"), F.col("__ext"), F.col("__mime"))
                points = F.lit(FACTORS[source] * r.weight)
            hits.append(F.when(on, F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(source).alias("source"), points.cast("int").alias("score"))))
    helper = [c for c in prepared.columns if c.startswith("__")]
    empty = F.array().cast("array<struct<rule_id:string,source:string,score:int>>")
    return prepared.withColumn("hits", F.array_compact(F.array(*hits)) if hits else empty).drop(*helper)


def _score_of(rules: list[str]) -> Column:
    return F.aggregate(F.filter("hits", lambda h: h["rule_id"].isin(rules)), F.lit(0), lambda a, h: a + h["score"])


def _voted(rules: list[str]) -> Column:
    return F.exists("hits", lambda h: h["rule_id"].isin(rules)) if rules else F.lit(False)


def fields_of(rules: list[Rule]) -> dict[str, dict[str, list[str]]]:
    """field -> value -> ids of the rules that set it; blank values set nothing."""
    out: dict[str, dict[str, list[str]]] = {}
    for r in rules:
        for f, v in r.targets.items():
            if v not in (None, ""):
                out.setdefault(f, {}).setdefault(str(v), []).append(r.rule_id)
    return out


def vote(rules: list[Rule], scored: DataFrame, default: str = "unknown") -> DataFrame:
    """`scored` with one column for each target field: the value of highest score, ties to the smallest value, `default` without votes.

    A rule of weight 0 still votes. Also `conflict_fields`: fields for which
    the values that paths and names vote for are both there and disjoint.
    """
    cols, conflicts = {}, []
    source = {r.rule_id: r.source for r in rules}
    for f, values in sorted(fields_of(rules).items()):
        ranked = sorted(values)
        options = F.array_compact(F.array(*(F.when(_voted(values[v]), F.struct(_score_of(values[v]).alias("s"), F.lit(-i).alias("i"), F.lit(v).alias("v"))) for i, v in enumerate(ranked))))
        cols[f] = F.coalesce(F.array_max(options)["v"], F.lit(default))

        def said(which: str, values=values, ranked=ranked) -> Column:
            ids = {v: [x for x in values[v] if source[x] == which] for v in ranked}
            return F.array_compact(F.array(*(F.when(_voted(ids[v]), F.lit(v)) for v in ranked)))

        a, b = said("path"), said("filename")
        conflicts.append(F.when((F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b), F.lit(f)))
    return scored.withColumns(cols | {"conflict_fields": F.array_compact(F.array(*conflicts)) if conflicts else F.array().cast("array<string>")})


def confidence(source: str) -> Column:
    """'' without hits of the source, else low, medium or high by their sum."""
    mine = F.filter("hits", lambda h: h["source"] == source)
    total = F.aggregate(mine, F.lit(0), lambda a, h: a + h["score"])
    return F.when(F.size(mine) == 0, "").when(total >= HIGH, "high").when(total >= MEDIUM, "medium").otherwise("low")


def classify(rules: list[Rule], items: DataFrame, **columns: str) -> DataFrame:
    """score, vote, `<source>_confidence`, `status` and `evidence` (rule ids in order)."""
    out = vote(rules, score(rules, items, **columns))
    out = out.withColumns({f"{s}_confidence": confidence(s) for s in ("path", "filename", "extension")})
    status = (
        F.when(F.size("conflict_fields") > 0, "conflict").when(F.col("path_confidence") == "high", "by_path").when(F.col("filename_confidence") == "high", "by_name")
        .when(F.col("extension_confidence") != "", "by_extension_only").when(F.size("hits") > 0, "weak").otherwise("unknown")
    )
    return out.withColumns({"status": status, "evidence": F.array_join(F.transform("hits", lambda h: h["rule_id"]), ";")})


def exploded(scored: DataFrame, array: str = "hits", key: str = "file_id") -> DataFrame:
    """(key, h): one row a hit. The outer form keeps the planner from evaluating the whole pack once more as a filter."""
    return scored.select(key, F.explode_outer(array).alias("h")).where(F.col("h").isNotNull())


def rule_matches(scored: DataFrame) -> DataFrame:
    """(source, rule_id, n_hits, n_files, total_score): hits of each rule over all rows."""
    e = exploded(scored)
    out = e.groupBy("h.source", "h.rule_id").agg(F.count("*").alias("n_hits"), F.sum("h.score").alias("total_score"), F.count_distinct("file_id").alias("n_files"))
    return out.select("source", "rule_id", "n_hits", "n_files", "total_score")


def rule_examples(scored: DataFrame, path: str = "full_path", most: int = 3) -> DataFrame:
    """(source, rule_id, examples): the `most` smallest paths each rule hits, joined by ' | '.

    The engine keeps no more than `most` rows of a rule in a task before they meet.
    """
    e = scored.select(F.coalesce(path, F.lit("")).alias("__p"), F.explode_outer("hits").alias("h")).where(F.col("h").isNotNull()).select("h.source", "h.rule_id", "__p").distinct()
    few = e.withColumn("__k", F.row_number().over(Window.partitionBy("source", "rule_id").orderBy("__p"))).where(F.col("__k") <= most)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__k", "__p"))), lambda x: x["__p"])
    return few.groupBy("source", "rule_id").agg(F.array_join(listed, " | ").alias("examples"))


def suspicious_rules(performance: DataFrame, findings: list[tuple[str, str, str]]) -> DataFrame:
    """The rules of rule_performance() that hit nothing or that validate() finds an error in."""
    bad = sorted({rule_id for level, rule_id, _ in findings if level == "error"})
    wrong = F.col("rule_id").isin(*bad) if bad else F.lit(False)
    return performance.withColumn("invalid", wrong).where(F.col("zero_hit") | F.col("invalid")).orderBy("source", "rule_id")


def rule_performance(spark: SparkSession, rules: list[Rule], scored: DataFrame) -> DataFrame:
    """Every rule of the pack with its hits, zero ones too."""
    pack = spark.createDataFrame([(r.source, r.rule_id, r.weight) for r in rules], "source string, rule_id string, weight int")
    return F.broadcast(pack).join(rule_matches(scored), ["source", "rule_id"], "left").select("source", "rule_id", "weight", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_hits", "n_files", "total_score")), F.col("n_hits").isNull().alias("zero_hit"))


def full_scan(rules: list[Rule], items: DataFrame, key: str = "file_id") -> DataFrame:
    """(key, source, rule_id, score): every rule held against every row by its definition, without any of the short cuts of score().

    Words are looked for by regular expression, path segments are rows of
    their own, and each rule is tried on each. The yardstick of
    compare_strategies(), not a way to run a pack.
    """

    def text(r: Rule, norm: Column, raw: Column) -> Column:
        padded = F.concat(F.lit(" "), norm, F.lit(" "))
        whole = lambda t: rf"(?<![\p{{L}}\p{{N}}_]){re.escape(t.lower())}(?![\p{{L}}\p{{N}}_])"
        veto = [F.contains(padded, F.lit(t.lower())) for t in r.negative_tokens] + [raw.rlike(f"(?iuU){p}") for p in r.negative_patterns]
        hit = [padded.rlike(whole(t)) if _is_word(t) else F.contains(padded, F.lit(t.lower())) for t in r.tokens] + [raw.rlike(f"(?iuUm){p}") for p in r.patterns]
        return ~_any(veto) & _any(hit)

    base = items.select(key, F.coalesce("name", F.lit("")).alias("raw"), F.coalesce("full_path", F.lit("")).alias("path"), F.coalesce(F.lower("extension"), F.lit("")).alias("ext"), F.coalesce("mime_type", F.lit("")).alias("mime"))
    both = F.concat_ws(" ", "path", "raw")
    base = materialize(base.withColumns({"norm": normalize_name("raw"), "both": both, "bnorm": normalize_name(both)}), "scan")
    tried = []
    for r in rules:
        if r.source == "path":
            continue
        wide = r.source in ("sensitivity", "media", "cleanup")
        on = [text(r, F.col("bnorm" if wide else "norm"), F.col("both" if wide else "raw"))] if r.has_text else []
        on += [matches_kind(r, F.col("ext"), F.col("mime"))] if r.has_kind else []
        tried.append(F.struct(F.lit(r.source).alias("source"), F.lit(r.rule_id).alias("rule_id"), F.lit(FACTORS[r.source] * r.weight).alias("score"), reduce(lambda a, b: a & b, on).alias("on")))
    shape = "array<struct<source:string,rule_id:string,score:int,on:boolean>>"
    rows = base.select(key, F.explode((F.array(*tried) if tried else F.array()).cast(shape)).alias("h")).where("h.on").select(key, "h.source", "h.rule_id", "h.score")
    segments = base.select(key, F.filter(F.split("path", "/"), lambda s: s != "").alias("s")).select(key, F.size("s").alias("n"), F.posexplode("s").alias("i", "raw"))
    segments = materialize(segments.withColumn("norm", normalize_name("raw")), "segments")
    tried = [F.struct(F.lit("path").alias("source"), F.lit(r.rule_id).alias("rule_id"), (depth_factor(F.col("i"), F.col("n")) * r.weight).alias("score"), text(r, F.col("norm"), F.col("raw")).alias("on")) for r in rules if r.source == "path"]
    paths = segments.select(key, F.explode((F.array(*tried) if tried else F.array()).cast(shape)).alias("h")).where("h.on").groupBy(key, "h.source", "h.rule_id").agg(F.sum("h.score").cast("int").alias("score"))
    return rows.unionByName(paths)


def compare_strategies(rules: list[Rule], items: DataFrame, scanned: list[Rule] | None = None, key: str = "file_id") -> DataFrame:
    """(key, source, rule_id, compiled, full_scan): hits whose scores differ between the compiled pack and a full scan; null where one has none.

    All rules of all sources are compared; for one pack the result is empty.
    `scanned` names another pack for the full scan, which tells what a change
    of rules does. Keys are to be unique.
    """
    fast = exploded(score(rules, items), key=key).select(key, "h.source", "h.rule_id", F.col("h.score").alias("compiled"))
    slow = full_scan(rules if scanned is None else scanned, items, key).withColumnRenamed("score", "full_scan")
    return fast.join(slow, [key, "source", "rule_id"], "full_outer").where(~F.col("compiled").eqNullSafe(F.col("full_scan")))


ALLOWED_SHORT = {"bti", "cad", "pdf", "hr", "it"}


def _java_error(spark: SparkSession | None, pattern: str, flags: str) -> str:
    """What the engine's own dialect has against a pattern; '' if nothing, or if no session is there to ask."""
    if spark is None or spark.sparkContext._jvm is None:
        return ""
    try:
        spark.sparkContext._jvm.java.util.regex.Pattern.compile(flags + pattern)
    except Exception as e:
        return str(getattr(e, "java_exception", e)).splitlines()[0]
    return ""


def validate(rules: list[Rule], spark: SparkSession | None = None) -> list[tuple[str, str, str]]:
    """(level, rule_id, message) of what is wrong in a pack; nothing is raised.

    Patterns are tried in Python's dialect and, with a session (the active one
    unless given), in that of the engine, under the flags it runs them with.
    """
    spark = SparkSession.getActiveSession() if spark is None else spark
    out, seen, signatures = [], set(), {}
    for r in rules:
        if not r.rule_id:
            out.append(("error", "", "rule without id"))
        if (r.source, r.rule_id) in seen:
            out.append(("error", r.rule_id, "duplicate id"))
        seen.add((r.source, r.rule_id))
        if r.source not in SOURCES:
            out.append(("error", r.rule_id, f"unknown source {r.source}"))
        if not (r.has_text or r.has_kind):
            out.append(("error", r.rule_id, "no selector"))
        if isinstance(r.weight, bool) or not isinstance(r.weight, int):
            out.append(("error", r.rule_id, "weight is not a whole number"))
        if any(str(v).upper().startswith("DELETE") for v in r.targets.values()):
            out.append(("error", r.rule_id, "forbidden action"))
        for p, flags in [(p, "(?iuUm)") for p in r.patterns] + [(p, "(?iuU)") for p in r.negative_patterns]:
            try:
                re.compile(p)
            except re.error as e:
                out.append(("error", r.rule_id, f"invalid pattern: {e}"))
                continue
            if said := _java_error(spark, p, flags):
                out.append(("error", r.rule_id, f"invalid pattern: {said}"))
        sign = (r.source, r.tokens, r.patterns, r.extensions, r.mime_prefixes, tuple(sorted(r.targets.items())))
        if sign in signatures:
            out.append(("warning", r.rule_id, f"same as {signatures[sign]}"))
        signatures.setdefault(sign, r.rule_id)
        out += [("warning", r.rule_id, f"short token {t}") for t in r.tokens if len(t) <= 3 and t.lower() not in ALLOWED_SHORT]
    return out


def usable(rules: list[Rule], spark: SparkSession | None = None) -> list[Rule]:
    """The rules without errors of their own; a bad one is left out and the run goes on."""
    bad = {rule_id for level, rule_id, _ in validate(rules, spark) if level == "error"}
    return [r for r in rules if r.rule_id not in bad]
