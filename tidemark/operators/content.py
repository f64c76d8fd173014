"""Content rules over texts: matches, counts, votes, and merging with what metadata says."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ContentRule:
    """Keywords count once each where they occur, patterns as often as they match; any negative vetoes the text."""

    rule_id: str
    keywords: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    negatives: tuple[str, ...] = ()
    targets: dict[str, str] = field(default_factory=dict)
    weight: int = 5
    flags: tuple[str, ...] = ()


DEFAULT = [
    ContentRule("contract_terms", ("договор", "contract", "приложени"), (r"№ ?\d{5}",), targets={"document_type": "contract"}, weight=5, flags=("legal",)),
    ContentRule("acceptance", ("акт приёмки", "acceptance report", "замечан"), targets={"document_type": "act"}, weight=6),
    ContentRule("money", ("итого к оплате", "total due", "ндс"), (r"\d+ ?(?:руб|EUR)",), targets={"department": "finance"}, weight=4, flags=("financial",)),
    ContentRule("guests", ("гость", "guest"), targets={"department": "front_office"}, weight=3, flags=("guest_data",), negatives=(r"гостям это не мешает",)),
    ContentRule("housekeeping", ("горничная", "housekeeping", "бель"), targets={"department": "housekeeping"}, weight=4),
    ContentRule("minutes", ("протокол совещания", "minutes of"), targets={"document_type": "minutes"}, weight=9),
]


def load(path: str) -> list[ContentRule]:
    """Content rules kept as JSON or YAML: a list of mappings, or one below `rules`. Rules whose patterns are invalid are left out; see problems()."""
    text = Path(path).read_text("utf-8-sig")
    if path.endswith((".yml", ".yaml")):
        import yaml

        data = yaml.safe_load(text)
    else:
        data = json.loads(text)
    rows = data["rules"] if isinstance(data, dict) else data
    listed = lambda r, *names: tuple(str(x) for n in names for x in (r.get(n) or ()))
    rules = [ContentRule(str(r.get("rule_id") or ""), tuple(k.lower() for k in listed(r, "keywords")), listed(r, "patterns", "regex_patterns"), listed(r, "negatives", "negative_patterns"), {k: str(v) for k, v in (r.get("targets") or r.get("target_fields") or {}).items()}, int(r.get("weight", 5)), listed(r, "flags", "sensitivity_flags")) for r in rows or ()]
    bad = {rule_id for rule_id, _ in problems(rules)}
    return [r for r in rules if r.rule_id not in bad]


def problems(rules: list[ContentRule]) -> list[tuple[str, str]]:
    """(rule_id, message) of rules without id or selector, or with a pattern that Python or the engine rejects."""
    from pyspark.sql import SparkSession

    from .rules import _java_error

    out = []
    for r in rules:
        if not r.rule_id:
            out.append((r.rule_id, "rule without id"))
        if not (r.keywords or r.patterns):
            out.append((r.rule_id, "no selector"))
        for p in (*r.patterns, *r.negatives):
            try:
                re.compile(p)
                said = _java_error(SparkSession.getActiveSession(), p, "")
            except re.error as e:
                said = str(e)
            if said:
                out.append((r.rule_id, f"invalid pattern: {said}"))
    return out


def match_count(rule: ContentRule, norm: Column, raw: Column) -> Column:
    parts = [F.contains(norm, F.lit(k)).cast("int") for k in rule.keywords] + [F.regexp_count(raw, F.lit(p)) for p in rule.patterns]
    n = reduce(lambda a, b: a + b, parts)
    return F.when(reduce(lambda a, b: a | b, [norm.rlike(p) for p in rule.negatives]), 0).otherwise(n) if rule.negatives else n


def match_content(texts: DataFrame, rules: list[ContentRule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, matches): an array of (rule_id, n, score) of the rules that match, score being weight times matches. Null texts match nothing."""
    rules = DEFAULT if rules is None else rules
    t = texts.select(key, F.coalesce(text, F.lit("")).alias("__raw")).withColumn("__norm", F.lower("__raw"))
    t = t.withColumn("__n", F.array(*(match_count(r, F.col("__norm"), F.col("__raw")) for r in rules)))
    hit = F.array_compact(F.array(*(F.when(F.get("__n", F.lit(i)) > 0, F.struct(F.lit(r.rule_id).alias("rule_id"), F.get("__n", F.lit(i)).alias("n"), (F.get("__n", F.lit(i)) * r.weight).alias("score"))) for i, r in enumerate(rules))))
    return t.select(key, hit.alias("matches"))


def content_vote(matched: DataFrame, rules: list[ContentRule] | None = None) -> DataFrame:
    """`matched` with `content_<field>` (best value, '' without votes, ties to the smallest), `content_flags` and `content_confidence`."""
    rules = DEFAULT if rules is None else rules
    fields: dict[str, dict[str, list[str]]] = {}
    for r in rules:
        for f, v in r.targets.items():
            fields.setdefault(f, {}).setdefault(v, []).append(r.rule_id)

    def total(ids: list[str]) -> Column:
        return F.aggregate(F.filter("matches", lambda m: m["rule_id"].isin(ids)), F.lit(0), lambda a, m: a + m["score"])

    cols = {}
    for f, values in sorted(fields.items()):
        options = F.array(*(F.struct(total(values[v]).alias("s"), F.lit(-i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(sorted(values))))
        best = F.array_max(options)
        cols[f"content_{f}"] = F.when(best["s"] > 0, best["v"]).otherwise("")
    flagged = sorted({x for r in rules for x in r.flags})
    has = lambda ids: F.exists("matches", lambda m: m["rule_id"].isin(ids))
    cols["content_flags"] = F.array_join(F.array_compact(F.array(*(F.when(has([r.rule_id for r in rules if x in r.flags]), F.lit(x)) for x in flagged))), ";")
    cols["content_confidence"] = F.when(F.size("matches") >= 3, "high").when(F.size("matches") > 0, "medium").otherwise("")
    return matched.withColumns(cols)


def merge_with_metadata(voted: DataFrame, field_name: str, metadata: Column, unknown: tuple[str, ...] = ("", "unknown")) -> DataFrame:
    """`merged`: what metadata says, or the content's value where that is unknown; `content_conflict` where both say different things."""
    said = F.coalesce(metadata, F.lit(""))
    content = F.col(f"content_{field_name}")
    blank = said.isin(*unknown)
    return voted.withColumns({"merged": F.when(blank & (content != ""), content).otherwise(said), "content_conflict": ~blank & (content != "") & (content != said)})
