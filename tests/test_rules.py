import random
from dataclasses import replace
import re

import pytest
from pyspark.sql import functions as F

from tidemark import packs
from tidemark.operators import content, rules, sieve
from tidemark.operators.rules import Rule

ITEMS = "file_id string, name string, full_path string, extension string, mime_type string, hits int, listed_at int"


def items(spark, *rows):
    return spark.createDataFrame([(r[0], r[1], r[2], r[3] if len(r) > 3 else "", r[4] if len(r) > 4 else "", 1, 1) for r in rows], ITEMS).drop("hits")


PACK = [
    Rule("p1", "path", {"department": "legal"}, 10, tokens=("contracts",)),
    Rule("f1", "filename", {"department": "finance", "type": "invoice"}, 10, tokens=("invoice",), negative_tokens=("no invoice",)),
    Rule("f2", "filename", {"type": "act"}, 20, tokens=("room photo",), patterns=(r"act\s+\d+",)),
    Rule("e1", "extension", {"family": "text"}, 1, extensions=("pdf",), mime_prefixes=("text/",)),
    Rule("m1", "media", {"media": "photo"}, 1, tokens=("photo",), extensions=("jpg",)),
    Rule("z0", "cleanup", {"cleanup": "x"}, 0, tokens=("~$",)),
]


def hits(df):
    return {r["file_id"]: [(h["rule_id"], h["score"]) for h in r["hits"]] for r in df.collect()}


def test_scores_depths_negatives_and_mixed_rules(spark):
    df = items(
        spark,
        ("a", "Invoice 1.pdf", "/Contracts/x/y/z/Invoice 1.pdf", "pdf"), ("b", "no invoice", "/a/b/c/Contracts/d/e/f", "", "text/plain"), ("c", "bathroom photograph", None, "jpg"), ("d", "photo", "", "png"),
        ("e", "photo", "", "JPG"), ("f", "~$doc", "/contracts", ""), ("g", None, None, None, None), ("h", "invoiced", "/contractsx", ""),
    )
    got = hits(rules.score(PACK, df))
    assert got["a"] == [("p1", 170), ("f1", 200), ("e1", 10)]
    assert got["b"] == [("p1", 100), ("e1", 10)]
    assert got["c"] == [("f2", 400)]  # a token with a space matches as a substring
    assert got["d"] == [] and got["e"] == [("m1", 15)] and got["f"] == [("p1", 170), ("z0", 0)] and got["g"] == [] and got["h"] == []


def test_votes_ties_conflicts_and_status(spark):
    df = items(spark, ("a", "Invoice.pdf", "/Contracts/Invoice.pdf", "pdf"), ("b", "x", "/y", ""))
    got = {r["file_id"]: r for r in rules.classify(PACK, df).collect()}
    assert got["a"]["department"] == "finance" and got["a"]["type"] == "invoice" and got["a"]["conflict_fields"] == ["department"] and got["a"]["status"] == "conflict"
    assert got["b"]["department"] == "unknown" and got["b"]["status"] == "unknown" and got["b"]["evidence"] == ""
    tie = [Rule("a", "filename", {"t": "zeta"}, tokens=("w",)), Rule("b", "filename", {"t": "alpha"}, tokens=("w",))]
    assert rules.vote(tie, rules.score(tie, items(spark, ("x", "w", "/w")))).first()["t"] == "alpha"


def test_vote_against_a_plain_loop(spark):
    rng = random.Random(6)
    vocab = ["invoice", "act", "photo", "plan", "x1", "№", "report"]
    pack = [Rule(f"r{i}", rng.choice(["path", "filename", "media"]), {rng.choice("fg"): rng.choice("abc")}, rng.randrange(0, 9), tokens=tuple(rng.sample(vocab, 2))) for i in range(12)]
    rows = [(str(i), " ".join(rng.choices(vocab, k=3)), "/" + "/".join(rng.choices(vocab, k=rng.randrange(1, 6)))) for i in range(40)]
    got = {r["file_id"]: r for r in rules.vote(pack, rules.score(pack, items(spark, *rows))).collect()}

    def has(t, s):
        s = s.lower().replace("№", "no")
        return re.search(rf"(?<!\w){re.escape(t)}(?!\w)", s) is not None if t != "№" else "№" in f" {s} "

    for i, name, path in rows:
        votes = {}
        for r in pack:
            segs = path.strip("/").split("/")
            if r.source == "path":
                s = sum(r.weight * (17 if j <= 1 else 14 if j >= len(segs) - 2 else 10) for j, seg in enumerate(segs) if any(has(t, seg) for t in r.tokens))
                on = any(has(t, seg) for seg in segs for t in r.tokens)
            else:
                s = r.weight * rules.FACTORS[r.source]
                on = any(has(t, name if r.source == "filename" else f"{path} {name}") for t in r.tokens)
            if on:
                for f, v in r.targets.items():
                    votes.setdefault(f, {}).setdefault(v, 0)
                    votes[f][v] += s
        for f in rules.fields_of(pack):
            want = min(votes[f], key=lambda v: (-votes[f][v], v)) if f in votes else "unknown"
            assert got[i][f] == want


def test_compiled_pack_equals_full_scan(spark):
    rng = random.Random(2)
    words = ["Договор", "акт", "черновик", "Invoice", "report", "final", "Смета", "draft", "meeting notes", "без договора", "sop", "отчёт"]
    df = items(spark, *((str(i), " ".join(rng.choices(words, k=3)) + rng.choice([".pdf", "", "_v2"]), "/x", "pdf") for i in range(200)))
    assert rules.compare_strategies(packs.DEFAULT, df).count() == 0
    # a planted difference is reported, whatever the source of its rule
    for source in rules.SOURCES:
        r = Rule("planted", source, {"a": "b"}, 7, tokens=("акт", "x"), extensions=("pdf",) if source == "extension" else ())
        seen = rules.compare_strategies([r], df, [replace(r, weight=8)])
        assert seen.count() > 0 and {x["source"] for x in seen.select("source").distinct().collect()} == {source}


def test_both_regex_dialects_are_tried(spark):
    python_only, java_only = Rule("p", "filename", {"a": "b"}, patterns=(r"(?P<n>\d+)x",)), Rule("j", "filename", {"a": "b"}, patterns=(r"\p{L}+",))
    found = {rule_id for level, rule_id, m in rules.validate([python_only, java_only], spark) if level == "error" and "invalid pattern" in m}
    assert found == {"p", "j"} and rules.usable([python_only, Rule("ok", "filename", {"a": "b"}, tokens=("word",))], spark)[0].rule_id == "ok"


def test_guarded_base_is_left_alone(spark):
    pack = [Rule("p", "path", {"d": "x"}, 10, tokens=("invoices",)), Rule("s", "sensitivity", {"z": "y"}, 5, tokens=("invoices", "secret"))]
    df = items(spark, ("in", "a", "/Top/Base/Invoices"), ("at", "a", "/Invoices/Base"), ("out", "a", "/Top/Invoices/x"), ("name", "secret", "/BASE/q"))
    got = {r["file_id"]: [(h["rule_id"], h["score"]) for h in r["hits"]] for r in rules.score(pack, df, guard="base").collect()}
    assert got["in"] == [] and got["at"] == [("p", 170)] and [h for h, _ in got["out"]] == ["p", "s"] and got["name"] == [("s", 125)]
    assert [r[0] for r in df.select(rules.inside_base(F.col("full_path"), "base")).collect()] == [True, True, False, True]


def test_final_status_confidence_and_views(spark):
    from tidemark.operators import status

    df = items(spark, ("a", "договор 5.pdf", "/contracts/legal"), ("b", "zzz", "/q"), ("c", "thumbs.db", "/q"), ("d", "invoice", "/персонал/x"))
    got = {r["file_id"]: r for r in status.finish(rules.classify(packs.DEFAULT, df)).collect()}
    assert (got["a"]["family"], got["a"]["combined_confidence"], got["a"]["final_status"], got["a"]["retention"]) == ("legal_document", "high", "sensitive", "controlled_retention_review")
    assert (got["b"]["final_status"], got["b"]["combined_confidence"], got["b"]["final_reason"]) == ("unknown", "unknown", "No confident metadata classification rule matched.")
    assert got["c"]["final_status"] == "system" and got["c"]["retention"] == "short_term_review"
    assert got["d"]["combined_confidence"] == "needs_review" and "conflicts=department" in got["d"]["final_reason"]
    v = status.finish(rules.classify(packs.DEFAULT, df)).withColumns({"duplicate_kind": F.lit(None).cast("string"), "mime_type": F.lit(None).cast("string")})
    rows = {(r["view"], r["file_id"]) for r in status.view_rows(v).collect()}
    assert {("system_files", "c"), ("conflicts", "d"), ("unknown", "b"), ("sensitive", "a")} <= rows and not any(x == "exact_duplicates" for x, _ in rows)
    assert status.view_rows(v.limit(0)).count() == 0
    c = spark.createDataFrame([("high",), ("",), (None,), ("unknown",), ("sure",)], "c string")
    assert [r[0] for r in c.select(status.normal_confidence(F.col("c"))).collect()] == ["high", "unknown", "unknown", "unknown", "medium"]
    f = spark.createDataFrame([("x;phone",), ("inn",), ("",), (None,)], "f string")
    assert [r[0] for r in f.select(status.class_of_flags(F.col("f"), [("personal", ("phone",)), ("financial", ("inn", "phone"))])).collect()] == ["personal", "financial", "unknown", "unknown"]


def test_content_rules_load_and_bad_ones_are_left_out(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"rules": [{"rule_id": "a", "keywords": ["Акт"], "regex_patterns": ["\\\\d+"], "negative_patterns": ["no"], "target_fields": {"t": "v"}, "weight": 3, "sensitivity_flags": ["f"]}, {"rule_id": "b", "regex_patterns": ["("]}, {"rule_id": "c"}]}')
    assert content.load(str(p)) == [content.ContentRule("a", ("акт",), (r"\d+",), ("no",), {"t": "v"}, 3, ("f",))]


SIEVE_CASE = "file_id string, name string, size string, full_path string, content_hash string, duplicate_group_id string, duplicate_kind string, sensitivity_suggestion string, at int, d string"


def test_corpus_sieve_groups_scores_and_tables(spark):
    c = sieve.parse_config({"sensitivity_hold_values": ["secret"], "extension_rules": [{"rule_id": "z", "status": "CORPUS_EXCLUDE_INSTALLER", "reason": "r", "extensions": [".exe"]}], "system_trash_rules": [{"rule_id": "t", "status": "CORPUS_EXCLUDE_TEMP", "reason": "q", "filename_regex": "^~"}]})
    rows = [
        ("a", "Contract final.pdf", "9", "/x", "h1", "", "", "", 1, ""), ("b", "Contract copy.pdf", "9", "/tmp", "h1", "", "", "", 2, ""), ("c", "scan.pdf", "9", "/x", "h1", "", "", "secret", 3, ""),
        ("d", "one.pdf", "500", "/x", "h2", "G1", "exact", "", 4, ""), ("e", "one b.pdf", "400", "/x", "h3", "G1", "exact", "", 5, ""), ("f", "one c.pdf", "100", "/x", "h3", "", "", "", 6, ""),
        ("g", "~t", "9", "/x", "", "", "", "", 7, ""), ("h", "s.exe", "9", "/x", "", "", "", "", 8, ""), ("i", "e.txt", "0", "/x", "", "", "", "", 9, ""), ("j", "p.pdf", "99", None, "", "", "", "", 10, ""), ("k", None, None, "/k", None, None, None, None, 11, None),
    ]
    df = spark.createDataFrame([tuple(r) for r in rows], SIEVE_CASE).withColumn("extension", F.lower(F.regexp_extract(F.coalesce("name", F.lit("")), r"\.(\w+)$", 1)))
    corpus, groups = sieve.corpus_sieve(df, c, ("at", "file_id"))
    got = {r["file_id"]: r for r in corpus.collect()}
    assert corpus.columns == list(sieve.CORPUS_COLUMNS) and len(got) == len(rows)
    # h3 has a member in a group that is there already, so it makes none of its own
    assert {i: (got[i]["duplicate_group_id"], got[i]["canonical_file_id"]) for i in "abcdef"} == {"a": ("EXACT-SIEVE-00002", "a"), "b": ("EXACT-SIEVE-00002", "a"), "c": ("EXACT-SIEVE-00002", "a"), "d": ("G1", "d"), "e": ("G1", "d"), "f": ("", "f")}
    status = {i: r["corpus_status"].replace("CORPUS_", "") for i, r in got.items()}
    assert status == {"a": "KEEP_CANONICAL", "b": "SUPPRESS_EXACT_DUPLICATE", "c": "HOLD_SENSITIVE", "d": "KEEP_CANONICAL", "e": "SUPPRESS_EXACT_DUPLICATE", "f": "KEEP_CANONICAL", "g": "EXCLUDE_TEMP", "h": "EXCLUDE_INSTALLER", "i": "EXCLUDE_EMPTY", "j": "REVIEW_UNKNOWN_VALUE", "k": "KEEP_CANONICAL"}
    actions = {r["file_id"]: r["dedup_action"] for r in sieve.dedup_actions(corpus).collect()}
    assert actions == {"a": "CANONICAL_KEEP", "b": "EXACT_DUPLICATE_DELETE_CANDIDATE", "c": "DEDUP_HOLD_SENSITIVE", "d": "CANONICAL_KEEP", "e": "EXACT_DUPLICATE_DELETE_CANDIDATE"}
    assert sieve.canonical_map(corpus).count() == 5 and sieve.manifest(corpus).count() == len(rows) and groups.count() == 2
    m = sieve.metrics(corpus).first()
    assert len(m) == 16 and (m["exact_duplicate_groups"], m["canonical_keep"], m["exact_duplicate_files_suppressed"], m["excluded_files"], m["hold_files"], m["review_queue"]) == (2, 4, 3, 3, 1, 2)
    assert {r["file_id"] for r in sieve.excluded(corpus).collect()} == set("beghi") and {r["file_id"] for r in sieve.review_queue(corpus).collect()} == set("cj") and sieve.kept(corpus).count() == 4
    none, no_groups = sieve.corpus_sieve(df.limit(0), c, ("at", "file_id"))
    assert none.count() == 0 and no_groups.count() == 0 and sieve.metrics(none).first()["estimated_processing_load_reduction_percent"] == 0.0
    assert [r[0] for r in spark.createDataFrame([("неизвестно",), ("Не определено",), ("UNKNOWN x",), (" ",), ("act",)], "v string").select(sieve.known(F.col("v"))).collect()] == [False] * 4 + [True]


def test_validation_and_bad_patterns_do_not_stop_a_run(spark):
    bad = [Rule("x", "filename", {"a": "b"}, patterns=("(",)), Rule("x", "filename", {"a": "b"}, tokens=("abc",)), Rule("", "nowhere", {"r": "DELETE_ALL"}, weight=1.5)]
    messages = [(lvl, m.split(":")[0]) for lvl, _, m in rules.validate(bad)]
    for want in [("error", "invalid pattern"), ("error", "duplicate id"), ("error", "rule without id"), ("error", "no selector"), ("error", "weight is not a whole number"), ("error", "forbidden action"), ("error", "unknown source nowhere"), ("warning", "short token abc")]:
        assert want in messages
    good = Rule("ok", "filename", {"a": "b"}, tokens=("word",))
    assert rules.usable([*bad, good]) == [good]
    assert not [m for m in rules.validate(packs.DEFAULT) if m[0] == "error"]


def test_packs_load_from_json(tmp_path):
    p = tmp_path / "r.json"
    p.write_text('{"rules": [{"rule_id": "a", "source": "filename", "keywords": ["x"], "regex_patterns": ["y+"], "target_fields": {"t": "v"}, "weight": 3}]}')
    assert packs.load(str(p)) == [Rule("a", "filename", {"t": "v"}, 3, ("x",), ("y+",))]


def test_rule_performance_lists_zero_hits(spark):
    scored = rules.score(PACK, items(spark, ("a", "invoice", "/x"), ("a2", "invoice", "/y")))
    got = {r["rule_id"]: r for r in rules.rule_performance(spark, PACK, scored).collect()}
    assert got["f1"]["n_files"] == 2 and got["p1"]["zero_hit"] and len(got) == len(PACK)


def test_content_counts_votes_flags_and_merge(spark):
    r = [content.ContentRule("a", ("x", "y"), (r"\d+",), targets={"t": "one"}, weight=2, flags=("f",)), content.ContentRule("b", ("z",), negatives=("stop",), targets={"t": "two"}, weight=5)]
    df = spark.createDataFrame([(1, "X y 1 22 z"), (2, "z stop"), (3, None), (4, "z")], "doc_id int, text string")
    v = {x["doc_id"]: x for x in content.content_vote(content.match_content(df, r), r).collect()}
    assert [(m["rule_id"], m["n"], m["score"]) for m in v[1]["matches"]] == [("a", 4, 8), ("b", 1, 5)]
    assert (v[1]["content_t"], v[1]["content_flags"], v[1]["content_confidence"]) == ("one", "f", "medium")
    assert v[2]["content_t"] == "" and v[3]["matches"] == [] and v[4]["content_t"] == "two"
    m = content.merge_with_metadata(content.content_vote(content.match_content(df, r), r), "t", F.when(F.col("doc_id") == 1, "other").otherwise(F.lit(None)))
    assert {x["doc_id"]: (x["merged"], x["content_conflict"]) for x in m.collect()} == {1: ("other", True), 2: ("", False), 3: ("", False), 4: ("two", False)}


def test_every_row_has_one_status(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, size int")
    out = sieve.decide(df, [sieve.Decision("A", "small", F.col("size") < 10), sieve.Decision("B", "any", F.col("size") < 100)])
    assert {r["id"]: r["status"] for r in out.collect()} == {1: "KEEP", 2: "A", 3: "B"}
    assert sieve.decide(df, []).where("status = 'KEEP'").count() == 3


@pytest.mark.parametrize("size,ext,want", [("0", "pdf", True), ("16", "pdf", True), ("17", "pdf", False), ("64", "txt", True), ("x", "txt", False), (None, "txt", False)])
def test_near_empty(spark, size, ext, want):
    df = spark.createDataFrame([(size, ext)], "s string, e string")
    assert df.select(sieve.near_empty(F.col("s"), F.col("e"))).first()[0] is want
