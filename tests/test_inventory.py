import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import duplicates as D
from tidemark.operators import summaries as S
from tidemark.sources import extract, readers, sinks
from tidemark.streaming import listing_stream

FILES = "file_id string, name string, size bigint, modified_time string, md5_checksum string, content_text_hash string, listed_at int, extension string, mime_type string, department_suggestion string, document_type_suggestion string, object_kind string, trashed boolean"


def f(i, md5="", name="n", size=1, t="2025", h="", at=0, kind="file", trashed=False):
    return (i, name, size, t, md5, h, at, "pdf", "m", "d", "t", kind, trashed)


def test_groups_numbering_canonical_and_ties(spark):
    rows = [f("a", "x", at=5), f("b", "x", at=6, t="2026"), f("c", "y", at=1), f("d", "y", at=2), f("d", "y", at=2), f("e", "z", at=0), f("g", None, h=None, at=0), f("h", "x", size=2, at=0), f("i", "", h="q", at=9), f("j", "", h="q", at=8)]
    df = D.eligible(spark.createDataFrame([*rows, f("folder", "x", kind="folder"), f("gone", "x", trashed=True)], FILES))
    got = {r["group_id"]: r for r in D.groups(df, D.content_key(), "EXACT").collect()}
    assert set(got) == {"EXACT-00001", "EXACT-00002", "EXACT-00003"}
    assert (got["EXACT-00001"]["canonical_id"], got["EXACT-00001"]["n_rows"], got["EXACT-00001"]["n_files"]) == ("c", 3, 2)
    assert got["EXACT-00002"]["canonical_id"] == "b" and got["EXACT-00003"]["canonical_id"] == "j"
    m = D.members(df, D.content_key(), "EXACT").collect()
    assert sorted((r["file_id"], r["is_canonical"]) for r in m) == [("a", False), ("b", True), ("c", True), ("d", False), ("i", False), ("j", True)]
    assert D.groups(df.limit(0), D.content_key(), "EXACT").count() == 0


def test_precedence_of_passes(spark):
    rows = [f("a", "x", "Act 123456 v1"), f("b", "x", "Act 123456 v2"), f("c", "p", "Act 123456 final"), f("d", "q", "Plan v1"), f("e", "r", "Plan v2")]
    got = {r["file_id"]: r["kind"] for r in D.all_duplicates(spark.createDataFrame(rows, FILES)).collect()}
    assert got == {"a": "exact", "b": "exact", "c": "semantic_candidate", "d": "version_candidate", "e": "version_candidate"}


def test_numbers_are_consecutive_across_parts(spark):
    rng = random.Random(0)
    df = spark.createDataFrame([(i,) for i in rng.sample(range(10_000), 500)], "v int")
    got = sorted((r["v"], r["number"]) for r in D.number(df, "v", parts=7).collect())
    assert [n for _, n in got] == list(range(1, 501))


def test_summary_cube_sample_and_cap(spark):
    df = spark.createDataFrame([("a", " "), ("a", None), ("b", "x")], "k string, v string")
    assert sorted(tuple(r) for r in S.summary(df, "k", "v").collect()) == [("k", "a", 2), ("k", "b", 1), ("v", "(empty)", 2), ("v", "x", 1)]
    assert S.summary(df.limit(0), "k").count() == 0
    ids = spark.range(1000).select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("s"), F.col("id").cast("string").alias("k"))
    one = {tuple(r) for r in S.stratified_sample(ids, "s", "k", 5, 1).collect()}
    assert one == {tuple(r) for r in S.stratified_sample(ids.repartition(7), "s", "k", 5, 1).collect()} and len(one) == 15
    assert one != {tuple(r) for r in S.stratified_sample(ids, "s", "k", 5, 2).collect()}
    capped = S.first_within(spark.range(20), ["id"], 3, F.col("id") % 2 == 1)
    assert sorted(r["id"] for r in capped.where("admitted").collect()) == [1, 3, 5]


def test_rates(spark):
    usage = spark.createDataFrame([("x", "pdf", 10), ("x", "pdf", 1), ("y", "none", 5)], "who string, kind string, units int")
    rates = spark.createDataFrame([("pdf", 2, 1, 0.5)], "kind string, unit_size int, free_units int, rate double")
    got = {(r["who"], r["kind"]): (r["units"], r["cost"]) for r in S.rate_rollup(usage, rates, "who").collect()}
    assert got == {("x", "pdf"): (11, 2.25), ("y", "none"): (5, 0.0)}


def test_forbidden_recommendations_fail(spark):
    ok = spark.createDataFrame([("KEEP",), (None,)], "r string")
    assert S.assert_advisory(ok, "r").count() == 2
    with pytest.raises(Exception, match="forbidden recommendation"):
        S.assert_advisory(spark.createDataFrame([("DELETE_FILE",)], "r string"), "r").collect()


LISTED = [
    {"id": "1", "name": "A.PDF", "mimeType": "application/pdf", "size": "12", "parents": ["p", "q"], "owners": [{"displayName": "", "emailAddress": "a@b"}, {"displayName": "Bo"}], "trashed": False, "capabilities": {"canEdit": True, "canShare": False}},
    {"id": "2", "name": "Dir", "mimeType": readers.FOLDER, "size": "x1"}, {"id": "3", "name": "S.x", "mimeType": readers.SHEET, "trashed": True},
]


def test_listing_rows(spark, tmp_path):
    p = tmp_path / "l.json"
    p.write_text("\n".join(map(json.dumps, LISTED)))
    got = {r["file_id"]: r for r in readers.to_items(readers.read_listing(spark, f"file://{p}", True)).collect()}
    assert (got["1"]["extension"], got["1"]["size"], got["1"]["parents"], got["1"]["owners"], got["1"]["permissions"]) == ("pdf", 12, "p;q", "a@b;Bo", "canEdit")
    assert (got["2"]["object_kind"], got["2"]["size"], got["2"]["parents"]) == ("folder", None, "") and (got["3"]["object_kind"], got["3"]["extension"]) == ("skipped_sheet", "")
    assert readers.read_listing(spark, f"file://{p}").count() == 2


def test_paged_source_reads_each_line_once_and_filters(spark, tmp_path):
    p = tmp_path / "l.jsonl"
    p.write_text("\n".join(json.dumps({"id": str(i), "name": "n" * (i % 13), "trashed": i % 5 == 0, "driveId": f"d{i % 2}"}) for i in range(300)) + "\n")
    readers.register_listing(spark)
    df = spark.read.format("paged_listing").option("path", str(p)).option("pageSize", "777").load()
    assert sorted(int(r["id"]) for r in df.collect()) == list(range(300))
    assert df.where("trashed = false and driveId = 'd1'").count() == sum(1 for i in range(300) if i % 5 and i % 2)
    assert readers.get_object(df, "7").count() == 1
    p.write_text("\n".join(json.dumps({"id": str(i), "parents": [f"p{i % 4}", "q"], "owners": [{"displayName": "Bo"}]}) for i in range(40)))
    one = spark.read.format("paged_listing").option("path", f"file://{p}").option("parent", "p1").load()
    assert one.count() == 10 and readers.to_items(one).first()["owners"] == "Bo"


def test_registry_and_flags(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_bytes("﻿file_id,name\n1,\"a,\nb\"\n2,\n".encode())
    df = readers.read_registry(spark, f"file://{p}")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "a,\nb"), ("2", "")]
    flags = spark.createDataFrame([("1", 1, "old", "c"), ("1", 2, "new", "c")], "file_id string, seq int, flag string, name string")
    got = sorted(tuple(r) for r in readers.with_flags(df, flags).select("file_id", "flag", "flag_name").collect())
    assert got == [("1", "new", "c"), ("2", "", "")]


def docx(text):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/header1.xml", "<h><t>top</t></h>")
        z.writestr("word/document.xml", f"<d xmlns:w='u'><w:p><w:t>{text}</w:t></w:p></d>")
        z.writestr("word/styles.xml", "<s><t>style</t></s>")
    return b.getvalue()


def xlsx():
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<s><si><t>shared</t></si></s>")
        z.writestr("xl/worksheets/sheet1.xml", "<w><row><c t='s'><v>0</v></c><c><v>42</v></c></row>" + "<row><c><v>7</v></c></row>" * 300 + "</w>")
    return b.getvalue()


RTF = rb"{\rtf1\ansi\ansicpg1251{\fonttbl{\f0 Arial;}}{\*\generator x;}\b \'cf\'f0\'e8\b0  \u1078?\u-10179?\u-8704? \{x\}\par caf\'e9\line end}"


def test_extraction_by_kind(spark):
    rows = [("t", "txt", "", b"plain \xff"), ("h", "html", "", b"<b>x</b>&amp;"), ("d", "docx", "", docx("hello")), ("x", "xlsx", "", xlsx()), ("bad", "docx", "", b"no zip"), ("p", "pdf", "", b"%PDF (some text) Tj"), ("i", "png", "", b"\x89"), ("u", "bin", "", b"?"), ("n", "txt", "", None), ("m", "", "text/html", b"<i>y</i>"), ("e", "txt", "", b""), ("r", "rtf", "", RTF), ("c", "csv", "", b'a,"b\nc"\n1,2'), ("g", "", readers.NATIVE + "document", b"exported"), ("s", "", readers.SHEET, b"x")]
    df = spark.createDataFrame(rows, "file_id string, extension string, mime_type string, content binary")
    got = {r["file_id"]: (r["text"], r["status"]) for r in extract.extract(df).collect()}
    assert got["t"] == ("plain �", "extracted") and got["h"] == ("x &", "extracted") and got["d"] == ("hello\ntop", "extracted") and got["x"] == ("shared | 42" + "\n7" * 300, "extracted") and got["bad"] == ("", "error:BadZipFile")
    assert got["p"] == ("some text", "extracted") and got["i"] == ("", "ocr_unavailable") and got["u"] == ("", "unsupported") and got["n"] == ("", "no_content") and got["m"] == ("y", "extracted") and got["e"] == ("", "extracted")
    assert got["r"][0] == "При ж😀 {x}\ncafй\nend" and got["c"][0] == "a b\nc\n1 2" and got["g"] == ("exported", "extracted") and got["s"] == ("", "refused")
    cut = {r["file_id"]: r for r in extract.describe(extract.extract(df, most_chars=4, rows=200)).collect()}
    assert cut["x"]["status"] == "truncated" and cut["x"]["content_text_hash"] == "" and cut["h"]["status"] == "extracted"
    seen = extract.extract(df).join(df.drop("content"), "file_id")
    assert [tuple(r) for r in extract.ocr_statuses(seen).collect()] == [("i", "ocr_unavailable")]
    d = {r["file_id"]: r for r in extract.describe(extract.extract(df)).collect()}
    assert "text" not in d["t"].asDict() and d["h"]["content_length"] == 3 and d["u"]["content_text_hash"] == ""


def test_hashes_of_content_and_of_exports(spark):
    df = spark.createDataFrame([("a", "application/pdf", b"x"), ("b", readers.NATIVE + "document", b"x"), ("c", readers.SHEET, b"x"), ("d", "t", b"too long"), ("e", "t", None)], "i string, mime_type string, content binary")
    got = {r["i"]: (r["content_hash"] != "", r["export_hash"] != "") for r in readers.content_hashes(df, 4).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (False, False), "d": (False, False), "e": (False, False)}


def test_typed_registry(spark):
    df = spark.createDataFrame([("1", " 12 ", "Yes"), ("2", "1.9", ""), ("3", "x", "0")], "id string, size string, f string")
    assert [tuple(r) for r in readers.typed_registry(df, ("size",), ("f",)).orderBy("id").collect()] == [("1", 12, True), ("2", 1, False), ("3", 0, False)]


def test_admission_with_null_order_values_and_ties(spark):
    df = spark.createDataFrame([(None, "a", True), (1, "b", True), (2, "c", True), (None, "d", False), (1, "b", True)], "at int, id string, ok boolean")
    got = sorted((r["id"], r["admitted"]) for r in S.first_within(df, ["at", "id"], 2, F.col("ok")).collect())
    assert got == [("a", True), ("b", True), ("b", True), ("c", False), ("d", False)]
    assert S.first_within(df.limit(0), ["at"], 2, F.col("ok")).count() == 0


def test_percentiles_of_a_hot_group_are_exact(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(10**6)) for _ in range(900)] + [("few", 5), ("few", 5), (None, 7), ("none", None)]
    got = {r["k"]: r for r in S.percentiles(spark.createDataFrame(rows, "k string, v int"), "k", "v").collect()}
    v = sorted(x for k, x in rows if k == "hot")
    assert [got["hot"][f"p{p}"] for p in (50, 90, 95, 99)] == [v[max(1, -(-len(v) * p // 100)) - 1] for p in (50, 90, 95, 99)]
    assert got["few"]["p50"] == 5 and got[""]["n"] == 1 and "none" not in got


def test_counts_in_order_of_appearance(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 5), ("b", 3), ("c", 0), (" ", 4)], "v string, at int")
    assert [tuple(r) for r in S.ordered_counts(df, "v", ("at",)).orderBy("place").collect()] == [("b", 2, 1), ("a", 2, 2), ("c", 1, 3), ("(empty)", 1, 4)]


def test_a_hot_key_is_spread_over_tasks(spark):
    """A key with a third of all rows: no task of the joins and aggregates reads much more than its share."""
    n = 30_000
    rows = spark.range(n, numPartitions=8).select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("file_id"), F.col("id").cast("int").alias("listed_at"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.col("id").alias("size"),
        F.lit("2025").alias("modified_time"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("md5_checksum"), F.lit("").alias("content_text_hash"),
    )
    key = F.col("md5_checksum")
    m = D.members(rows, key, "EXACT")
    assert m.count() == n
    top = {r["key"]: r for r in D.groups(rows, key, "EXACT").where("key = 'hot'").collect()}["hot"]
    assert top["n_files"] == n // 3 and top["canonical_id"] == f"f{n - 3}"
    # before keys are reduced, rows are dealt by (key, id) and (key, rank), never by the key alone
    per = rows.withColumn("__key", key).groupBy("__key", "file_id").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in per.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 1.3 * n / len(sizes)


def test_bytes_above_the_limit_keep_no_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"123")
    (tmp_path / "b.bin").write_bytes(b"123456")
    got = {r["path"][-5:]: (r["status"], r["content_hash"] != "") for r in readers.content_hashes(readers.read_bytes(spark, f"file://{tmp_path}/*.bin", 4)).collect()}
    assert got == {"a.bin": ("ok", True), "b.bin": ("file_too_large", False)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], 1)], "k string, l array<string>, n int")
    sinks.write_csv(df, f"file://{tmp_path}/c", ["k", "l"], {"k": "Ключ"})
    assert [tuple(r) for r in readers.read_registry(spark, f"file://{tmp_path}/c").collect()] == [("a", "x;y")]
    sinks.append_jsonl(df, f"file://{tmp_path}/j")
    sinks.append_jsonl(df, f"file://{tmp_path}/j")
    assert spark.read.json(f"file://{tmp_path}/j").count() == 2
    assert json.loads(sinks.metrics_json(df))["n"] == 1 and sinks.markdown_table(df).count("\n") == 3


def test_streamed_listing_equals_the_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps({"id": f"{i}-{k}", "name": "n.txt", "mimeType": "text/plain"}) for k in range(4)))
    seen = []
    listing_stream.run_available(listing_stream.listing_stream(spark, f"file://{tmp_path}/in"), lambda df, n: seen.extend(r["file_id"] for r in df.collect()), f"file://{tmp_path}/cp")
    assert sorted(seen) == sorted(f"{i}-{k}" for i in range(3) for k in range(4))
    (tmp_path / "in" / "9.json").write_text(json.dumps({"id": "new", "name": "x", "mimeType": ""}))
    more = []
    listing_stream.run_available(listing_stream.listing_stream(spark, f"file://{tmp_path}/in"), lambda df, n: more.extend(r["file_id"] for r in df.collect()), f"file://{tmp_path}/cp")
    assert more == ["new"]


def test_windows_and_sessions(spark):
    df = spark.createDataFrame([("a", "2025-01-01 00:10:00"), ("a", "2025-01-01 00:30:00"), ("a", "2025-01-01 05:00:00"), ("b", "2025-01-01 00:50:00")], "k string, t string").select("k", F.to_timestamp("t").alias("t"))
    assert sorted(r["n"] for r in listing_stream.windowed_counts(df, "t", "k").collect()) == [1, 1, 2]
    assert sorted(r["n"] for r in listing_stream.sessions(df, "t", "k").collect()) == [1, 1, 2]


def test_first_seen_and_subtrees(spark, tmp_path):
    from tidemark.operators import hierarchy

    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps({"id": x, "name": "n", "mimeType": ""}) for x in ("a", "b", "a")))
    stream = listing_stream.listing_stream(spark, f"file://{tmp_path}/in").withColumn("at", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    seen = []
    listing_stream.run_available(listing_stream.first_seen(stream, "at"), lambda df, n: seen.extend(r["file_id"] for r in df.collect()), f"file://{tmp_path}/cp")
    assert sorted(seen) == ["a", "b"]
    tree = spark.createDataFrame([("a", []), ("b", ["a"]), ("c", ["b", "a"]), ("x", []), ("l", None)], "file_id string, ancestors array<string>")
    assert sorted(r["file_id"] for r in hierarchy.subtree(tree, ["b", "l"]).collect()) == ["b", "c", "l"]
    kids = spark.createDataFrame([("f", "a;b; "), ("f", "a"), ("g", None)], "file_id string, parents string")
    assert sorted(tuple(r) for r in hierarchy.children(kids).collect()) == [("a", "f"), ("b", "f")]


def test_percentiles_by_nearest_rank(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(20)])) for _ in range(300)]
    got = {r["k"]: tuple(r)[1:] for r in S.percentiles(spark.createDataFrame(rows, "k string, v int"), "k", "v").collect()}
    for k in ("a", "b", ""):
        v = sorted(x for g, x in rows if (g or "") == k and x is not None)
        assert got[k] == (len(v), *(v[max(1, -(-len(v) * p // 100)) - 1] for p in (50, 90, 95, 99)))


def test_code_reaches_workers_that_lack_the_package(spark):
    from tidemark.session import ship

    ship(spark)
    names = [p for p in spark.sparkContext._python_includes if p.startswith("code-")]
    assert len(names) == 1
