import os
import zipfile

import pytest

from tidemark import packs
from tidemark.__main__ import main
from tidemark.operators.rules import Rule
from tidemark.plans import pipeline, problem_queries, reference_queries, report_queries
from tidemark.sources import sinks

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@needs_data
def test_full_run(spark, tmp_path):
    got = pipeline.run(spark, SF, f"file://{tmp_path}/out", "full")
    assert got["all_objects"] == spark.read.parquet(f"{SF}/inventory_items.parquet").select("file_id").distinct().count()
    assert got["strategy_differences"] == 0 and got["classified"] == got["all_objects"]
    paths = spark.read.parquet(f"file://{tmp_path}/out/all_objects")
    true = {r["file_id"]: r["full_path"] for r in problem_queries.p6_paths(spark, SF).collect()}
    for r in paths.where("object_kind = 'folder'").collect():
        if true[r["file_id"]] is not None:
            assert r["full_path"] == true[r["file_id"]]
    assert pipeline.run(spark, SF, f"file://{tmp_path}/out2", "inventory").keys() < got.keys()
    assert {"content_inspection", "content_rule_matches", "content_flags", "view_conflicts", "suspicious_rules"} < got.keys() and "Nothing was changed" in (tmp_path / "out" / "report.md").read_text()
    assert spark.read.parquet(f"file://{tmp_path}/out/content_inspection").where("content_status = 'extracted'").count() > 0
    sieved = pipeline.run(spark, SF, f"file://{tmp_path}/out3", "sieve")
    assert sieved["sieve_manifest"] == sieved["corpus_inventory"] > sieved["corpus_keep_canonical"] and sieved["sieve_metrics"] == 1


@needs_data
@pytest.mark.parametrize("name", sorted([*problem_queries.QUERIES, *reference_queries.QUERIES, *report_queries.QUERIES]))
def test_every_query_runs_with_a_stable_schema(spark, name):
    f = {**problem_queries.QUERIES, **reference_queries.QUERIES, **report_queries.QUERIES}[name]
    df = f(spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() >= 0


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        pipeline.run(spark, SF, "x", "dry")


def test_rule_check_from_the_command_line(tmp_path, capsys):
    assert main(["validate-rules"]) == 0
    p = tmp_path / "bad.json"
    p.write_text('[{"rule_id": "a", "regex_patterns": ["("]}]')
    assert main(["validate-rules", "--rules", str(p)]) == 1 and "invalid pattern" in capsys.readouterr().out
    assert Rule("x", "filename") not in packs.DEFAULT
    p.write_text('[{"rule_id": "a", "tokens": ["word"], "tokns": ["x"]}]')
    assert main(["validate-rules", "--rules", str(p)]) == 0 and "unknown key tokns" in capsys.readouterr().out


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([("a&b", 1, None), ("\x01c", 2, True)], "k string, n int, b boolean")
    sinks.write_workbook({"One": df, "Two": df.limit(0)}, str(tmp_path / "w.xlsx"))
    with zipfile.ZipFile(tmp_path / "w.xlsx") as z:
        assert z.testzip() is None and b"a&amp;b" in z.read("xl/worksheets/sheet1.xml") and len(z.namelist()) == 6
    with pytest.raises(ValueError, match="more than 1 rows"):
        sinks.write_workbook({"One": df}, str(tmp_path / "v.xlsx"), most=1)
    with pytest.raises(ValueError, match="characters"):
        sinks.write_workbook({"One": spark.createDataFrame([("x" * 40_000,)], "k string")}, str(tmp_path / "v.xlsx"))
    sinks.write_workbook({"a" * 40: df, "a" * 41: df}, str(tmp_path / "u.xlsx"))
    with zipfile.ZipFile(tmp_path / "u.xlsx") as z:
        assert z.read("xl/workbook.xml").count(b"<sheet ") == 2 and b"~2" in z.read("xl/workbook.xml")


def test_markdown_is_whole_or_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "k string, n int")
    assert sinks.markdown_table(df) == "| k | n |\n|---|---|\n| a\\|b | 1 |\n|  | 2 |\n"
    with pytest.raises(ValueError, match="more than 1 rows"):
        sinks.markdown_table(df, 1)
    assert sinks.checklist(df, "k") == "- [ ] a|b\n- [ ] \n"
    tree = spark.createDataFrame([("/d/a", 1), ("/d", 0), (None, 0), ("/d/a/b", 2)], "full_path string, depth int")
    assert sinks.folder_tree(tree) == "- d\n  - a\n    - b\n"
