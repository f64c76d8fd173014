import itertools

import pytest

pytest.importorskip("tidemark.llm")

from tidemark.llm import lookalike as L

SAME = [
    ["Договор 12.pdf", "Догoвoр 12.pdf", "Договор 12.pdf", "Дог​овор 12.pdf", "Договор 12.pdf ", "Договор １２.ｐｄｆ", "Договор  12.pdf"],
    ["Café menu", "Café menu", "Саfé menu"],
    ["Клей", "Клей", "Kлей"],
    ["План ёлки", "План ёлки", "План ëлки"],
    ["ﬁle-1", "file‑1", "file‐1"],
    ["good", "ɡood", "gооd"],
    ["2-1", "2−1"],
    ["a/b", "a⁄b"],
    ["x,y", "x‚y"],
    ["Report IV", "Report Ⅳ"],
    ["アイ", "ｱｲ"],
    ["S1", "Տ1", "Ѕ1"],
    ["Totals...", "Totals…"],
    ["Πr", "Пr"],
]
OTHER = ["Cafe menu", "Клеи", "Договор 13.pdf", "договор 12.pdf", "План елки", "file_1", "", "Договор12.pdf", "readme.txt", "No 5", "№ 5", "2–1", "m2", "m²", "Il1", "lI1", "1l", "30", "З0", "ґ", "r", "г", "土", "士", "nr", "пr", "x2", "×2"]


def test_pairs_and_visible_differences(spark):
    names = [n for group in SAME for n in group] + OTHER + ["readme.txt"] * 5
    rows = [(f"id{i:03d}", n) for i, n in enumerate(names)] + [("null", None)]
    objects = spark.createDataFrame(rows, "file_id string, name string")
    got = {tuple(r) for r in L.look_alike_pairs(objects, L.classes(objects)).collect()}
    cls = {n: k for k, group in enumerate(SAME) for n in group}
    want = {(a, b) for (a, x), (b, y) in itertools.combinations(rows[:-1], 2) if x != y and x in cls and cls[x] == cls.get(y)}
    assert got == want


def test_links_count_what_the_pairs_list(spark):
    rows = [(f"{i}-{k}", n) for i, n in enumerate(n for group in SAME for n in group) for k in range(1 + i % 3)] + [("null", None), ("z", "alone")]
    objects = spark.createDataFrame(rows, "file_id string, name string")
    forms = L.classes(objects)
    pairs = [tuple(r) for r in L.look_alike_pairs(objects, forms).collect()]
    got = {r["file_id"]: r["n_links"] for r in L.links(objects, forms).collect()}
    assert got == {i: sum(i in p for p in pairs) for i, _ in rows}


def test_table_is_made_from_public_data():
    assert len(L.confusables()) > 6000 and L.skeleton("раураӏ Ⅰ օ") == "paypai l o"
    table = L._table()
    assert not any(c < "\x7f" for c in table)
    # no two letters of one alphabet become one
    for alphabet in ("абвгдежзийклмнопрстуфхцчшщъыьэюяё", "αβγδεζηθικλμνξοπρστυφχψω"):
        for letters in (alphabet, alphabet.upper()):
            assert len({table.get(c, c) for c in letters}) == len(letters)


def test_canonical_form_is_one_per_class_and_a_member(spark):
    rows = [(str(i), n) for i, n in enumerate(n for group in SAME for n in group)] + [("z", None)]
    objects = spark.createDataFrame(rows, "file_id string, name string")
    got = {r["name"]: r["canonical_name"] for r in L.canonical_names(objects, L.classes(objects)).collect()}
    for group in SAME:
        assert len({got[n] for n in group}) == 1 and got[group[0]] in group
    assert got["Догoвoр 12.pdf"] == "Договор 12.pdf" and got[None] is None


def test_a_hot_spelling_is_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(L, "MEMBERS", 7)
    rows = [(f"a{i:02d}", "scan 1") for i in range(40)] + [(f"b{i}", "scan 1") for i in range(9)] + [("c", "scаn 1")]
    objects = spark.createDataFrame(rows, "file_id string, name string")
    got = [tuple(r) for r in L.look_alike_pairs(objects, L.classes(objects)).collect()]
    assert len(got) == len(set(got)) == 40 * 9 + 40 + 9


def test_empty_table_and_current_names(spark):
    e = spark.createDataFrame([], "file_id string, name string")
    assert L.look_alike_pairs(e, L.classes(e)).count() == 0
    df = spark.createDataFrame([("a", "old", 1, "x"), ("a", "new", 2, "x"), ("a", "new", 2, "x"), (None, "q", 1, "x")], "file_id string, name string, listed_at int, key string")
    assert [tuple(r) for r in L.current_names(df).collect()] == [("a", "new")]
