import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import text as X


def one(spark, value, *exprs):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(*(e.alias(f"e{i}") for i, e in enumerate(exprs))).first()


CASES = {
    "Invoice_2024-final.PDF": ("invoice 2024 final.pdf", "pdf"), "  Act  №5 .docx": ("act no5 .docx", "docx"), ".hidden": (".hidden", ""), "no ext": ("no ext", ""), "a.tar.gz": ("a.tar.gz", "gz"),
    "Ёлка.ＰＤＦ": ("елка.pdf", ""), "x.averylongsuffix": ("x.averylongsuffix", ""), "": ("", ""), "ﬁle.txt": ("file.txt", "txt"),
}


def test_names_and_extensions(spark):
    for value, (norm, ext) in CASES.items():
        got = one(spark, value, X.normalize_name("c"), X.split_extension("c"))
        assert got[0] == norm, value
        if "ＰＤＦ" not in value:
            assert got[1] == ext, value
    assert one(spark, None, X.normalize_name("c"), X.split_extension("c")) == (None, "")


def test_native_documents_have_no_extension(spark):
    df = spark.createDataFrame([("report.v2", "application/vnd.google-apps.document"), ("report.v2", None)], "n string, m string")
    assert [r[0] for r in df.select(X.split_extension("n", "m")).collect()] == ["", "v2"]


@pytest.mark.parametrize("name,base", [("Contract 12 final", "contract 12"), ("Contract 12 v2", "contract 12"), ("Contract 12 (1)", "contract 12"), ("Contract 12 copy (копия)", "contract 12"), ("Plan 2024-05-06", "plan"), ("finalist report", "finalist report"), ("renewal v", "renewal v")])
def test_version_markers(spark, name, base):
    assert one(spark, name, X.strip_version_markers("c"))[0] == base


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs"]), max_size=12), min_size=1, max_size=20))
def test_compatibility_forms_agree_with_unicode(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    for r in df.select("i", X.nfkc("c").alias("o")).collect():
        assert r["o"] == unicodedata.normalize("NFKC", values[r["i"]])


def test_entities_and_features_of_names(spark):
    t = "/Корпус/Договор № A-12/7 ООО Двор, ИНН 7701234567 апарт. 204 счёт 55-1 от 1.2.2024, 77:01:0001234:56, +7 (495) 123-45-67.pdf"
    got = {e: one(spark, t, X.entity("c", e, table=X.NAME_ENTITIES))[0] for e in X.NAME_ENTITIES}
    want = {"contract_number": "A-12/7", "tax_number": "7701234567", "unit_number": "204", "invoice_number": "55-1", "date": "1.2.2024", "year": "2024", "land_number": "77:01:0001234:56", "phone": "+7 (495) 123-45-67", "legal_form_marker": "ООО", "passport_marker": "", "bank_account": ""}
    assert {k: got[k] for k in want} == want and len(got) == 21
    f = X.name_features("c")
    got = dict(zip(f, one(spark, "акт 7 и акт 12/3, договор-55, unit 204 room #12 от 01.02.2024, реестр r1 invoice 9 2019 2019", *f.values())))
    assert got == {"years": ["2019", "2024"], "dates": ["01.02.2024"], "units": ["12", "204"], "contracts": ["55"], "acts": ["12/3", "7"], "invoices": ["9"], "registries": ["r1"]}
    assert all(v == [] for v in one(spark, None, *f.values()))


def test_entities_language_and_paths(spark):
    t = "Договор № 123/4 заключён сторонами 01.02.2024, e-mail a.b@c.example, тел. 495 123-45-67"
    got = one(spark, t, *(X.entity("c", e) for e in ("contract", "date", "email", "phone", "year", "invoice")), X.guess_language("c"))
    assert tuple(got) == ("123/4", "01.02.2024", "a.b@c.example", "495 123-45-67", "2024", "", "ru")
    assert tuple(one(spark, None, X.entity("c", "email"), X.guess_language("c"), X.path_depth("c"))) == ("", "unknown", 0)
    assert tuple(one(spark, "/a/b/c", X.path_depth("c"), X.sanitize_path("c"))) == (2, "/a/.../c")
    assert one(spark, "abя", X.guess_language("c"))[0] == "en"


def test_reasons_booleans_markup(spark):
    df = spark.createDataFrame([("a", "b"), ("a; b", "b"), (None, "x"), ("a", None)], "o string, n string")
    assert [r[0] for r in df.select(X.append_reason("o", "n")).collect()] == ["a; b", "a; b", "x", "a"]
    assert [one(spark, v, X.as_bool("c"))[0] for v in ("1", "TRUE", " yes ", "y", "on", "no", "", None)] == [True] * 5 + [False] * 3
    html = "<p>a &amp; b</p><script>x<y</script><!-- c --> &lt;d&gt;&nbsp;e"
    assert one(spark, html, X.strip_markup("c"))[0] == "a & b <d> e"
    assert one(spark, "caf&eacute; &#169; &hellip; &amp;lt; AT&T <b>x</b>", X.strip_markup("c"))[0] == "café © … &lt; AT&T x"


def test_words_are_unicode(spark):
    rng = random.Random(0)
    for _ in range(20):
        v = "".join(rng.choices(list("aЯ1_ .-é№"), k=12))
        assert one(spark, v, X.words("c"))[0] == re.findall(r"[^\W]+", v.replace("№", "."))


def test_decomposed_names_are_those_of_their_composed_twins(spark):
    names = ["Счёт 12 финал", "регламент копия й", "Акт приёмки", "Café №5…", "각 ㍿ ﷺ ⑽", "x\u0323\u0307"]
    for name in names:
        for form in ("NFD", "NFKD", "NFC"):
            got = one(spark, unicodedata.normalize(form, name), X.normalize_name("c"), X.strip_version_markers("c"))
            want = " ".join(unicodedata.normalize("NFKC", name).lower().replace("ё", "е").split())
            assert got[0] == want
            assert got[1] == one(spark, name, X.strip_version_markers("c"))[0]
    assert one(spark, "Сче\u0308т 12 фина\u043b", X.strip_version_markers("c"))[0] == "счет 12"
