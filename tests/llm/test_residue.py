import pytest

pytest.importorskip("tidemark.llm")

from tidemark.llm import residue as R

PROSE = "The engineer checked the lift before noon and signed the log. Гость оплатил счёт при выезде и получил ключи от номера. "


@pytest.mark.parametrize(
    "mark",
    ["{{ name }}", "{{first_name}}", "${amount}", "{% date %}", "[[ city | default ]]", "[укажите адрес]", "[должность]", "<<owner>>", "<Имя гостя>", "<TODO: sum>", "<?= total ?>", "<%= total %>", "&lt;name&gt;", "@@sum@@", "%(name)s", "%дата%",
     "#этаж#", "~срок~", "*|FNAME|*", "(указать: срок)", "(insert date here)", "{этаж}", "[object Object]", "undefined", "NaN", "NULL", "#REF!", "#ИМЯ?", "???", "№ ХХХХ", "XXX-XXX", "DD/MM/YYYY", "ДД.ММ.ГГГГ"],
)
def test_placeholders_in_prose(mark):
    assert R.residue_kind(f"{PROSE}Договор {mark} заключён между сторонами. {PROSE}") == "placeholder"


@pytest.mark.parametrize(
    "text",
    [
        "Write to <eng@hotel.example> for an answer.", "<s> и </s> — служебные строки выгрузки.", 'Lock export: {"room": 12, "state": null, "ok": "undefined behaviour"}.'.replace("undefined behaviour", "yes"), "См. [см. приложение 3], сноски [1] и [2] даны в конце.",
        "Rates 10%/20%/30% by season, a 5%-discount.", "The filter is rate > 3 and rate < 9.", "x=0;y=1;;z==2 && !(a||b)", "Подпись: ____________ / Дата: __.__.____ (заполняется от руки).", "Раздел XXIX, размер XXL.", "Null balance was carried over.",
        "None of the guests complained.", "The term is undefined in the annex.", "In our letter template the placeholder «{{guest_name}}» stands for the name of the guest, and nobody types it by hand before the letter is sent out to the owner.",
        "Use it like this:\n```\nHello {{ name }}\n```\nand the reader sees the name. " + PROSE, "#tag1 #tag2 and #tag3", "about ~5 or ~6 rooms", "Call `${HOME}` the home folder. " + PROSE,
        "Бар «Лорем» и кафе Ipsum работают до полуночи.", "Текст памятки будет добавлен к договору приложением 3.", "The sample of linen was returned, replace 3 pieces.", "да, да, да, хорошо",
        "Гость сообщил, что на сайте видел надпись «404 Not Found», причина найдена и устранена в тот же день.", "In the extranet settings please enable JavaScript, otherwise the rate calendar stays empty; the change took 4 minutes.",
        "Площадка требует cookies только для входа партнёров, гостям это не мешает.", "Сервер бронирования вернул ошибку 503 дважды за ночь, гостей заселили по бумажному журналу.", "Room 12 is closed to guests, access is denied to contractors.",
        "", "  \n", "слово", None,
    ],
)
def test_what_is_no_residue(text):
    assert R.residue_kind(text) is None


@pytest.mark.parametrize("passage", ["Lorem ipsum dolor sit amet consectetur adipiscing elit.", "Aliqua magna dolore ut labore incididunt tempor eiusmod sed do.", "рыба рыба рыба рыба", "blah blah blah", "asdf qwer hjkl", "йцук фыва олдж", "Click to add a title.", "Сюда впишите заголовок раздела.", "Образец абзаца под замену.", "Здесь будет описание услуги.", "Placeholder text goes here."])
def test_filler_passages(passage):
    assert R.residue_kind(f"{PROSE}{passage} {PROSE}") == "filler"


@pytest.mark.parametrize(
    "page",
    ["404 Not Found", "Memo 17\n\nHTTP 503\nReload the page or go back to the start.", "Menu | Rooms | Contacts\nДля просмотра портала необходимо включить JavaScript для этого сайта.", "Please enable JavaScript and cookies to open the document.", '{"error": {"code": 500, "reason": "Ошибка шлюза"}}',
     "Traceback (most recent call last):\n  File \"a.py\", line 3, in run\nTimeoutError: read timed out after 5s", "ДОСТУП ЗАПРЕЩЁН!", "Session expired\nPlease sign in again to continue.", "Checking your browser before access, this takes a few seconds."],
)
def test_error_pages(page):
    assert R.residue_kind(page) == "error_page"
    assert R.residue_kind(page + "\n" + PROSE * 3) is None


def test_very_long_text_is_read_to_its_end():
    assert R.residue_kind(PROSE * 2000 + "Client {{ name }}.") == "placeholder"
    assert R.residue_kind(PROSE * 2000) is None
    assert R.residue_kind("404 Not Found\n" * 500) == "error_page"


def test_frames_with_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "404 Not Found", "x"), (1, "404 Not Found", "x"), (2, None, "x"), (None, "{{ a }}", "x")], "doc_id bigint, text string, kind string")
    assert sorted((r["doc_id"] or 0, r["kind"]) for r in R.find_residue(df).collect()) == [(0, "placeholder"), (1, "error_page"), (1, "error_page")]
    assert R.find_residue(df.limit(0)).count() == 0
