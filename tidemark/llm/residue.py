"""Template residue, filler and error pages in texts (problem 10).

Placeholders are found by a grammar for each kind of delimiter. Where the
delimiter has other uses too, what it holds must look like a field: a
vocabulary of fields, or the shape of an identifier. A placeholder does not
count where the text talks about it: in a code block, quoted in a sentence
about templates, or in technical prose, unless such placeholders are dense. A
text is an error page if hardly anything but a title is left once errors and
the sentences that consist of the usual words of errors and notices are taken
away; that is judged by structure and shares of words, not by whole sentences.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from http import HTTPStatus

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship

#: Words besides errors and notices that a title or menu may have.
TITLE_WORDS = 9
#: Share of a sentence's words, words of grammar aside, that must be usual ones of errors and notices.
USUAL_SHARE = 0.65
#: Placeholders for each hundred words from which a text that talks about templates counts all the same.
DENSITY = 20.0

# a field's name: words that begin with a letter, joined by spaces, dots, hyphens or underscores, or broken over two lines
_NAME = r"[^\W\d][\w]*(?:(?:[ ._\-]{1,2}|-? ?\r?\n ?)\w+){0,6}"
_ASK = r"(?:insert|enter|specify|fill in|add|type|your|указать|укажите|вставить|вставьте|вписать|впишите|ввести|введите|заполнить|заполните|подставить|ваш[аие]?)"
_CITE = r"(?:см|прим|ред|цит|рис|табл|стр|гл|там же|см\.|sic|see|cf|note|fig|ibid|p|pp|ed|edit|edited|emphasis|citation|quote|image|photo|video|audio|link|file|фото|видео|файл|подпись|печать|signature|signed|stamp|sealed|redacted|inaudible|laughter|смех|неразборчиво)"
# fixed values: element names of HTML that stand alone in angle brackets, and frames of a stack trace
_MARKUP = "a abbr address article aside audio b base blockquote body br button canvas caption cite code col dd del details div dl dt em embed fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark meta nav object ol option p param pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr module lambda listcomp genexpr string stdin bos eos pad unk cls sep mask".split()
# fixed values: variables of shells and systems, and codes of currencies, that are written like placeholders
_ENVIRONMENT = "APPDATA LOCALAPPDATA PROGRAMDATA PROGRAMFILES USERPROFILE USERNAME COMPUTERNAME HOMEDRIVE HOMEPATH SYSTEMROOT SYSTEMDRIVE WINDIR COMSPEC TEMP TMP PATH PUBLIC HOME USER SHELL PWD LANG HOSTNAME EDITOR JAVA_HOME PYTHONPATH LD_LIBRARY_PATH USD AUD CAD NZD HKD SGD".split()
#: Beginnings of words that name what letters, contracts and forms leave to be filled in.
_FIELD = (
    "name first last full surname amount sum total date day month year time price cost fee company firm client customer guest manager owner tenant agent employee person address phone tel email mail number num no id code unit room floor building position "
    "title city country street region contract invoice order booking check arrival departure property deadline term detail signature recipient sender subject user account qty quantity rate currency bank passport organi department project product item "
    "имя фамил отчеств фио сумм дат ден месяц год врем цен стоимост тариф компан фирм клиент заказчик исполнител гост менеджер собственник арендатор сотрудник адрес телефон почт номер код этаж помещен апартамент корпус должност наименован названи реквизит срок город "
    "стран улиц договор счет счёт заказ брон заезд выезд подпис получател отправител пользовател количеств ставк валют банк паспорт организац отдел объект проект товар услуг"
).split()

#: (characters the text must have, grammar, whether what stands inside must look like a field) by kind of delimiter.
PLACEHOLDERS: list[tuple[str, str, bool]] = [
    ("{{", rf"\{{\{{\{{?[#/^&>]?\s*{_NAME}\s*(?:\|[^{{}}\n]*)?\}}\}}|\{{\{{[^{{}}\n]*?[^\W\d_][^{{}}\n]*\}}\}}", False),
    ("{%", rf"\{{%-?\s*{_NAME}[^{{}}%\n]*-?%\}}", False),
    ("${", rf"\$\{{\s*{_NAME}\s*(?::[^{{}}\n]*)?\}}", False),
    ("{", rf"\{{(?<![\w{{$%#\\:]\{{)\s*{_NAME}\s*\}}(?!\}})", True),
    ("{", r"\{(?<![\w{$%#\\:)\]}]\{)\d{1,2}\}(?![}{\d])", False),
    ("[[", rf"\[\[\s*{_NAME}\s*(?:\|[^\[\]\n]*)?\]\]", True),
    ("[", rf"\[(?<![\[\w\]]\[)(?!{_CITE}\b){_NAME}\](?![\[(\]])(?<!\d\])", True),
    ("[", rf"\[{_ASK}\b[^\[\]\n]+\]", False),
    ("(", rf"\((?:{_ASK})\s*:\s*[^()\n]+\)|\((?:insert|enter|type)\s[^()\n]+?\shere\)|\((?:вставить|вписать|указать)\s[^()\n]+?\s(?:здесь|сюда)\)", False),
    ("<<", rf"<<\s*{_NAME}\s*>>", True),
    ("<", rf"<(?:TODO|FIXME|TBD|XXX)\b[^<>\n]*>", False),
    ("<", rf"<(?<![\w]<)(?!/)(?!(?:{'|'.join(_MARKUP)})\b){_NAME}>(?!>)", True),
    ("<?", rf"<\?(?:=|php|php echo)?\s*\$?{_NAME}\s*;?\s*\?>", False),
    ("<%", r"<%[=\-]?[^<>%\n]*[^\W\d_][^<>%\n]*-?%>", False),
    ("&lt;", rf"&lt;(?!/)(?!(?:{'|'.join(_MARKUP)})\b){_NAME}&gt;", True),
    ("@@", rf"@@{_NAME}@@", False),
    ("%(", rf"%\({_NAME}\)[sdfr]", False),
    ("%", rf"%(?<![\w%]%){_NAME}%(?![\w%])", True),
    ("%%", rf"%%{_NAME}%%", True),
    ("#", rf"#(?<![\w#&]#)#?{_NAME}#(?!\w)", True),
    ("~", rf"~(?<![\w~]~){_NAME}~(?![\w~])", True),
    ("*|", rf"\*\|{_NAME}\|\*", False),
    ("^", rf"\^(?<![\w^]\^){_NAME}\^(?![\w^])", True),
    ("__", r"__(?<!\w__)(?![a-z]+__)[^\W_][\w]*?[^\W_]__(?![\w_])", True),
    ("|", rf"\|\|(?<![\w|*]\|\|){_NAME}\|\|(?![\w|*])", True),
    ("$", r"(?<![\w$\\/.])\$[A-Z][A-Z_]{2,}\b(?![\w(=/])|(?<![\w$\\/.])\$[a-z]+_[a-z_]+\b(?![\w(=\[/])", True),
    (":", r"(?<=[ \n(]):[a-z]+(?:_[a-z]+)+\b(?![:\w(])", True),
]

#: Values that a machine leaves where a template got none or a wrong one, case as written.
MACHINE: list[tuple[str, str]] = [
    ("[object", r"\[object [A-Z]\w*\]"),
    ("undefined", r"(?<![\w.])(?<!is )(?<!are )(?<!was )(?<!were )(?<!left )(?<!remain )(?<!remains )(?<!be )(?<!an )(?<!of )undefined(?![\w=(])"),
    ("NaN", r"(?<![\w.])NaN(?![\w(])"),
    ("NULL", r"(?<![\w.])(?<!NOT )(?<!IS )NULL(?![\w(])"),
    ("None", r"(?<![\w.\"'(=])(?<!: )None(?! of\b)(?!\s+(?:were|are|have|had|do|did|could|would|should|will|can|may|shall|remain|is|was|has|other|too|better|such|at|in|came|who|whom|but|so|that|than|ever|know|knows|knew|exists?|\w+er|\w+ed)\b)(?![\w(=])"),
    ("(null)", r"\(null\)"),
    ("Invalid", r"(?<!\w)Invalid [Dd]ate(?!\w)"),
    ("#", r"#(?:REF!?|N/A|NAME\?|VALUE!?|DIV/0!?|NUM!|NULL!|ИМЯ\?|ССЫЛКА!|ЗНАЧ!|Н/Д|ДЕЛ/0!|ЧИСЛО!|ПУСТО!)(?!\w)"),
    ("???", r"(?<![\w?!.)»”\"])\?{3}(?![?!\w])"),
    ("XX", r"(?<![\w])X{3,}(?:-X{3,})+(?!\w)|(?<!\w)X{4,}(?!\w)"),
    ("ХХ", r"(?<!\w)Х{3,}(?:-Х{3,})+(?!\w)|(?<!\w)Х{4,}(?!\w)"),
    ("DD", r"(?<!\w)DD([./\-])MM\1YY(?:YY)?(?!\w)"),
    ("MM", r"(?<!\w)(?:MM([./\-])DD\1YY(?:YY)?|YYYY([./\-])MM\2DD)(?!\w)"),
    ("ДД", r"(?<!\w)ДД([./\-])ММ\1ГГ(?:ГГ)?(?!\w)"),
    ("дд", r"(?<!\w)дд([./\-])мм\1гг(?:гг)?(?!\w)"),
]

_THING = r"(?:text|heading|headline|copy|paragraph|caption|title|subtitle|content|description|sentence|name|image)"
_RU_THING = r"(?:текст\w*|заголов\w+|абзац\w*|подпис\w+|описани\w+|содержани\w+|контент\w*)"
_PART = r"(?:блока|раздела|документа|страницы|объекта|услуги|товара|сюда|здесь|сайта|компании)"
# fixed values: words of the usual pseudo-Latin filler
_LATIN = "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
# fixed values: words of the other passage that filler is taken from
_LATIN_2 = "perspiciatis unde omnis iste natus error voluptatem accusantium doloremque laudantium totam rem aperiam eaque ipsa quae ab illo inventore veritatis quasi architecto beatae vitae dicta explicabo nemo ipsam quia voluptas aspernatur aut odit fugit".split()
# fixed values: the letter rows of two keyboards
_ROWS = ["qwertyuiop", "asdfghjkl", "zxcvbnm", "йцукенгшщзхъ", "фывапролджэ", "ячсмитьбю"]


@lru_cache(maxsize=1)
def _keys() -> frozenset[str]:
    """Words of four letters or more that run along a keyboard row."""
    return frozenset(row[i:j] for r in _ROWS for row in (r, r[::-1]) for i in range(len(r)) for j in range(i + 4, len(r) + 1))


def _mashed(low: str) -> bool:
    """Two such words in a row."""
    words = low.split()
    if _keys().isdisjoint(words):
        return False
    runs = [w.strip(".,;:!") in _keys() for w in words]
    return any(a and b for a, b in zip(runs, runs[1:]))


@lru_cache(maxsize=1)
def _filler() -> list[tuple[tuple[str, ...], re.Pattern]]:
    """(lower-case strings of which the text must have one, grammar)."""
    flags = 0  # they are searched in lower case
    latin = "|".join(_LATIN + _LATIN_2)
    repeat = r"рыба|рыбатекст|бла|blah|bla|test|тест|text|текст|пример|example|sample|образец|dummy|placeholder|заглушка|filler|xxx|foo|lorem|слово|word"
    return [
        (("lorem", "ipsum", "dolor", "consectetur"), re.compile(r"\blorem ipsum dolor\b", flags)),
        (("lorem", "ipsum", "dolor", "consec", "labor", "magna", "aliqu", "veniam", "ullamco", "perspiciatis", "voluptate"), re.compile(rf"\b(?:{latin})(?:[\s,.;]+(?:{latin})\b){{7,}}", flags)),
        (tuple(repeat.split("|")), re.compile(rf"\b({repeat})(?:[\s,.!]+\1\b){{2,}}", flags)),
        (("here", "follow", "layout", "replaced"), re.compile(rf"(?<!write )(?<!sign )(?<!print )(?<!put )\b(?:sample|placeholder|dummy|example|your|filler|some|insert|more)\s+{_THING}\s+(?:here|goes here|appears here|comes here|will go here|to follow|for layout|(?:is )?to be replaced|to come)\b", flags)),
        (("to add", "to edit", "to insert", "to type", "to enter"), re.compile(rf"\b(?:click|tap|double-click|press|use this block)(?: here)? to (?:add|edit|insert|type|enter)\s+(?:a |an |your |some |the )?(?:own |short |new )?{_THING}", flags)),
        (("пример", "образец", "макет"), re.compile(rf"\b(?:пример|образец|макет)\s+{_RU_THING}\s+(?:под замену|для в[её]рстки|для проверки|для макета|для заполнения)", flags)),
        (("впишите", "введите", "вставьте", "добавьте", "напишите"), re.compile(rf"\b(?:сюда\s+|здесь\s+)?(?:впишите|введите|вставьте|добавьте|напишите)\s+(?:сюда\s+|здесь\s+)?(?:ваш\s+|свой\s+)?{_RU_THING}(?:\s+{_PART})\b|\b(?:сюда|здесь)\s+(?:впишите|введите|вставьте|добавьте|напишите)\s+(?:ваш\s+|свой\s+)?{_RU_THING}", flags)),
        (("здесь", "тут", "ниже", "в этом", "на этой", "сюда"), re.compile(rf"\b(?:здесь|тут|ниже|в этом (?:разделе|блоке)|на этой странице)\s+(?:будет|появится|добавим|разместим|должен быть|скоро будет|напишем|вставим)\s+(?:{_RU_THING}|(?:несколько|пара|пару) слов про тему)\s+(?:{_PART})", flags)),
        (("здесь", "тут", "ниже", "в этом", "на этой"), re.compile(rf"\b(?:здесь|тут|ниже|в этом (?:разделе|блоке)|на этой странице)\s+(?:будет|появится|добавим|разместим)\s+(?:несколько слов|пара слов|пару слов)\b", flags)),
        (("appear", "will be", "goes", "will go"), re.compile(rf"\b(?:here|this section|this page|below)\s+(?:we will (?:add|put)|will be|will appear|goes)\s+(?:a |the |some )?(?:{_THING}|few words)\b", flags)),
        (("рыб", "заглушк"), re.compile(r"\bтекст[- ](?:рыба|заглушка)\b|\bрыбный текст\b", flags)),
    ]


# fixed values: what servers say in Russian where the registry of status codes has an English phrase
_STATUS_RU = r"доступ (?:запрещ[её]н|ограничен|закрыт)|(?:страница|файл|документ|ресурс) не найден[ао]?|слишком много запросов|внутренняя ошибка сервера|ошибка шлюза|шлюз не отвечает|сервис (?:временно )?недоступен|время ожидания истекло|требуется (?:вход|авторизация)|неверный запрос|ресурс (?:удал[её]н|перемещ[её]н)|удалено"
_SCRIPTS = r"(?:java\s?scripts?|js|scripts?|scripting|active content|cookies?|скрипт\w*|сценари\w*|куки)"
_ON = r"(?:enabl\w+|allow\w*|turn\w*|switch\w*|activat\w+|accept\w*|unblock\w*|disabled|required?|requires|needs?|must|without|support\w*|works? only|blocked|включ\w+|разреш\w+|активир\w+|нужн\w+|необходимо|требу\w+|без|не поддерживает|отключ\w+)"
_THING_LOST = r"(?:pages?|sites?|websites?|servers?|services?|files?|documents?|resources?|urls?|links?|address|requests?|sessions?|access|account|permission|preview|viewer|connection|gateway|host|database|director(?:y|ies)|something|app|portal|export|import|download|upload|страниц\w*|сайт\w*|сервер\w*|сервис\w*|файл\w*|документ\w*|ресурс\w*|ссылк\w+|запрос\w*|сеанс\w*|сесси\w+|доступ\w*|шлюз\w*|соединени\w+|предпросмотр\w*|технические работы|что-то)"
_LOST = r"(?:not found|cannot|can['’]?t|could not|couldn['’]?t|unable|unavailable|moved|removed|deleted|no longer|denied|forbidden|expired|blocked|fail(?:ed|s|ure)?|lost|refused|exceeded|timed? ?out|went wrong|not available|does(?: not|n['’]t) exist|do(?: not|n['’]t) have|you need|too (?:many|large)|terminated|no preview|не найден\w*|не удалось|удал[её]н\w*|перемещ\w+|недоступ\w+|запрещ\w+|ограничен\w*|ист[её]к\w*|заверш[её]н\w*|превышен\w*|не отвечает|отказано|не существует|больше не|нужен доступ|слишком|пошло не так|технические работы)"
_CHECK = r"(?:checking|verify\w*|confirm|prove|проверяем|подтвердите)\b.*\b(?:browser|human|robot|connection|браузер\w*|робот\w*|человек\w*)|вы не робот|captcha|капч\w+"


@lru_cache(maxsize=1)
def _status() -> str:
    """The phrases of the registry of status codes from 400 on, and what pages make of them."""
    phrases = {s.phrase.lower() for s in HTTPStatus if s >= 400} | {"access denied", "request time-out", "gateway time-out", "service temporarily unavailable", "page not found", "file not found", "server error", "request timeout", "gateway timeout", "request entity too large"}
    return "(?:" + "|".join(re.escape(p) for p in sorted(phrases, key=len, reverse=True)) + f"|{_STATUS_RU})"


@lru_cache(maxsize=1)
def _said() -> list[tuple[tuple[str, ...], re.Pattern, bool]]:
    """(strings of which the lower-case text must have one, grammar in lower case, whether it is an error by itself): lines and codes, taken out first."""
    code = r"\(?\b[45]\d\d\b\)?"
    return [
        (("http", "err", "status", "ошибк", "код"), re.compile(rf"\b(?:https?(?:/\d(?:\.\d)?)?|err(?:or)?|status|ошибка|код)(?: code| ошибки)?\s*[:#№]?\s*{code}(?:[\s.:\-–—]*\b{_status()}\b)?"), True),
        (("4", "5"), re.compile(rf"{code}[\s.:\-–—]*\b{_status()}\b"), True),
        (tuple("request,auth,forbidden,found,gone,error,gateway,unavailable,denied,too,timeout,time-out,доступ,не найден,ошибка,шлюз,время ожидания,требуется,запрос,ресурс,удалено,недоступен,allowed,required,failed".split(",")), re.compile(rf"(?:(?<=[.!?:|>»\-–—\d])\s+|^\s*|\n\s*){_status()}(?:\s*{code})?(?=\s*(?:[.!?…:;|\n)]|$)|\s+[^\W\d])"), True),
        (("exception", "traceback", "error", "sqlstate", "fatal", "panic"), re.compile(r"\b(?:unhandled|uncaught) (?:exception|error)\b:?|\btraceback \(most recent call last\):?|\b[a-z][\w.]*(?:error|exception)\b: ?[^\n]*|\bsqlstate\b[^\n]*|\bfatal error\b:?[^\n]*|\bpanic: [^\n]*"), True),
        (("line ", "at "), re.compile(r"^\s*file \"[^\"\n]+\", line \d+(?:, in \S+)?|^\s*at [\w$.<>]+\([^()\n]*\)|\bin \S+\.php on line \d+", re.M), False),
        (("id", "incident", "reference", "инцидент", "trace"), re.compile(r"\b(?:(?:request|trace|ray|correlation|support|error|event) id|incident(?: id)?|(?:error )?reference(?: id| number)?|код инцидента|номер обращения)\s*[:#№]?\s*[\w\-]*\d[\w\-]*"), False),
        (("apache", "nginx", "iis", "openresty", "cloudflare", "proxy", "server at", "squid", "varnish", "litespeed"), re.compile(r"\b(?:apache|nginx|iis|openresty|cloudflare|squid|varnish|litespeed)(?:/[\w.]+)?(?: ?\([^()\n]*\))?(?: server)?(?: at [\w.\-]+)?(?: port \d+)?|\b[\w\-]+ \(proxy\)(?: at [\w.:\-]+)?"), False),
    ]


#: Beginnings of the usual words of errors, notices and the advice that goes with them.
_USUAL = (
    "page site web server service file document resource url link address request session access account permission preview view browser javascript js script cookie content app portal connect gateway proxy host database object folder direct security "
    "error err found cannot can't can’t could unable unavailab moved remov delet longer denied forbid expir block fail lost reach refus exceed limit many too timed timeout time wrong went problem invalid missing disabl off requir unauthor exception fatal occur broken unexpected "
    "internal bad gone oops sorry try again reload refresh retry later check contact admin support webmaster sign log back go return home start wait second minute few ask owner switch another click enabl allow turn on activat accept please continu proceed verify human robot complet "
    "receiv respons upstream detect availab action below capacity downtime encounter open load close window persist moment nothing happens run need must have need sure setting option incident reference changed temporar maint supported version update "
    "страниц сайт сервер сервис файл документ ресурс ссылк адрес запрос запрашива сеанс сесси доступ аккаунт браузер скрипт сценари куки портал приложени таблиц шлюз соединени предпросмотр просмотр содержим технич работ ошибк найден удал перемещ недоступ запрещ ограничен закрыт ист "
    "заверш превыш лимит отвеча отказ существу больше нужн нужен необходим требу слишком много внутренн сбой поддерж выполн отключ невозможн загруз откры неверн попроб проверь провер обратит обнов верн главн назад позже подожд зайди войди вход повтор попытк включ разреш активир настро "
    "info name out side end владел администратор друг учётн учетн запис исправл пошл упс пожалуйста уже работа окно закрыва минут секунд снова позднее авториз удалось велик робот человек капч вероятн возможн"
).split()
# fixed values: words of grammar
_GRAMMAR = frozenset(
    "the this that these is was are be been being has have had to of for in at by your our you we it its or and if with from may might do does did will would before after all just more an as not no only any so on my me us they he she there here when while which who "
    "для из за по что это этот эта этого вас вам вы ваш ваша мы нас вами был была было были есть чтобы при без его её их или не на но и а же ли бы до от об под над то так как она он они".split()
)


@lru_cache(maxsize=1)
def _usual() -> tuple[frozenset[str], tuple[str, ...]]:
    """Short words, which must agree as a whole, and beginnings of longer ones."""
    return frozenset(w for w in _USUAL if len(w) <= 3), tuple(w for w in _USUAL if len(w) > 3)


_ERROR_KEY = re.compile(r"\{\s*\"(?:error|errors|fault|exception|failure)\"\s*:", re.I)
_WORD = re.compile(r"[^\W\d_]{2,}")
_SENTENCE = re.compile(r"[\n|>]+|(?<=[.!?…;])\s+|(?<=\d)\s+(?=[^\W\d])")
_NEEDED = re.compile(rf"\b{_ON}\b.*\b{_SCRIPTS}\b|\b{_SCRIPTS}\b.*\b{_ON}\b|\bбраузер не поддерживает\b|\bif nothing happens\b")
_FAILED = re.compile(rf"\b{_THING_LOST}\b.*\b{_LOST}|\b{_LOST}.*\b{_THING_LOST}\b|^\W*технические работы|\bнужен доступ\b|\byou need (?:permission|access)\b|\baccess (?:is )?required\b|\bno preview\b")
_CHECKED = re.compile(rf"\b(?:{_CHECK})")
_CODE = re.compile(r"```.*?```|~~~.*?~~~|<(code|pre)\b.*?</\1>|`[^`\n]+`", re.S)
# an indented block after a blank line or a colon, in which something looks like a program
_INDENTED = re.compile(r"(?:\A|(?<=\n\n)|(?<=:\n))(?:(?: {4}|\t)[^\n]*(?:\n|\Z))+")
_PROGRAM = re.compile(r"[;=(){}<>]|^\s*(?:def|class|import|return|if|for|while|function|var|let|const|echo|print|select|#|//)\b", re.M | re.I)
_TALK = re.compile(r"\b(?:placeholder|template|templat\w+|variable|syntax|merge field|tutorial|for example|e\.g\.|escap\w+|macro|tag|marker|format|шаблон\w*|переменн\w+|подставля\w+|подстановк\w+|плейсхолдер\w*|синтаксис\w*|например|макрос\w*|тег\w*|метк\w+|маркер\w*|формат\w*|строк\w+ выгрузки)\b", re.I)
_TECHNICAL = re.compile(r"\b(?:columns?|dataframes?|pandas|numpy|python|javascript|sql|quer(?:y|ies)|functions?|variables?|methods?|attributes?|modules?|compilers?|interpreters?|operators?|values?|data types?|booleans?|arrays?|parameters?|arguments?|pointers?|behaviou?rs?|shell|terminal|столбц\w*|колонк\w*|переменн\w+|функци\w+|оператор\w*|интерпретатор\w*)\b", re.I)
_QUOTED = re.compile(r"[«\"“'`]\s*$")
_SHAPE = re.compile(r"^[a-zа-яё]+[A-ZА-ЯЁ]|\w_\w|[^\W_]{2}\.[a-zа-яё]\w|^[A-ZА-ЯЁ]+(?:[ _][A-ZА-ЯЁ]+)+$")
_LETTERS = re.compile(r"[A-ZА-ЯЁ]?[a-zа-яё]+|[A-ZА-ЯЁ]+")  # humps of an identifier are words of their own


@lru_cache(maxsize=1)
def _grammars() -> list[tuple[str, re.Pattern, bool]]:
    cased = ("$", ":", "__")
    return [(need, re.compile(rx, 0 if need in cased else re.I), field) for need, rx, field in PLACEHOLDERS]


@lru_cache(maxsize=1)
def _machine() -> list[tuple[str, re.Pattern]]:
    return [(need, re.compile(rx, re.I if need == "[object" else 0)) for need, rx in MACHINE]


@lru_cache(maxsize=1)
def _field_starts() -> tuple[frozenset[str], tuple[str, ...]]:
    return frozenset(w for w in _FIELD if w.isascii() and len(w) <= 3), tuple(w for w in _FIELD if not w.isascii() or len(w) > 3)


def is_field(inside: str) -> bool:
    """Whether a name could be that of a field: an identifier in shape, or with a word of the vocabulary."""
    inside = inside.strip(" [](){}<>#%~^|_$:;&@*")
    if inside.upper() in _ENVIRONMENT:
        return False
    if _SHAPE.search(inside):
        return True
    short, starts = _field_starts()
    return any(w in short or w.startswith(starts) for w in (x.lower() for x in _LETTERS.findall(inside)))


def _sentence_of(text: str, a: int, b: int) -> tuple[int, int]:
    left = max(text.rfind("\n", 0, a), text.rfind(". ", 0, a)) + 1
    stop = [e for e in (text.find("\n", b), text.find(". ", b)) if e >= 0]
    return left, min(stop) if stop else len(text)


def _code_spans(text: str) -> list[tuple[int, int]]:
    spans = [m.span() for m in _CODE.finditer(text)] if "`" in text or "~~~" in text or "<code" in text or "<pre" in text else []
    if "\n    " in text or "\n\t" in text or text.startswith(("    ", "\t")):
        spans += [m.span() for m in _INDENTED.finditer(text) if _PROGRAM.search(re.sub(r"[{<\[]{2}.*?[}>\]]{2}", "", m.group()))]
    return spans


def placeholders(text: str) -> list[tuple[int, int]]:
    """Spans of placeholders and machine values that the text does not merely talk about."""
    marks = [m.span() for need, rx, field in _grammars() if need in text for m in rx.finditer(text) if not field or is_field(m.group())]
    marks = [s for s in marks if text[s[0]] != "$" or text[s[0] : s[1]].strip("${} ").upper() not in _ENVIRONMENT]
    values = [m.span() for need, rx in _machine() if need in text for m in rx.finditer(text)]
    if not marks and not values:
        return []
    code = _code_spans(text)
    # a machine value is told from the word by the sentence it stands in
    values = [s for s in values if not _TECHNICAL.search(text[slice(*_sentence_of(text, *s))].replace(text[s[0] : s[1]], " "))]
    found = [s for s in marks + values if not any(a <= s[0] < b for a, b in code)]
    if not found:
        return []
    told = []
    for s in found:
        sentence = text[slice(*_sentence_of(text, *s))]
        told.append(bool(_QUOTED.search(text[max(0, s[0] - 3) : s[0]]) and _TALK.search(sentence.replace(text[s[0] : s[1]], " "))))
    if all(told) and 100.0 * len(found) < DENSITY * max(1, len(_WORD.findall(text))):
        return []
    return [s for s, t in zip(found, told) if not t] or found


def has_filler(text: str) -> bool:
    low = text.lower()
    return any(any(n in low for n in needs) and rx.search(low) for needs, rx in _filler()) or _mashed(low)


def _stretches(text: str, least: int = 300) -> Iterator[str]:
    """The text in stretches that end with a line or sentence."""
    at = 0
    while at < len(text):
        stops = [e for e in (text.find("\n", at + least), text.find(". ", at + least)) if e >= 0]
        end = min(stops) + 1 if stops else len(text)
        yield text[at:end]
        at = end


def _json_error(text: str) -> bool:
    """An object that reports an error, of any length, with nothing but a title around it."""
    m = _ERROR_KEY.search(text)
    if not m:
        return False
    try:
        _, end = json.JSONDecoder(strict=False).raw_decode(text, m.start())
    except ValueError:
        return False
    return len(_WORD.findall(text[: m.start()])) + len(_WORD.findall(text[end:])) <= TITLE_WORDS


def is_error_page(text: str) -> bool:
    """Nothing but errors and notices, besides a title or menu. The text is read as far as other words stay few."""
    if "{" in text and _json_error(text):
        return True
    hits = others = 0
    short, starts = _usual()
    for part in _stretches(text.lower()):
        for needs, rx, error in _said():
            if any(n in part for n in needs):
                part, n = rx.subn("\n", part)
                hits += n if error else 0
        for sentence in _SENTENCE.split(part):
            words = _WORD.findall(sentence)
            told = [w for w in words if w not in _GRAMMAR]
            if not words:
                continue
            usual = sum(w in short or w.startswith(starts) for w in told)
            if usual < USUAL_SHARE * len(told):
                others += len(words)
                if others > TITLE_WORDS:
                    return False
            elif _NEEDED.search(sentence) or _FAILED.search(sentence) or _CHECKED.search(sentence):
                hits += 1
    return hits > 0


def residue_kind(text: str | None) -> str | None:
    """`placeholder`, `filler`, `error_page` or null; null and blank texts have none."""
    if not text or text.isspace():
        return None
    if placeholders(text):
        return "placeholder"
    if has_filler(text):
        return "filler"
    return "error_page" if is_error_page(text) else None


def _run(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = pa.array([residue_kind(t) for t in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), kinds], [key, "kind"])

    return run


def find_residue(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind) of every text that is to be excluded; whole texts are read, repeated rows stay."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(_run(key), f"`{key}` {kind}, kind string").where("kind is not null")
