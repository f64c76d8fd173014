"""Text functions as column expressions: normal forms, name features, entities, language."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def _c(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _plain(c: Column) -> Column:
    """ASCII and composed Cyrillic: neither has any compatibility form, and most texts have nothing else."""
    return c.rlike(r"^[\x00-\x7F\x{400}-\x{481}\x{48A}-\x{52F}]*+$")


@lru_cache(maxsize=1)
def _nfkc():
    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    return form


def nfkc(c: C) -> Column:
    """NFKC, combining marks composed. Only texts that are not plain are looked at in Python."""
    c = _c(c)
    return F.when(_plain(c), c).otherwise(_nfkc()(F.when(~_plain(c), c)))


def normalize_spaces(c: C) -> Column:
    """No-break and other spaces become plain, runs one, none at the ends. Null stays null."""
    return F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def normalize_name(c: C) -> Column:
    """Spaces, NFKC, lower case, ё as е, runs of _ and - as spaces."""
    c = F.lower(nfkc(normalize_spaces(c)))
    return F.trim(F.regexp_replace(F.translate(c, "ё", "е"), r"(?U)[\s_\-]+", " "))


def split_extension(name: C, mime: C | None = None, longest: int = 12) -> Column:
    """Lower-case suffix of a file name; '' for native documents, hidden files, and suffixes that are too long."""
    name = normalize_spaces(name)
    ext = F.lower(F.regexp_extract(name, r"^.*[^./\\]\.([^./\\\s]+)$", 1))
    out = F.when(F.length(ext) <= longest, ext).otherwise("")
    if mime is not None:
        out = F.when(F.startswith(F.coalesce(_c(mime), F.lit("")), F.lit("application/vnd.google-apps.")), "").otherwise(out)
    return F.coalesce(out, F.lit(""))


#: Words that mark a version or a copy, by how often names of our test inventory end with them (1,714 to 47 of 47,543), then their counterparts in the other language.
VERSION_WORDS = ["копия", "final", "черновик", "signed", "old", "архив", "copy", "финал", "draft", "подписан", "archive"]
_NUMBERED = ["v", "ver", "rev"]


def date_pattern(separators: str = "-_. ", strict: bool = False) -> str:
    """A date in digits: a year of 1900 to 2099, a month and a day, from the year down or from the day up, with a separator between.

    Months and days have two digits, or one where not `strict`.
    """
    zero = "0" if strict else "0?"
    year, month, day, sep = r"(?:19|20)\d{2}", rf"(?:1[0-2]|{zero}[1-9])", rf"(?:3[01]|[12]\d|{zero}[1-9])", f"[{re.escape(separators)}]"
    return f"(?:{sep.join((year, month, day))}|{sep.join((day, month, year))})"


def _marker() -> str:
    """Markers stand alone: no letter, digit or _ on either side."""
    alone = lambda x: rf"(?<![\p{{L}}\p{{N}}_])(?:{x})(?![\p{{L}}\p{{N}}_])"
    return "(?U)" + "|".join([alone("|".join(VERSION_WORDS)), alone("(?:" + "|".join(_NUMBERED) + r") ?\d+"), r"\(\d+\)", rf"(?<!\d){date_pattern()}(?!\d)"])


def strip_version_markers(c: C) -> Column:
    """The normal name without version words (in brackets too), version numbers, (N) and dates."""
    c = F.regexp_replace(normalize_name(c), r"\(\s*(?:" + "|".join(VERSION_WORDS) + r")\s*\)", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, _marker(), " "), r"(?U)\s+", " "))


def words(c: C) -> Column:
    """All runs of letters, digits and _; Unicode."""
    return F.regexp_extract_all(_c(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def distinct_matches(c: C, pattern: str, group: int = 0) -> Column:
    """All different matches, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(_c(c), F.lit(pattern), F.lit(group))))


def any_case(word: str) -> str:
    """A pattern of a word in any letter case, in every regex dialect."""
    return "".join(f"[{x.upper()}{x.lower()}]" if x.upper() != x.lower() else re.escape(x) for x in word)


def _after(words: str, value: str, sign: str = r"(?:№|#|No\.?|:)?") -> str:
    """A value that follows one of several words, any sign between; the value is group 1."""
    said = "|".join(any_case(w).replace(r"\ ", r"\s+") for w in words.split("|"))
    return rf"(?:^|[^\p{{L}}\p{{N}}_])(?:{said})\.?\s*{sign}\s*({value})(?:[^\p{{L}}\p{{N}}_]|$)"


def _alone(value: str) -> str:
    return rf"(?:^|[^\p{{L}}\p{{N}}_])({value})(?:[^\p{{L}}\p{{N}}_]|$)"


_NUMBER = r"[\p{L}\p{N}_][\p{L}\p{N}_\-/.]*"
_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december|январь|февраль|март|апрель|май|июнь|июль|август|сентябрь|октябрь|ноябрь|декабрь"

#: column -> (pattern, group): the first match is taken. A table, so that a deployment can bring its own.
ENTITIES: dict[str, tuple[str, int]] = {
    "email": (r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", 0),
    "phone": (r"(?:\+?\d{1,3}[ \-]?)?\(?\d{3}\)?[ \-]\d{3}[ \-]?\d{2}[ \-]?\d{2}", 0),
    "date": (date_pattern(strict=True), 0),
    "year": (r"(?:^|[^\d])((?:19|20)\d{2})(?:[^\d]|$)", 1),
    "month": (r"(?i)(january|february|march|april|may|june|july|august|september|october|november|december)", 1),
    "long_number": (r"(?:^|[^\d])(\d{9,20})(?:[^\d]|$)", 1),
    "contract": (r"(?:[Cc]ontract|[Дд]оговор[а-я]*(?: аренды)?)\s*(?:№|#|No\.?)?\s*([\p{L}\d][\p{L}\d\-/_.]*\d)", 1),
    "invoice": (r"(?:[Ii]nvoice|[Сс]чет|[Сс]чёт[а-я]*)\s*(?:№|#|No\.?)?\s*(\d[\d\-/_]*)", 1),
}

#: The same of a path and name, where words stand closer together.
NAME_ENTITIES: dict[str, tuple[str, int]] = {
    "unit_number": (_after("ап|апарт|апартамент|apt|unit", r"\d{2,4}"), 1),
    "premise_number": (_after("пом|помещение|premises", r"\d+ ?-? ?[НнHh]?"), 1),
    "building": (_after("корп|корпус|building", "[12АБВГ]"), 1),
    "land_number": (_alone(r"\d{2}:\d{2}:\d{6,7}:\d+"), 1),
    "contract_number": (_after("договор|дог|contract", _NUMBER), 1),
    "act_number": (_after("акт|act", _NUMBER), 1),
    "invoice_number": (_after("счет|счёт|invoice", _NUMBER), 1),
    "payment_order_number": (_after("платежное поручение|платёжное поручение|payment order", _NUMBER), 1),
    "date": (_alone(date_pattern()), 1),
    "year": (_alone(r"(?:19|20)\d{2}"), 1),
    "month": (_alone("|".join(map(any_case, _MONTHS.split("|")))), 1),
    "email": (r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", 0),
    "phone": (r"(?:\+7|8)(?:[\s\-()]*\d){10}", 0),
    "insurance_number": (_alone(r"\d{3}-\d{3}-\d{3}\s?\d{2}"), 1),
    "tax_number": (_after("инн|tin", r"\d{10,12}"), 1),
    "tax_reason_code": (_after("кпп", r"\d{9}"), 1),
    "register_number": (_after("огрн", r"\d{13,15}"), 1),
    "bank_code": (_after("бик|bic", r"\d{9}"), 1),
    "bank_account": (_alone(r"\d{20}"), 1),
    "passport_marker": (_alone("|".join(map(any_case, ("паспорт", "passport", "выдан"))) + r"|[Сс]ерия\s+\d{4}"), 1),
    "legal_form_marker": (_alone("|".join(map(any_case, ("ооо", "ао", "ип", "инн", "кпп", "огрн", "бик", "ltd", "llc")))), 1),
}

#: Families of features of a name: all different matches of a pattern, sorted.
NAME_FEATURES: dict[str, tuple[str, int]] = {
    "years": (_alone(r"(?:19|20)\d{2}"), 1),
    "dates": (_alone(r"\d{1,2}[./\-]\d{1,2}[./\-](?:\d{4}|\d{2})"), 1),
    "units": (_after("ап|апарт|кв|unit|room|номер", r"[\p{L}\p{N}][\p{L}\p{N}\-]*", r"[\-№#]?"), 1),
    "contracts": (_after("договор|contract|дог", r"[\p{L}\p{N}][\p{L}\p{N}\-/.]*", r"[\-№#]?"), 1),
    "acts": (_after("акт|act", r"[\p{L}\p{N}][\p{L}\p{N}\-/.]*", r"[\-№#]?"), 1),
    "invoices": (_after("счет|invoice", r"[\p{L}\p{N}][\p{L}\p{N}\-/.]*", r"[\-№#]?"), 1),
    "registries": (_after("реестр|registry", r"[\p{L}\p{N}][\p{L}\p{N}\-/.]*", r"[\-№#]?"), 1),
}


def entity(c: C, name: str, longest: int = 120, table: dict[str, tuple[str, int]] | None = None) -> Column:
    """First match of one extractor, '' where there is none or the text is null."""
    pattern, group = (ENTITIES if table is None else table)[name]
    return F.coalesce(F.substring(F.regexp_extract(_c(c), pattern, group), 1, longest), F.lit(""))


def name_features(c: C) -> dict[str, Column]:
    """Family -> its features in a normal name, as arrays; a null name has none."""
    c = F.coalesce(_c(c), F.lit(""))
    # all matches are wanted, so that a match must not use up the space before the next one
    free = lambda p: p.replace(r"(?:^|[^\p{L}\p{N}_])", r"(?<![\p{L}\p{N}_])").replace(r"(?:[^\p{L}\p{N}_]|$)", r"(?![\p{L}\p{N}_])")
    return {name: distinct_matches(c, free(pattern), group) for name, (pattern, group) in NAME_FEATURES.items()}


def guess_language(c: C) -> Column:
    """ru or en by the larger count of Cyrillic or Latin letters; en if equal and any; else unknown. Null is unknown."""
    cyr = F.coalesce(F.regexp_count(_c(c), F.lit(r"[А-Яа-яЁё]")), F.lit(0))
    lat = F.coalesce(F.regexp_count(_c(c), F.lit(r"[A-Za-z]")), F.lit(0))
    return F.when(cyr > lat, "ru").when(lat > 0, "en").otherwise("unknown")


def path_depth(path: C) -> Column:
    """Slashes less one, at least 0."""
    path = F.coalesce(_c(path), F.lit(""))
    return F.greatest(F.lit(0), F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) - 1)


def sanitize_path(path: C) -> Column:
    """First and last segment only."""
    seg = F.filter(F.split(F.coalesce(_c(path), F.lit("")), "/"), lambda s: s != "")
    return F.when(F.size(seg) <= 2, F.concat(F.lit("/"), F.array_join(seg, "/"))).otherwise(F.concat(F.lit("/"), F.get(seg, F.lit(0)), F.lit("/.../"), F.element_at(seg, -1)))


def append_reason(reasons: C, more: C) -> Column:
    """`more` after '; ', unless it is blank or a part of what is there."""
    old, new = F.coalesce(_c(reasons), F.lit("")), F.coalesce(_c(more), F.lit(""))
    return F.when((new == "") | F.contains(old, new), old).when(old == "", new).otherwise(F.concat(old, F.lit("; "), new))


def as_bool(c: C) -> Column:
    """1, true, yes, y and on are true; anything else, null too, is false."""
    return F.coalesce(F.lower(F.trim(_c(c).cast("string"))).isin("1", "true", "yes", "y", "on"), F.lit(False))


@lru_cache(maxsize=1)
def _unescape():
    @F.pandas_udf("string")
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return plain


def strip_markup(c: C) -> Column:
    """Visible text of HTML: scripts, styles, comments and tags removed, all entities unescaped, spaces collapsed.

    Texts whose only entities are the five of XML and the no-break space stay in the engine.
    """
    c = F.regexp_replace(_c(c), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", " ")
    rest = F.regexp_replace(c, "&(?:nbsp|lt|gt|quot|amp);", "")
    few = c
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        few = F.replace(few, F.lit(a), F.lit(b))
    other = rest.rlike("&[#A-Za-z]")
    return normalize_spaces(F.when(~other, few).otherwise(_unescape()(F.when(other, c))))


# fixed values: ways to say that a value is unknown, without case, marks and spaces
UNKNOWN = (
    "unknown unk na nan none null nil undefined unspecified notspecified notset notavailable notapplicable notdefined notknown undetermined missing tbd "
    "неизвестно неизвестный неизвестная неизвестен неизвестна неопределено неопределён неопределен неопределена неопределенный нд неуказано неуказан неуказана нетданных отсутствует пусто незадано незадан "
    "нет неизв неопр безданных нетсведений нетинформации nd tba nodata novalue noinformation notprovided unbekannt keineangabe inconnu desconocido sconosciuto 未知 不明"
).split()
#: What a value begins with, without case, marks and spaces, that names its unknown kind ("unknown type").
UNKNOWN_START = "^(unknown|неизвестн|неопредел|неустановл)"


def filled(c: C) -> Column:
    """Neither blank nor merely a statement that the value is unknown: any case, language, mark or spacing. Never null."""
    core = F.regexp_replace(F.lower(_c(c)), r"[^\p{L}\p{N}]+", "")
    # nothing left or one of the words alone, which a set tells faster than a pattern, or a beginning
    return F.coalesce(~(core.isin("", *UNKNOWN) | core.rlike(UNKNOWN_START)), F.lit(False))


def text_hash(c: C) -> Column:
    return F.sha2(F.coalesce(_c(c), F.lit("")), 256)
