"""Visually identical text with different characters (problem 3).

Characters are first mapped to the one they look like, by a table made from
public Unicode data with a rule for what is seen as different. What still differs only
in ways the eye cannot see (composed or combining accents, characters without
width) is equal under the Unicode collation of Spark, which is sensitive to
accents and case. Names are grouped by the mapped text under that collation;
the class's canonical member is chosen by rule and joined back.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zipfile
from functools import lru_cache
from glob import glob

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import split_join
from ..session import materialize

COLLATION = "UNICODE"

# fixed values: letters that look like a Latin one although their other case does not, so that the rule below leaves them out
_EXTRA = "νv һh ҽe ԁd ԛq ԜW ԝw ɡg ӏl ιi ʼ' ˗-".split()
#: Marks that are told from their look-alike by their width or slant.
_VISIBLE = "‒–—―﹘⁃⁓`´ˊˋ΄᾽᾿῾´῀"
_LETTER = ("Lu", "Ll", "Lt", "Lo")


@lru_cache(maxsize=1)
def confusables() -> dict[str, str]:
    """Character -> what it may be confused with, as published by Unicode: the table of the ICU library that Spark ships.

    Its format: a header whose size is its first 16-bit number; then the
    offsets of keys (code point in 24 bits, length of the target less one in
    8), of 16-bit values (the target, or its place in the strings) and of the
    strings. Read on the driver; a Spark without the library has an empty table.
    """
    import pyspark

    homes = [os.environ.get("SPARK_HOME", ""), os.path.dirname(pyspark.__file__)]
    jars = [j for h in homes if h for j in sorted(glob(os.path.join(h, "jars", "icu4j-*.jar")))]
    if not jars:
        return {}
    with zipfile.ZipFile(jars[0]) as z:
        data = z.read(next(n for n in z.namelist() if n.endswith("/confusables.cfu")))
    data = data[struct.unpack_from(">H", data)[0] :]
    keys_at, n_keys, values_at, n_values, strings_at, n_strings = struct.unpack_from(">6i", data, 12)
    keys, values = struct.unpack_from(f">{n_keys}I", data, keys_at), struct.unpack_from(f">{n_values}H", data, values_at)
    strings, out = data[strings_at : strings_at + 2 * n_strings], {}
    for key, value in zip(keys, values):
        length = (key >> 24) + 1
        out[chr(key & 0xFFFFFF)] = chr(value) if length == 1 else strings[2 * value : 2 * (value + length)].decode("utf-16-be")
    return out


def skeleton(text: str) -> str:
    """What the text has in common with all texts it may be confused with."""
    table = confusables()
    return unicodedata.normalize("NFD", "".join(table.get(c, c) for c in unicodedata.normalize("NFD", text)))


def _script(c: str) -> str:
    """The script of a letter, by the first word of its name."""
    return unicodedata.name(c, "").partition(" ")[0]


def _alike(a: str, b: str) -> bool:
    """Whether two characters of one skeleton are seen as one: not where case, kind or value differ.

    Letters must come from different scripts, as two letters of one are
    different letters; of small letters the capitals must look alike too (г
    and r have one skeleton, Г and R have not); digits must have one value.
    """
    ka, kb = unicodedata.category(a), unicodedata.category(b)
    if ka in _LETTER or kb in _LETTER:
        if _script(a) == _script(b) or (ka == "Ll" and kb == "Ll" and skeleton(a.upper()) != skeleton(b.upper())):
            return False
        return ka == kb or (ka == "Lo" and kb == "Lu" and skeleton(a) == b)
    if ka == "Nd" or kb == "Nd":
        return ka == kb and unicodedata.digit(a) == unicodedata.digit(b)
    return (ka[0] == "P" or ka == "Sm") and kb[0] in "PS" and a not in _VISIBLE


@lru_cache(maxsize=1)
def _table() -> dict[str, str]:
    """Character -> the one or more it looks like, by rule from Unicode: forms of width and font, compatibility forms of one look, and confusables that are alike."""
    plain: dict[str, list[str]] = {}
    for c in map(chr, range(0x21, 0x7F)):
        plain.setdefault(skeleton(c), []).append(c)
    out = {p[0]: p[1:] for p in _EXTRA}
    for i in (*range(0xA0, 0xD800), *range(0xF900, 0x20000)):
        c = chr(i)
        form, kind = unicodedata.normalize("NFKC", c), unicodedata.decomposition(c).partition(" ")[0]
        if kind in ("<wide>", "<narrow>", "<font>", "<noBreak>") and form != c:
            out[c] = "".join(out.get(x, x) for x in form)
        elif kind == "<compat>" and skeleton(form) == skeleton(c) and not form.isspace() and unicodedata.category(c)[0] not in "SZ" and unicodedata.category(c) not in ("No", "Lm") and skeleton(c) not in plain:
            out[c] = form  # ligatures and Roman numerals, not signs such as №
        elif c not in out and c in confusables():
            alike = [t for t in plain.get(skeleton(c), ()) if _alike(c, t) or (kind == "<compat>" and form == t)]
            proto = skeleton(c)
            if alike:
                out[c] = alike[0]
            elif len(proto) == 1 and proto > "~" and unicodedata.category(c) == unicodedata.category(proto) and unicodedata.category(c) in ("Lu", "Lo") and _alike(c, proto):
                out[c] = proto
    # letters with an accent go by the letter without it
    for i in (*range(0xA0, 0xD800), *range(0xF900, 0x20000)):
        parts = unicodedata.normalize("NFD", chr(i))
        if chr(i) not in out and len(parts) > 1 and parts[0] in out and len(out[parts[0]]) == 1:
            whole = unicodedata.normalize("NFC", out[parts[0]] + parts[1:])
            if len(whole) == 1:
                out[chr(i)] = whole
    return {a: b for a, b in out.items() if a != b and unicodedata.normalize("NFC", a) != b}


@lru_cache(maxsize=1)
def _map() -> tuple[str, str]:
    """Characters that look like one other of the basic plane, and those."""
    one = {a: b for a, b in _table().items() if len(b) == 1 and ord(b) < 0x10000}
    return "".join(one), "".join(one.values())


@lru_cache(maxsize=1)
def _several() -> dict[str, str]:
    """Characters that look like several, such as ligatures and Roman numerals."""
    return {a: b for a, b in _table().items() if len(b) > 1 and len(b) < 6 and ord(a) < 0x10000}


#: Characters without width or colour of their own.
INVISIBLE = r"[\p{Cf}\p{Cc}͏ᅟᅠ឴឵᠋-᠏ㅤ︀-️ﾠ&&[^\t\n\r]]|[\x{E0100}-\x{E01EF}]"
#: Spaces of any kind, which are seen only between words.
SPACES = r"[\p{Z}\t\n\r\x0B\x0C\x85]+"


def _mapped(c: Column) -> Column:
    """Look-alikes of one character mapped, the invisible removed, spaces one and none at the ends."""
    return F.translate(F.trim(F.regexp_replace(F.regexp_replace(c, INVISIBLE, ""), SPACES, " ")), *_map())


def _spelt_out(one: Column) -> Column:
    """Characters that look like several, spelt out. Few texts have any, and one look is cheaper than a replacement for each."""
    many = one
    for a, b in _several().items():
        many = F.replace(many, F.lit(a), F.lit(b))
    return F.when(one.rlike("[" + "".join(f"\\x{{{ord(a):X}}}" for a in _several()) + "]"), many).otherwise(one) if _several() else one


def looks_like(c: Column | str) -> Column:
    """The text as the eye reads it: look-alikes mapped, the invisible removed, spaces one and none at the ends. Null stays null."""
    return _spelt_out(_mapped(F.col(c) if isinstance(c, str) else c))


def classes(names: DataFrame, name: str = "name") -> DataFrame:
    """(name, n, canonical, class_id): every distinct name with the canonical member of its class.

    Names are equal when their mapped forms are, under the collation. The
    canonical member is the one written with the fewest unusual characters,
    then the most frequent, then the smallest; class_id is its hash. A null
    name belongs to no class and is left out; the empty name has its own.
    """
    distinct = names.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n"))
    plain = F.col("name").rlike(r"^[\x20-\x7E]*$")
    odd = F.length("name") - F.length(F.regexp_replace("name", INVISIBLE + r"|[\p{Z}&&[^ ]]|[！-～]|\p{M}", "")) + F.length("name") - F.length(F.trim(F.regexp_replace("name", " {2,}", " ")))
    mixed = F.col("name").rlike(r"\p{IsLatin}\p{M}*[\p{IsCyrillic}\p{IsGreek}]|[\p{IsCyrillic}\p{IsGreek}]\p{M}*\p{IsLatin}").cast("int")
    # in two steps, so that the mapping is not worked out once more where it is looked at and where it is used
    first = distinct.select("name", "n", F.when(plain, F.trim(F.regexp_replace("name", " +", " "))).otherwise(_mapped(F.col("name"))).alias("one"), F.when(plain, F.length("name") - F.length(F.trim(F.regexp_replace("name", " {2,}", " ")))).otherwise(odd).alias("odd"), F.when(plain, 0).otherwise(mixed).alias("mixed"), plain.alias("plain"))
    keyed = materialize(first.select("name", "n", F.when(F.col("plain"), F.col("one")).otherwise(_spelt_out(F.col("one"))).alias("key"), "odd", "mixed"), "names")
    best = F.min_by("name", F.struct("odd", "mixed", (-F.col("n")).alias("n"), "name")).alias("canonical")
    rep = keyed.groupBy(F.collate("key", COLLATION).alias("ckey")).agg(best, F.count("*").alias("n_forms"))
    back = keyed.withColumn("ckey", F.collate("key", COLLATION)).join(rep, "ckey")
    return back.select("name", "n", F.col("key"), "canonical", "n_forms", F.xxhash64("canonical").alias("class_id"))


def current_names(items: DataFrame) -> DataFrame:
    """(file_id, name) by the row listed last; ties go to the greatest name."""
    r = F.max(F.struct("listed_at", "name")).alias("r")
    return items.where(F.col("file_id").isNotNull()).groupBy("file_id").agg(r).select("file_id", F.col("r.name").alias("name"))


#: Members of one spelling that one task pairs; a spelling of more is dealt into parts.
MEMBERS = 50_000


def look_alike_pairs(objects: DataFrame, forms: DataFrame) -> DataFrame:
    """(file_id_a, file_id_b), file_id_a < file_id_b, of objects whose names look the same and are not the same string.

    Spellings are paired within a class, never objects: copies of one spelling
    meet only members of other spellings, so no pair is made that is not in the
    result. Both sides of a pair of spellings are dealt into parts of MEMBERS,
    and parts meet parts, so a name that a third of all objects bear does not
    fill one task.
    """
    # read three times below, and far fewer than all names
    many = materialize(forms.where(F.col("n_forms") > 1).select("class_id", "name", F.ceil(F.col("n") / MEMBERS).cast("int").alias("parts")), "spellings")
    other = many.select("class_id", F.col("name").alias("name2"), F.col("parts").alias("parts2"))
    pairs = many.join(other, "class_id").where(F.col("name") < F.col("name2"))
    grid = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts2") - 1)))
    side = split_join(objects, many.select("name", "parts"), "name", "inner")
    side = side.select("file_id", "name", F.pmod(F.xxhash64("file_id"), F.col("parts")).cast("int").alias("part"))
    a = side.withColumnRenamed("file_id", "a").join(grid.select("name", "part", "name2", "part2"), ["name", "part"])
    b = side.select(F.col("file_id").alias("b"), F.col("name").alias("name2"), F.col("part").alias("part2"))
    return a.join(b, ["name2", "part2"]).select(F.least("a", "b").alias("file_id_a"), F.greatest("a", "b").alias("file_id_b"))


def links(objects: DataFrame, forms: DataFrame) -> DataFrame:
    """(file_id, class_id, n_links): of each object the number of those whose name looks the same and is written differently.

    The same result as the pairs, one row an object. Null names have no class and no links.
    """
    sized = forms.select("name", "class_id", "n").join(forms.groupBy("class_id").agg(F.sum("n").alias("all")), "class_id")
    return split_join(objects, sized, "name", "left").select("file_id", F.col("class_id"), F.coalesce(F.col("all") - F.col("n"), F.lit(0)).alias("n_links"))


def canonical_names(objects: DataFrame, forms: DataFrame) -> DataFrame:
    """(file_id, name, canonical_name): one consistent form of each object's name; null names keep null."""
    return split_join(objects, forms.select("name", F.col("canonical").alias("canonical_name")), "name", "left").select("file_id", "name", "canonical_name")
