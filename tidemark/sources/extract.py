"""Text of file bytes by kind, with a status for every file.

Plain text and markup are handled by column expressions. RTF, CSV, zipped
office formats and PDF need a parser and go through one Arrow function; what a
library would be needed for says so in its status instead of failing the run.
Whole files are read; limits are options, and a text that one has cut says
`truncated`.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import guess_language, normalize_spaces, strip_markup
from ..session import ship

ROUTES = {"txt": "plain", "log": "plain", "md": "plain", "json": "plain", "xml": "html", "html": "html", "htm": "html", "rtf": "parsed", "csv": "parsed", "docx": "parsed", "pptx": "parsed", "xlsx": "parsed", "pdf": "parsed", "jpg": "ocr", "jpeg": "ocr", "png": "ocr"}
NATIVE = "application/vnd.google-apps."


def route(extension: Column, mime: Column) -> Column:
    """plain, html, parsed, export, refused, ocr or unsupported, by native type, extension and then by type.

    A native document comes as exported plain text; native sheets and all
    other native kinds are refused.
    """
    e, m = F.lower(F.coalesce(extension, F.lit(""))), F.coalesce(mime, F.lit(""))
    by = F.when(m == NATIVE + "document", "export").when(F.startswith(m, F.lit(NATIVE)), "refused")
    for k in sorted(set(ROUTES.values())):
        by = by.when(e.isin(*(x for x, r in ROUTES.items() if r == k)), k)
    return by.when(F.startswith(m, F.lit("text/html")), "html").when(F.startswith(m, F.lit("text/")), "plain").when(F.startswith(m, F.lit("image/")), "ocr").otherwise("unsupported")


def supported(extension: Column, mime: Column) -> Column:
    """Whether a file's bytes are worth fetching: anything that has a way to its text here."""
    return route(extension, mime).isin("plain", "html", "parsed", "export")


def _xml_text(data: bytes) -> str:
    try:
        return " ".join(t.strip() for t in ElementTree.fromstring(data).itertext() if t.strip())
    except ElementTree.ParseError:
        return ""


def _number(name: str) -> int:
    return int((re.findall(r"\d+", name) or ["0"])[-1])


#: Groups of RTF that hold no text of the document.
_RTF_SILENT = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "footer", "generator", "listtable", "listoverridetable", "rsidtbl", "xmlnstbl", "themedata", "datastore"}
_RTF_SPACE = {"par": "\n", "line": "\n", "sect": "\n", "page": "\n", "row": "\n", "cell": "\t", "tab": "\t", "emdash": "—", "endash": "–", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "bullet": "•"}
_RTF_TOKEN = re.compile(rb"\\([a-zA-Z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-zA-Z])|([{}])|[\r\n]+|([^\\{}\r\n]+)")


def rtf_text(data: bytes) -> str:
    """Text of RTF: letters given by code page or by number are decoded, groups that are no text are left out."""
    page, out, raw = "cp1252", [], bytearray()
    silent, skip, skips, stack = False, 0, 1, []  # skips: how many characters stand in for one given by number

    def flush() -> None:
        if raw:
            out.append(bytes(raw).decode(page, "replace"))
            raw.clear()

    for m in _RTF_TOKEN.finditer(data):
        word, value, code, symbol, brace, plain = m.groups()
        if brace == b"{":
            stack.append((silent, skips))
        elif brace == b"}":
            flush()
            silent, skips = stack.pop() if stack else (False, 1)
            skip = 0
        elif word is not None:
            name = word.decode()
            if name == "ansicpg" and value:
                page = f"cp{int(value)}" if int(value) not in (0, 65001) else "utf-8"
            elif name == "uc":
                skips = int(value or 1)
            elif name in _RTF_SILENT:
                silent = True
            elif name == "bin":
                skip = 0
            elif name == "u" and value and not silent:
                flush()
                out.append(chr(int(value) % 65536))
                skip = skips
            elif name in _RTF_SPACE and not silent:
                flush()
                out.append(_RTF_SPACE[name])
        elif symbol is not None:
            if symbol == b"*":
                silent = True
            elif not silent and symbol in b"\\{}":
                raw += symbol
            elif not silent and symbol == b"~":
                raw += b" "
        elif code is not None:
            if skip:
                skip -= 1
            elif not silent:
                raw.append(int(code, 16))
        elif plain is not None and not silent:
            raw += plain[skip:]
            skip = max(0, skip - len(plain))
    flush()
    text = "".join(out)
    # pairs of numbers that are one character beyond the basic plane
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def csv_text(data: bytes) -> str:
    """Rows of a CSV as lines, cells joined by spaces."""
    rows = csv.reader(io.StringIO(data.decode("utf-8-sig", "replace"), newline=""))
    return "\n".join(" ".join(row) for row in rows)


_PDF_STRING = re.compile(rb"\(((?:\\.|[^()\\])+)\)", re.S)
_PDF_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)


def pdf_text(data: bytes) -> str:
    """The parenthesised strings of a PDF, of its deflated streams too; fonts of other encodings come out wrong or not at all."""
    parts = [data]
    for m in _PDF_STREAM.finditer(data):
        try:
            parts.append(zlib.decompress(m.group(1)))
        except zlib.error:
            continue
    found = (x.group(1) for part in parts for x in _PDF_STRING.finditer(part))
    return " ".join(re.sub(rb"\\([()\\])", rb"\1", x).decode("latin-1") for x in found)


def _sheet_lines(z: zipfile.ZipFile, names: list[str], sheets: int | None, rows: int | None) -> tuple[list[str], bool]:
    shared = ["".join(t.text or "" for t in x.iter() if t.tag.rpartition("}")[2] == "t") for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    found = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=_number)
    lines, cut = [], sheets is not None and len(found) > sheets
    for n in found[:sheets]:
        all_rows = [x for x in ElementTree.fromstring(z.read(n)).iter() if x.tag.rpartition("}")[2] == "row"]
        cut = cut or (rows is not None and len(all_rows) > rows)
        for r in all_rows[:rows]:
            cells = []
            for c in r:
                value = "".join(v.text or "" for v in c.iter() if v.tag.rpartition("}")[2] in ("v", "t"))
                cells.append(shared[int(value)] if c.get("t") == "s" and value.isdigit() and int(value) < len(shared) else value)
            lines.append(" | ".join(x for x in cells if x))
    return lines, cut


def parsed_text(data: bytes, extension: str, sheets: int | None = None, rows: int | None = None, slides: int | None = None) -> tuple[str, str]:
    """(text, status) of an rtf, csv, docx, pptx, xlsx or pdf; whole unless a limit is given."""
    try:
        if extension == "rtf":
            return rtf_text(data), "extracted"
        if extension == "csv":
            return csv_text(data), "extracted"
        if extension == "pdf":
            text = pdf_text(data)
            return text, "extracted" if text.strip() else "needs_ocr"
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = z.namelist()
            if extension == "docx":
                # headers, footers, notes and comments are parts of their own; the document comes first
                parts = [n for n in names if re.fullmatch(r"word/[^/]+\.xml", n) and re.search(r"(document|header|footer|notes|comments)[^/]*\.xml$", n)]
                return "\n".join(_xml_text(z.read(n)) for n in sorted(parts, key=lambda n: (n != "word/document.xml", n))), "extracted"
            if extension == "pptx":
                found = sorted((n for n in names if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=_number)
                return "\n".join(_xml_text(z.read(n)) for n in found[:slides]), "truncated" if slides is not None and len(found) > slides else "extracted"
            lines, cut = _sheet_lines(z, names, sheets, rows)
            return "\n".join(lines), "truncated" if cut else "extracted"
    except Exception as e:  # a broken file is a row with an error, not a failed run
        return "", f"error:{type(e).__name__}"


def _parse(limits: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [parsed_text(d, e, **limits) if d is not None else ("", "no_content") for d, e in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], ["file_id", "text", "status"])

    return run


def extract(files: DataFrame, most_chars: int | None = None, sheets: int | None = None, rows: int | None = None, slides: int | None = None) -> DataFrame:
    """(file_id, text, status) of files (file_id, extension, mime_type, content BINARY), one row each.

    Whole texts unless limits are given; a text cut by one has the status
    `truncated`. Bytes that are no UTF-8 are replaced. Null content says
    no_content, native kinds other than documents say refused.
    """
    ship(files.sparkSession)
    r = files.select("file_id", F.lower(F.coalesce("extension", F.lit(""))).alias("extension"), "content", route(F.col("extension"), F.col("mime_type")).alias("route"))
    raw = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "^\ufeff", "")
    text = F.when(F.col("route").isin("plain", "export"), raw).when(F.col("route") == "html", strip_markup(raw)).otherwise("")
    status = F.when(F.col("route") == "refused", "refused").when(F.col("content").isNull(), "no_content").when(F.col("route").isin("plain", "html", "export"), "extracted").when(F.col("route") == "ocr", "ocr_unavailable").otherwise("unsupported")
    simple = r.where(F.col("route") != "parsed").select("file_id", F.coalesce(text, F.lit("")).alias("text"), status.alias("status"))
    limits = {"sheets": sheets, "rows": rows, "slides": slides}
    parsed = r.where(F.col("route") == "parsed").select("file_id", "content", "extension").mapInArrow(_parse(limits), "file_id string, text string, status string")
    out = simple.unionByName(parsed)
    if most_chars is None:
        return out
    long = F.length("text") > most_chars
    return out.withColumns({"status": F.when(long & (F.col("status") == "extracted"), "truncated").otherwise(F.col("status")), "text": F.substring("text", 1, most_chars)})


def describe(texts: DataFrame) -> DataFrame:
    """Hash, length and language of texts; the text itself is dropped before any sink. A cut text has no hash, as it may begin like another."""
    whole = (F.length("text") > 0) & (F.col("status") != "truncated")
    return texts.select("file_id", "status", F.length("text").alias("content_length"), F.when(whole, F.sha2("text", 256)).otherwise("").alias("content_text_hash"), guess_language(normalize_spaces("text")).alias("language"))


def ocr_statuses(files: DataFrame, engine_present: bool = False) -> DataFrame:
    """(file_id, status) of images and of PDFs without text: what a recogniser would be asked for, or why not.

    files: (file_id, extension, mime_type, status) of extract(); empty without such files.
    """
    wanted = (route(F.col("extension"), F.col("mime_type")) == "ocr") | (F.col("status") == "needs_ocr")
    return files.where(wanted).select("file_id", F.when(F.lit(engine_present), "ocr_queued").otherwise("ocr_unavailable").alias("status"))
