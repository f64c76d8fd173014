"""Writers: CSV with localized headers, JSON lines, metrics, markdown and workbooks.

Tables of any size go to CSV, JSON lines or parquet. Markdown and workbooks
are for small tables: one that is too large for them is an error, never cut.
"""

from __future__ import annotations

import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, headers: dict[str, str] | None = None, mark: bool = False) -> None:
    """Only the columns named, renamed by `headers`; arrays and maps as text. `mark` starts each file with a byte order mark."""
    df = df.select(*(columns or df.columns))
    flat = [F.array_join(F.col(c).cast("array<string>"), ";").alias(c) if t.startswith("array<") and "struct" not in t else F.to_json(c).alias(c) if t.startswith(("struct", "map", "array<")) else F.col(c) for c, t in df.dtypes]
    out = df.select(*flat).withColumnsRenamed(headers or {})
    if mark:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def metrics_json(one_row: DataFrame) -> str:
    """The single row of a metrics table as JSON text."""
    return one_row.select(F.to_json(F.struct("*")).alias("j")).first()["j"]


#: The most rows that are brought to the driver for a document, and characters in a cell of a workbook.
MOST_ROWS, MOST_CELL = 100_000, 32_767


def _small(df: DataFrame, most: int) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write the table as CSV or parquet")
    return rows


def markdown_table(df: DataFrame, most: int = MOST_ROWS) -> str:
    """A report's table, whole; the caller orders it. A table of more than `most` rows is an error."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    head = f"| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return head + "".join(f"| {' | '.join(map(cell, r))} |\n" for r in _small(df, most))


def markdown_report(title: str, notes: list[str], sections: dict[str, DataFrame]) -> str:
    """A report: title, notes as a list, and a table a section."""
    body = [f"# {title}", "", *(f"- {n}" for n in notes), *([""] if notes else [])]
    for name, df in sections.items():
        body += [f"## {name}", "", markdown_table(df)]
    return "\n".join(body)


def checklist(df: DataFrame, column: str) -> str:
    """The values of a column as a list to be ticked off."""
    return "".join(f"- [ ] {r[0]}\n" for r in _small(df.select(F.coalesce(F.col(column).cast("string"), F.lit(""))), MOST_ROWS))


def folder_tree(folders: DataFrame, path: str = "full_path", depth: str = "depth") -> str:
    """Folders as an indented list, by path; a null path is left out."""
    rows = _small(folders.where(F.col(path).isNotNull()).select(path, depth).orderBy(path), MOST_ROWS)
    return "".join(f"{'  ' * max(r[1] or 0, 0)}- {r[0].rstrip('/').rpartition('/')[2] or '/'}\n" for r in rows)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document to any file system Spark knows."""
    write_bytes(spark, text.encode(), path)


def write_bytes(spark: SparkSession, data: bytes, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(data))
    out.close()


def write_workbook(sheets: dict[str, DataFrame], path: str, most: int = MOST_ROWS) -> None:
    """A spreadsheet of small report tables, whole, with a frozen header row and a filter.

    A table of more than `most` rows or a cell of more than 32,767 characters
    is an error. Sheets' names are cut to the 31 characters the format allows
    and told apart by number where they then agree.
    """
    from xml.sax.saxutils import escape
    from zipfile import ZIP_DEFLATED, ZipFile

    spark = next(iter(sheets.values())).sparkSession
    buffer = io.BytesIO()

    def column(i: int) -> str:
        return (column(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)

    def cell(r: int, i: int, v: object) -> str:
        at = f"{column(i)}{r}"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{at}"><v>{v}</v></c>'
        clean = "".join(c for c in ("" if v is None else str(v)) if c in "\t\n\r" or ord(c) >= 32)
        if len(clean) > MOST_CELL:
            raise ValueError(f"cell {at} has {len(clean)} characters: write the table as CSV or parquet")
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'

    ns, head = "http://schemas.openxmlformats.org", '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = f"{ns}/spreadsheetml/2006/main", f"{ns}/officeDocument/2006/relationships"
    names = []
    for n in sheets:
        short, k = n[:31], 1
        while short.lower() in (x.lower() for x in names):
            k += 1
            short = f"{n[: 30 - len(str(k))]}~{k}"
        names.append(short)
    with ZipFile(buffer, "w", ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{ns}/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
        for i, df in enumerate(sheets.values(), 1):
            rows = [df.columns, *_small(df, most)]
            body = "".join(f'<row r="{r}">{"".join(cell(r, k, v) for k, v in enumerate(row))}</row>' for r, row in enumerate(rows, 1))
            view = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'{head}<worksheet xmlns="{main}">{view}<sheetData>{body}</sheetData><autoFilter ref="A1:{column(len(df.columns) - 1)}{len(rows)}"/></worksheet>')
    write_bytes(spark, buffer.getvalue(), path)
