"""Workbooks: sheets of .xlsx files as rows, and frames as sheets, by the standard library's zip and XML readers."""

from __future__ import annotations

import io
import itertools
import json
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from stratawork.functions.columns import map_headers, safe_text, typed_schema
from stratawork.session import ship
from stratawork.sources.sinks import checked_header

#: Rows of a sheet and characters of a cell at most; limits of the format and of the sheets written here.
SHEET_ROWS, CELL_CHARS = 1_048_576, 32_000
#: Rows of a report in one book at most, and of each of many books.
REPORT_ROWS, BOOK_ROWS = 4 * SHEET_ROWS, SHEET_ROWS - 1
#: Headers that name a column of file types; fixed values.
TYPE_HEADERS = ("extension", "ext", "file_type", "filetype", "type")
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _place(ref: str) -> int:
    """Column number, from 0, of a cell's reference."""
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, e in ET.iterparse(f):
            if _local(e.tag) == "si":
                out.append("".join(t.text or "" for t in e.iter() if _local(t.tag) == "t"))
                e.clear()
    return out


def sheets(data: bytes) -> Iterator[tuple[str, Iterator[tuple[int, list[str | None]]]]]:
    """(name, rows) of each sheet in the book's order; a row is its number and its cells as text, a gap is null."""
    book = zipfile.ZipFile(io.BytesIO(data))
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    shared = _strings(book)
    for s in ET.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(s.tag) == "sheet":
            target = targets[s.get(_REL)].lstrip("/")
            yield s.get("name"), _rows(book, target if target.startswith("xl/") else f"xl/{target}", shared)


def _rows(book: zipfile.ZipFile, name: str, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    with book.open(name) as f:
        number = 0
        for _, e in ET.iterparse(f):
            if _local(e.tag) != "row":
                continue
            number = int(e.get("r") or number + 1)
            cells: list[str | None] = []
            for c in e:
                at = _place(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                kind = c.get("t")
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter() if _local(t.tag) == "t")
                else:
                    value = next((v.text for v in c if _local(v.tag) == "v"), None)
                    if kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "b" and value is not None:
                        value = "TRUE" if value == "1" else "FALSE"
                cells[at] = value
            yield number, cells
            e.clear()


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, position, row, cells) of all sheets of all workbooks at ``path``: a task a few files, a row at a time."""
    ship(spark)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k, (sheet, rows) in enumerate(sheets(data)):
                    held: list[tuple] = []
                    for number, cells in rows:
                        held.append((file, sheet, k, number, cells))
                        if len(held) == 2000:
                            yield _batch(pa, held)
                            held = []
                    yield _batch(pa, held)

    def _batch(pa, held):
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        cols = list(zip(*held, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["path", "sheet", "position", "row", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, sheet string, position int, row bigint, cells array<string>")


def headers(spark: SparkSession, path: str, sheet: str | None = None) -> list[str | None]:
    """The first row of a sheet, the first sheet if none is named; ValueError names the sheets that are there."""
    cells = read_cells(spark, path)
    top = cells.filter(F.col("row") == 1)
    row = (top.filter(F.col("sheet") == sheet) if sheet is not None else top.filter("position = 0")).select("cells").first()
    if row is None:
        there = sorted({r["sheet"] for r in cells.select("sheet").distinct().collect()})  # the names of one book's sheets
        raise ValueError(f"{path} has no sheet {sheet!r} with a header; it has {there}")
    return row["cells"]


def read_rows(spark: SparkSession, path: str, sheet: str | None = None, mapped: bool = True, integers: set[str] = frozenset(), blank: bool = False) -> DataFrame:
    """The rows of a sheet below its header: short ones padded, long ones cut, those of nulls alone dropped.

    ``mapped`` makes column names of the headers, else a null header is col_i;
    ``integers`` are loaded as whole numbers, all others as text; ``blank``
    has nulls as empty text.
    """
    from stratawork.functions.columns import to_long

    found = headers(spark, path, sheet)
    names = map_headers(found) if mapped else [h if h else f"col_{i}" for i, h in enumerate(found)]
    cells = read_cells(spark, path).filter(F.col("row") > 1)
    cells = cells.filter(F.col("sheet") == sheet) if sheet is not None else cells.filter("position = 0")
    cells = cells.filter(F.exists("cells", lambda c: c.isNotNull()))
    schema = typed_schema(names, set(integers))
    out = []
    for i, f in enumerate(schema):
        c = F.get("cells", F.lit(i))
        c = to_long(c) if isinstance(f.dataType, T.LongType) else F.coalesce(c, F.lit("")) if blank else c
        out.append(c.alias(f.name))
    return cells.select(*out)


def type_column(spark: SparkSession, path: str, wanted: tuple[str, ...] = TYPE_HEADERS) -> DataFrame:
    """(sheet, value) of the first column of each tab whose header is one of ``wanted``; blank is (blank)."""
    cells = read_cells(spark, path)
    low = F.transform("cells", lambda c: F.lower(F.trim(c)))
    at = F.array_min(F.filter(F.transform(F.array(*map(F.lit, wanted)), lambda w: F.array_position(low, w)), lambda k: k > 0))
    heads = cells.filter("row = 1").select("path", "sheet", at.cast("int").alias("at")).filter("at is not null")
    value = F.trim(F.get("cells", F.col("at") - 1))
    return cells.filter("row > 1").join(heads, ["path", "sheet"]).select("sheet", F.when(F.coalesce(value, F.lit("")) == "", "(blank)").otherwise(value).alias("value"))


def _column(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(ref: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def write_workbook(tables: dict[str, DataFrame], path: str, cap: int = CELL_CHARS, none: str = "No issues found.", sheet_rows: int = SHEET_ROWS, most: int = REPORT_ROWS) -> dict[str, int]:
    """Frames as the sheets of one workbook at any path that Spark writes; gives the rows of each sheet.

    A book is one file, built in a file of the driver and moved when whole, so
    this is for reports: more than ``most`` rows raise, before any is moved,
    and go by ``write_books``. Rows stream from one partition at a time. Text is capped, clean of control
    characters and stored as text, so it is never a formula; an empty frame
    says so in one cell; one with more rows than a sheet holds goes on in
    sheets named _2, _3. Widths are those of the first 200 rows.
    """
    spark = next(iter(tables.values())).sparkSession
    left = most

    def rows_of(df):
        nonlocal left
        for r in df.select(*_safe(df, cap)).toLocalIterator():
            if not left:
                raise ValueError(f"more than {most} rows for one workbook: write_books writes many")
            left -= 1
            yield r

    with tempfile.TemporaryDirectory() as staging:
        local = f"{staging}/book.xlsx"
        with open(local, "wb") as f:
            made = _fill(f, {name: (df.columns, rows_of(df)) for name, df in tables.items()}, none, sheet_rows)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        target = hadoop(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(False, True, hadoop(f"file://{local}"), target)
    return made


def _safe(df: DataFrame, cap: int) -> list[Column]:
    return [safe_text(F.col(f"`{n}`"), cap).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes]


def _fill(f, tables: dict[str, tuple[list[str], Iterator]], none: str, sheet_rows: int) -> dict[str, int]:
    """A workbook into an open file, which need not seek; each table is its columns and its rows. Gives the rows of each sheet."""
    made: dict[str, int] = {}
    with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        for name, (columns, rows) in tables.items():
            first = next(rows, None)
            if first is None:
                made[name] = 0
                _sheet(z, len(made), [[none]])
                continue
            source = _Rows(first, rows)
            part = 0
            while source.more:
                part += 1
                title = name if part == 1 else f"{name}_{part}"
                body = source.take(sheet_rows - 1)
                head = list(itertools.islice(body, 200))
                widths = [min(60, max(8, len(h), *(len(str(r[k] or "")) for r in head)) + 2) for k, h in enumerate(columns)]
                made[title] = 0
                _sheet(z, len(made), itertools.chain([list(columns)], head, body), widths)
                made[title] = source.taken
        titles = list(made)
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(titles) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>')
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(titles) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        names = "".join(f'<sheet name={quoteattr(_title(t))} sheetId="{i}" r:id="rId{i}"/>' for i, t in enumerate(titles, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
    return made


def _title(name: str) -> str:
    return re.sub(r"[\[\]:*?/\\]", "_", name)[:31]


class _Rows:
    """Rows of an iterator, some at a time."""

    def __init__(self, first, rest):
        self.next, self.rest, self.taken = first, rest, 0

    @property
    def more(self) -> bool:
        return self.next is not None

    def take(self, most: int):
        self.taken = 0
        while self.more and self.taken < most:
            row, self.next = self.next, next(self.rest, None)
            self.taken += 1
            yield list(row)


def _sheet(z: zipfile.ZipFile, number: int, rows, widths: list[int] = ()) -> None:
    with z.open(f"xl/worksheets/sheet{number}.xml", "w") as f:
        cols = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
        f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{f"<cols>{cols}</cols>" if cols else ""}<sheetData>'.encode())
        for n, row in enumerate(rows, 1):
            f.write(f'<row r="{n}">{"".join(_cell(f"{_column(k)}{n}", v) for k, v in enumerate(row))}</row>'.encode())
        f.write(b"</sheetData></worksheet>")


MANIFEST = "_books.json"


def _files(uri: str):
    """The file system of a folder as pyarrow's client knows it, and the folder in it."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    return fs.FileSystem.from_uri("file:///" + rest.lstrip("/") if scheme == "file" else f"{scheme.replace('s3a', 's3')}:{rest}")


@dataclass
class _Books(WriterCommitMessage):
    """What a task wrote: (number, hidden name, rows) of its books."""

    books: list


class _BookWriter(DataSourceWriter):
    """Tasks write whole books under hidden names of their attempts; the commit names those that won and lists them with their rows, the abort removes all."""

    def __init__(self, uri: str, columns: list[str], title: str, sheet_rows: int):
        self.uri, self.columns, self.title, self.sheet_rows, self.run = uri, columns, title, sheet_rows, uuid.uuid4().hex

    def write(self, iterator):
        files, root = _files(self.uri)
        files.create_dir(root)
        books, attempt = [], uuid.uuid4().hex
        for number, rows in itertools.groupby(iterator, lambda r: r[0]):
            name = f".{self.run}-{number}-{attempt}"
            with files.open_output_stream(f"{root}/{name}") as f:
                made = _fill(f, {self.title: (self.columns, (r[2:] for r in rows))}, "", self.sheet_rows)
            books.append((number, name, sum(made.values())))
        return _Books(books)

    def commit(self, messages):
        files, root = _files(self.uri)
        files.create_dir(root)
        listed = _listed(files, root)
        for number, name, rows in sorted(b for m in messages if m is not None for b in m.books):
            final = f"book-{number:06d}.xlsx"
            files.move(f"{root}/{name}", f"{root}/{final}")
            listed.append([final, rows])
        with files.open_output_stream(f"{root}/.{self.run}") as f:
            f.write(json.dumps({"header": self.columns, "books": listed}).encode())
        files.move(f"{root}/.{self.run}", f"{root}/{MANIFEST}")
        self.abort(messages)  # attempts that lost

    def abort(self, messages):
        from pyarrow import fs

        files, root = _files(self.uri)
        for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if f.base_name.startswith(f".{self.run}"):
                files.delete_file(f.path)


def _manifest(files, root: str) -> dict:
    try:
        with files.open_input_stream(f"{root}/{MANIFEST}") as f:
            return json.loads(f.read())
    except FileNotFoundError:
        return {"header": None, "books": []}


def _listed(files, root: str) -> list:
    return _manifest(files, root)["books"]


def write_books(df: DataFrame, path: str, order: list[str], rows: int = BOOK_ROWS, title: str = "rows", cap: int = CELL_CHARS, sheet_rows: int = SHEET_ROWS) -> list[tuple[str, int]]:
    """``df`` in order as workbooks of ``rows`` rows in a folder, each written by a task straight into it; gives the folder's books and their rows.

    A folder that has books gets more, after those that are there; one of
    other columns raises before any is written. Only listed books count: a
    load that fails lists none and leaves none. Without rows no book is
    written. Text is as in ``write_workbook``.
    """
    from stratawork.operators.windows import rollover

    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    there = _manifest(*_files(uri))
    if there["header"] is not None:
        checked_header(there["header"], df.columns, path)
    writer, before = _BookWriter(uri, df.columns, title, sheet_rows), len(there["books"])

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return "workbooks"

        def writer(self, schema, overwrite):
            return writer

    ship(spark)
    spark.dataSource.register(Sink)
    placed = rollover(df.select(*_safe(df, cap)), order, rows)
    books = placed.select((F.col("tab") + before).alias("__book"), F.col("row_in_tab").alias("__row"), *(F.col(f"`{c}`") for c in df.columns))
    books.repartition("__book").sortWithinPartitions("__book", "__row").write.format("workbooks").mode("append").save()
    return [tuple(b) for b in _listed(*_files(uri))]
