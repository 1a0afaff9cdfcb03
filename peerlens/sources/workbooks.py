"""Sheets of workbooks (``.xlsx``) as a Spark data source, without an Excel library.

A workbook is a zip of XML files.  A sheet is one packed stream, so one task
reads one sheet of one file, row by row, and keeps only the cells asked for; the
format bounds a sheet to 1,048,576 rows.  Of the texts that all sheets share,
a task keeps those of its columns' cells.  Many workbooks in a folder are read
side by side.  Cells come as text and are cast by position, as those of
delimited files; dates are the format's day numbers, errors and blanks are
missing, and rows without any value do not count.
"""

from __future__ import annotations

import io
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby, islice
from operator import itemgetter
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from peerlens.functions.columns import pick_positions
from peerlens.sources.shared_files import files_of, opened, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_ROWS = 10_000
WRITTEN_ROWS = 1000  # rows or texts that are packed at once
# Fixed values of the format: parts, name spaces and kinds of cells, rows of a sheet.
BOOK, LINKS, TEXTS = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
MOST_ROWS = 1_048_576
MISSING_TEXTS = {"", "NA"}


class BrokenWorkbook(ValueError):
    """A file that is no workbook, or one without the sheet asked for."""


@dataclass(frozen=True)
class Sheet:
    """A sheet as an input: a workbook or a folder of them, and the sheet's name."""

    path: str
    name: str


def column_number(reference: str) -> int:
    """1-based column of a cell reference such as ``BC12``."""
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number


def column_letters(number: int) -> str:
    letters = ""
    while number:
        number, rest = divmod(number - 1, 26)
        letters = chr(65 + rest) + letters
    return letters


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _elements(file, name: str) -> Iterator[ElementTree.Element]:
    """Whole elements of a name, one after the other; what was read is let go."""
    events = ElementTree.iterparse(file, events=("start", "end"))
    depth, parents = 0, []
    for event, element in events:
        if event == "start":
            parents.append(element)
            depth += _local(element.tag) == name
            continue
        parents.pop()
        if _local(element.tag) == name:
            depth -= 1
            yield element
        if not depth:
            element.clear()
            if parents:
                parents[-1].remove(element)


def _text_of(element: ElementTree.Element) -> str:
    """The text of a string item: its own, or that of its runs, without readings set above."""
    parts = []
    for child in element:
        if _local(child.tag) == "t":
            parts.append(child.text or "")
        elif _local(child.tag) == "r":
            parts += [t.text or "" for t in child if _local(t.tag) == "t"]
    text = "".join(parts)
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m.group(1), 16)), text) if "_x" in text else text


def sheets_of(book: zipfile.ZipFile, path: str) -> dict[str, str]:
    """Name of each sheet and the part it lies in."""
    try:
        with book.open(LINKS) as file:
            targets = {e.get("Id"): e.get("Target") for e in _elements(file, "Relationship")}
        with book.open(BOOK) as file:
            found = {e.get("name"): targets.get(e.get(f"{{{RELATIONS}}}id")) for e in _elements(file, "sheet")}
    except (KeyError, ElementTree.ParseError) as e:
        raise BrokenWorkbook(f"{path}: {e}") from e
    return {n: t.lstrip("/") if t.startswith("/") else posixpath.normpath(f"xl/{t}") for n, t in found.items() if t}


def _cell(cell: ElementTree.Element) -> tuple[str, str | None]:
    """Kind and raw value of a cell."""
    kind = cell.get("t", "n")
    for child in cell:
        name = _local(child.tag)
        if name == "is":
            return "text", _text_of(child)
        if name == "v":
            return kind, child.text
    return kind, None


def rows_of(book: zipfile.ZipFile, part: str, places: Sequence[int], skip: int) -> Iterator[tuple[int, list]]:
    """``(row number, cells at the 1-based places)`` of rows with any value after the first ``skip`` of them.

    Shared texts come as their numbers.
    """
    wanted = {p: i for i, p in enumerate(places)}
    with book.open(part) as file:
        number, seen = 0, 0
        for row in _elements(file, "row"):
            number = int(row.get("r") or number + 1)
            column, out, any_value = 0, [None] * len(places), False
            for cell in row:
                if _local(cell.tag) != "c":
                    continue
                column = column_number(cell.get("r")) if cell.get("r") else column + 1
                kind, value = _cell(cell)
                any_value = any_value or value is not None
                if column not in wanted or value is None or kind == "e":
                    continue
                if kind == "s":
                    value = int(value)
                elif kind == "b":
                    value = "true" if value == "1" else "false"
                out[wanted[column]] = value
            if any_value:
                seen += 1
                if seen > skip:
                    yield number, out


def shared_texts(book: zipfile.ZipFile, used: set[int]) -> dict[int, str]:
    """The used ones of the texts that sheets share."""
    if not used:
        return {}
    with book.open(TEXTS) as file:
        return {i: _text_of(e) for i, e in enumerate(_elements(file, "si")) if i in used}


@dataclass
class OneSheet(InputPartition):
    path: str


class SheetReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path, self.sheet = options["path"], options["sheet"]
        self.skip = int(options.get("skip", 1))
        self.places = [int(n[1:]) for n in schema.names]
        self.names = schema.names

    def partitions(self) -> Sequence[InputPartition]:
        found = [OneSheet(path) for path, _ in files_of(self.path, ".xlsx")]
        if not found:
            raise BrokenWorkbook(f"{self.path}: no .xlsx file")
        return found

    def read(self, part: OneSheet) -> Iterator[pa.RecordBatch]:
        with opened(part.path) as raw:
            try:
                with zipfile.ZipFile(io.BufferedReader(raw, 1 << 20)) as book:
                    yield from self._batches(book, part.path)
            except BrokenWorkbook:
                raise
            except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError) as e:
                raise BrokenWorkbook(f"{part.path}, sheet {self.sheet}: {e}") from e

    def _batches(self, book: zipfile.ZipFile, path: str) -> Iterator[pa.RecordBatch]:
        parts = sheets_of(book, path)
        if self.sheet not in parts:
            raise BrokenWorkbook(f"{path}: no sheet {self.sheet!r} among {sorted(parts)}")
        # Shared texts stand behind the sheets in no order, so the numbers in use are found first.
        used: set[int] = set()
        for _, cells in rows_of(book, parts[self.sheet], self.places, self.skip):
            used.update(c for c in cells if isinstance(c, int))
        texts = shared_texts(book, used)
        if used and max(used) not in texts:
            raise BrokenWorkbook(f"{path}, sheet {self.sheet}: a shared text is missing")
        held: list[list] = []
        for _, cells in rows_of(book, parts[self.sheet], self.places, self.skip):
            held.append([texts[c] if isinstance(c, int) else c for c in cells])
            if len(held) == BATCH_ROWS:
                yield self._batch(held)
                held = []
        if held:
            yield self._batch(held)

    def _batch(self, rows: list[list]) -> pa.RecordBatch:
        columns = [pa.array([None if c in MISSING_TEXTS else c for c in column], pa.string()) for column in zip(*rows)]
        return pa.RecordBatch.from_arrays(columns, names=list(self.names))


class Workbook(DataSource):
    """``spark.read.format("workbook")`` with ``path``, ``sheet``, ``places`` (1-based columns), ``skip`` (header rows)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ", ".join(f"c{int(p)} string" for p in self.options["places"].split(","))

    def reader(self, schema: StructType) -> DataSourceReader:
        return SheetReader(schema, dict(self.options))


def read_sheet(spark: SparkSession, sheet: Sheet, fields: Sequence[tuple[int, str, str]], header: bool = True) -> DataFrame:
    """Chosen 1-based columns ``(position, name, type)`` of a sheet; a value that does not fit its type fails the job."""
    spark.dataSource.register(Workbook)
    places = sorted({p for p, _, _ in fields})
    reader = spark.read.format("workbook").option("sheet", sheet.name).option("skip", int(header))
    raw = reader.option("places", ",".join(map(str, places))).load(sheet.path)
    return pick_positions(raw, [(places.index(p) + 1, name, kind) for p, name, kind in fields])


# --- writing --------------------------------------------------------------------------------


def workbook_bytes(sheets: Mapping[str, Iterable[Sequence]]) -> bytes:
    """A workbook of sheets of rows: texts are shared, numbers stay numbers, None is blank.

    The sheets' rows are taken one by one, in the order of the sheets; what is
    held are the packed bytes and the different texts.
    """
    texts: dict[str, int] = {}
    letters: list[str] = []
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = [f"worksheets/sheet{i}.xml" for i in range(1, len(sheets) + 1)]
        for part, rows in zip(parts, sheets.values()):
            with book.open(f"xl/{part}", "w") as file:
                file.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{MAIN}"><sheetData>'.encode())
                lines = []
                for r, row in enumerate(rows, 1):
                    if r > MOST_ROWS:
                        raise ValueError(f"more than {MOST_ROWS} rows do not fit in a sheet")
                    letters += [column_letters(c) for c in range(len(letters) + 1, len(row) + 1)]
                    cells = []
                    for at, v in zip(letters, row):
                        if v is None:
                            continue
                        if isinstance(v, str):
                            cells.append(f'<c r="{at}{r}" t="s"><v>{texts.setdefault(v, len(texts))}</v></c>')
                        else:
                            cells.append(f'<c r="{at}{r}"><v>{v!r}</v></c>')
                    lines.append(f'<row r="{r}">{"".join(cells)}</row>')
                    if len(lines) == WRITTEN_ROWS:
                        file.write("".join(lines).encode())
                        lines = []
                file.write("".join([*lines, "</sheetData></worksheet>"]).encode())
        named = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr(BOOK, f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>{named}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{RELATIONS}/worksheet" Target="{p}"/>' for i, p in enumerate(parts, 1))
        links += f'<Relationship Id="rIdT" Type="{RELATIONS}/sharedStrings" Target="sharedStrings.xml"/>'
        book.writestr(LINKS, f'<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>')
        with book.open(TEXTS, "w") as file:
            file.write(f'<sst xmlns="{MAIN}">'.encode())
            left = iter(texts)
            while some := list(islice(left, WRITTEN_ROWS)):
                file.write("".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in some).encode())
            file.write(b"</sst>")
        first = f'<Relationship Id="rId1" Type="{RELATIONS}/officeDocument" Target="{BOOK}"/>'
        book.writestr("_rels/.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{first}</Relationships>')
        types = f'<Override PartName="/{BOOK}" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/{TEXTS}" ContentType="{kinds}.sharedStrings+xml"/>'
        types += "".join(f'<Override PartName="/xl/{p}" ContentType="{kinds}.worksheet+xml"/>' for p in parts)
        rels = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        book.writestr("[Content_Types].xml", f'<Types xmlns="{PACKAGE}/content-types">{rels}{types}</Types>')
    return out.getvalue()


def write_workbooks(tables: Mapping[str, DataFrame], path: str, rows_per_sheet: int = 100_000) -> None:
    """Tables of text and numbers as sheets of workbooks in the folder ``path``, a header row in each.

    Rows are dealt to as many workbooks as the largest table needs.  A task gets
    a workbook's rows in their order, from Spark's sort, and writes them as they come.
    """
    if not 0 < rows_per_sheet <= MOST_ROWS // 2:
        raise ValueError(f"sheets are filled up to {MOST_ROWS // 2} rows")
    names = list(tables)
    sizes = [t.count() for t in tables.values()]
    files = max(1, -(-max(sizes) // rows_per_sheet))
    heads = {n: t.columns for n, t in tables.items()}
    numeric = {n: [k not in ("string",) for _, k in t.dtypes] for n, t in tables.items()}
    rows = None
    for i, (name, t) in enumerate(tables.items()):
        cells = F.array(*[F.col(f"`{c}`").cast("string") for c in t.columns])
        one = t.select(F.lit(i).alias("sheet"), F.monotonically_increasing_id().alias("place"), cells.alias("cells"))
        rows = one if rows is None else rows.unionByName(one)
    # Every workbook has every sheet, also where it gets no row of it.
    blank = rows.sparkSession.range(files).selectExpr("-1 AS sheet", "id AS place", "CAST(NULL AS ARRAY<STRING>) AS cells")
    dealt = rows.unionByName(blank).withColumn("file", F.expr(f"IF(sheet < 0, place, pmod(xxhash64(sheet, place), {files}))"))

    def sheets_of_rows(rows: Iterator[tuple]) -> dict[str, Iterator[Sequence]]:
        held = next(rows, None)

        def one(i: int, name: str) -> Iterator[Sequence]:
            nonlocal held
            yield heads[name]
            while held is not None and held[1] <= i:
                if held[1] == i:
                    yield [Number(c) if k and c is not None else c for c, k in zip(held[2], numeric[name])]
                held = next(rows, None)

        return {n: one(i, n) for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("file", "sheet", "cells"))))
        for file, own in groupby(rows, key=itemgetter(0)):
            written(f"{path}/part-{file:05d}.xlsx", workbook_bytes(sheets_of_rows(own)))
            yield pa.RecordBatch.from_pydict({"n": pa.array([file], pa.int64())})

    in_order = dealt.withColumn("file", F.col("file").cast("int")).repartitionById(files, F.col("file"))
    in_order.sortWithinPartitions("file", "sheet", "place").mapInArrow(run, "n long").agg({"n": "sum"}).collect()


class Number:
    """A number's text, as the engine prints it."""

    def __init__(self, text: str):
        self.text = text

    def __repr__(self) -> str:
        return self.text
