"""Excel workbooks as a Spark data source, by the standard library alone.

``spark.dataSource.register(WorkbookSource)``, then ``format("workbook")``.
A table is a folder of ``.xlsx`` files, one a partition, or a single file.
Reading gives every cell as a string under the names of the first row, or casts
to a schema that is given: strings, booleans, numbers, decimals, dates and
timestamps, and refuses others.  Whole numbers and decimals are read exactly as
they are written.  Dates and times are serial numbers with a date format, as
spreadsheets keep them, without a zone; a timestamp with one is kept in UTC.
Options: ``path``, and ``sheet`` (the first if unset).
"""

from __future__ import annotations

import io
import re
import sys
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal
from typing import IO
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType

# Workers get these classes by value and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
#: Rows that one sheet can hold.
MOST_ROWS = 1_048_576
CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")
#: What can be read and written.
WHOLE = (ByteType, ShortType, IntegerType, LongType)
TYPES = (StringType, BooleanType, *WHOLE, FloatType, DoubleType, DecimalType, DateType, TimestampType, TimestampNTZType)
#: The day of serial number 0, and of 0 in books that count from 1904.
DAY_0, DAY_0_OF_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
# The format's numbers of cell styles here, for dates and for times, and its built-in number formats.
DATE_STYLE, TIME_STYLE = 1, 2
DATE_FORMAT, TIME_FORMAT = 14, 22


def column_name(i: int) -> str:
    name = ""
    while i >= 0:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
    return name


def column_index(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def cell(value: object, at: str) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime):
        plain = value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value
        return f'<c r="{at}" s="{TIME_STYLE}"><v>{(plain - DAY_0) / timedelta(days=1)!r}</v></c>'
    if isinstance(value, date):
        return f'<c r="{at}" s="{DATE_STYLE}"><v>{(value - DAY_0.date()).days}</v></c>'
    if isinstance(value, Decimal) and value.is_finite():
        return f'<c r="{at}"><v>{value:f}</v></c>'
    if isinstance(value, int | float) and value == value and abs(value) != float("inf"):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(CONTROL.sub("", str(value)))}</t></is></c>'


def to_workbook(names: list[str], rows: Iterator[tuple], sheet: str = "Sheet1") -> bytes:
    """A workbook of one sheet, with the names in its first row."""
    lines = []
    for r, values in enumerate([tuple(names), *rows], 1):
        if r > MOST_ROWS:
            raise ValueError(f"a sheet holds {MOST_ROWS} rows")
        lines.append(f'<row r="{r}">' + "".join(cell(v, f"{column_name(c)}{r}") for c, v in enumerate(values)) + "</row>")
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{RELATION}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{RELATION}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{RELATION}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{RELATION}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        f'<cellXfs count="3"><xf/><xf numFmtId="{DATE_FORMAT}" applyNumberFormat="1"/><xf numFmtId="{TIME_FORMAT}" applyNumberFormat="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, head + text)
    return out.getvalue()


def counts_from_1904(book: zipfile.ZipFile) -> bool:
    """Whether a workbook's serial numbers of days begin in 1904."""
    settings = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{{{MAIN}}}workbookPr")
    return settings is not None and settings.get("date1904") in ("1", "true")


def elements(part: IO[bytes], name: str) -> Iterator[ElementTree.Element]:
    """The elements of a name in a part, one at a time: each is forgotten when the next is asked for."""
    tag, path = f"{{{MAIN}}}{name}", []
    for event, element in ElementTree.iterparse(part, ("start", "end")):
        if event == "start":
            path.append(element)
            continue
        path.pop()
        if element.tag == tag:
            yield element
            if path:
                path[-1].remove(element)


def sheet_part(book: zipfile.ZipFile, sheet: str | None) -> str:
    """The part of a workbook that holds a sheet, by default the first."""
    found = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{{{MAIN}}}sheet")
    sheets = {s.get("name"): s.get(f"{{{RELATION}}}id") for s in found}
    if sheet is not None and sheet not in sheets:
        raise ValueError(f"no sheet named {sheet}")
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = links[sheets[sheet] if sheet is not None else next(iter(sheets.values()))]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    """The strings that cells name by number."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as part:
        return ["".join(t.text or "" for t in s.iter(f"{{{MAIN}}}t")) for s in elements(part, "si")]


def sheet_rows(book: zipfile.ZipFile, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The cells of a sheet, row by row, as strings; empty cells are null.

    The sheet is read as a stream: what is held is a row, and the workbook's
    shared strings.
    """
    tag = f"{{{MAIN}}}"
    shared = shared_strings(book)
    with book.open(sheet_part(book, sheet)) as part:
        for row in elements(part, "row"):
            values: list[str | None] = []
            for c in row.iter(f"{tag}c"):
                at = column_index(c.get("r") or "") if c.get("r") else len(values)
                values += [None] * (at + 1 - len(values))
                kind, v = c.get("t"), c.find(f"{tag}v")
                if kind == "inlineStr":
                    values[at] = "".join(t.text or "" for t in c.iter(f"{tag}t"))
                elif v is not None and v.text is not None:
                    values[at] = shared[int(v.text)] if kind == "s" else ("true" if v.text == "1" else "false") if kind == "b" else v.text
            yield values


def from_workbook(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """All cells of a sheet of a workbook in memory."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        return list(sheet_rows(book, sheet))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _list(path: str) -> list[str]:
    files, inner = _open(path)
    info = files.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [inner]
    return sorted(i.path for i in files.get_file_info(fs.FileSelector(inner)) if i.path.endswith(".xlsx"))


@dataclass
class Workbook(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    stage: str
    place: str


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, options

    def partitions(self) -> list[Workbook]:
        return [Workbook(p) for p in _list(self.options["path"])]

    def read(self, partition: Workbook) -> Iterator[tuple]:
        files, _ = _open(self.options["path"])
        with files.open_input_file(partition.path) as source, zipfile.ZipFile(source) as book:
            first_day = DAY_0_OF_1904 if counts_from_1904(book) else DAY_0
            rows = sheet_rows(book, self.options.get("sheet"))
            names = next(rows, [])
            at = [names.index(f.name) if f.name in names else None for f in self.schema.fields]
            for row in rows:
                yield tuple(
                    cast(row[i] if i is not None and i < len(row) else None, f, first_day)
                    for i, f in zip(at, self.schema.fields, strict=True)
                )


def moment(value: str, first_day: datetime) -> datetime:
    """A cell's time: a serial number of days, or as ISO 8601 text; to the microsecond."""
    try:
        days = Decimal(value)
    except ArithmeticError:
        found = datetime.fromisoformat(value)
        return found.astimezone(UTC).replace(tzinfo=None) if found.tzinfo else found
    return first_day + timedelta(microseconds=round(days * 86_400_000_000))


def cast(value: str | None, field: StructField, first_day: datetime = DAY_0) -> object:
    """A cell's text as a field's type.  Empty text is null for all but strings; a fraction is no whole number."""
    kind = field.dataType
    if value is None or isinstance(kind, StringType):
        return value
    if not value.strip():
        return None
    if isinstance(kind, WHOLE):
        number = Decimal(value)
        if number != int(number):
            raise ValueError(f"{value} in {field.name} is no whole number")
        return int(number)
    if isinstance(kind, DecimalType):
        return round(Decimal(value), kind.scale)
    if isinstance(kind, DoubleType | FloatType):
        return float(value)
    if isinstance(kind, BooleanType):
        return value.strip().lower() in ("true", "1")
    found = moment(value.strip(), first_day)
    if isinstance(kind, DateType):
        return found.date()
    return found.replace(tzinfo=UTC) if isinstance(kind, TimestampType) else found


def refuse_others(schema: StructType) -> None:
    for f in schema.fields:
        if not isinstance(f.dataType, TYPES):
            raise TypeError(f"a workbook can't hold {f.name}: {f.dataType.simpleString()}")


class WorkbookWriter(DataSourceWriter):
    """Each task writes a workbook to the job's hidden folder; the commit puts them all in place, and the folder goes."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.schema, self.names, self.options, self.overwrite = schema, schema.names, options, overwrite
        self.staged = f".stage-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        files, inner = _open(self.options["path"])
        stage, place = f"{inner}/{self.staged}/{uuid.uuid4().hex}", f"{inner}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:8]}.xlsx"
        zoned = [isinstance(f.dataType, TimestampType) for f in self.schema.fields]
        rows = (tuple(v.astimezone(UTC) if z and v is not None else v for v, z in zip(r, zoned, strict=True)) for r in iterator)
        data = to_workbook(list(self.names), rows, self.options.get("sheet") or "Sheet1")
        files.create_dir(f"{inner}/{self.staged}", recursive=True)
        with files.open_output_stream(stage) as out:
            out.write(data)
        return Written(stage, place)

    def commit(self, messages: list) -> None:
        files, _ = _open(self.options["path"])
        old = _list(self.options["path"]) if self.overwrite else []
        for m in filter(None, messages):
            files.move(m.stage, m.place)
        for path in old:
            files.delete_file(path)
        self.clear()

    def abort(self, messages: list) -> None:
        self.clear()

    def clear(self) -> None:
        """Delete what tasks have left, those that failed too."""
        files, inner = _open(self.options["path"])
        files.delete_dir_contents(f"{inner}/{self.staged}", missing_dir_ok=True)
        if files.get_file_info(f"{inner}/{self.staged}").type != fs.FileType.NotFound:
            files.delete_dir(f"{inner}/{self.staged}")


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        files, _ = _open(self.options["path"])
        found = _list(self.options["path"])
        names: list[str | None] = []
        if found:
            with files.open_input_file(found[0]) as source, zipfile.ZipFile(source) as book:
                names = next(sheet_rows(book, self.options.get("sheet")), [])
        return StructType([StructField(n, StringType()) for n in names if n])

    def reader(self, schema: StructType) -> WorkbookReader:
        refuse_others(schema)
        return WorkbookReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WorkbookWriter:
        refuse_others(schema)
        return WorkbookWriter(schema, dict(self.options), overwrite)
