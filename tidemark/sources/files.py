"""Spreadsheets and delimited files from any store that Spark reads: listing, matching, incremental extract, lineage columns."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Any
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.inference import infer_types
from tidemark.sources.spi import Batch, Capabilities, Connector, ConnectorError, DatasetSchema, Stream, register
from tidemark.sources.spi import Column as SchemaColumn


@dataclass(frozen=True)
class SourceFile:
    path: str
    etag: str
    size: int
    modified: datetime


def list_files(spark: SparkSession, location: str) -> list[SourceFile]:
    """Files under a location; no content is read. The etag is time of change and size, which every store has."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    stamp = F.concat_ws("-", F.unix_micros("modificationTime").cast("string"), F.col("length").cast("string"))
    got = rows.select("path", stamp.alias("etag"), "length", "modificationTime").collect()  # a row for each landing file
    return sorted((SourceFile(r["path"], r["etag"], r["length"], r["modificationTime"]) for r in got), key=lambda f: f.path)


def normalise(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def unique_names(names: list[str | None]) -> list[str]:
    """Normalised headers; repeats get _2, _3 and so on, blanks column_<position>."""
    out: list[str] = []
    for i, name in enumerate(names, 1):
        base = normalise(name or "") or f"column_{i}"
        made, n = base, 1
        while made in out:
            n += 1
            made = f"{base}_{n}"
        out.append(made)
    return out


@dataclass(frozen=True)
class CsvConfig:
    location: str
    pattern: str | None = None
    delimiter: str = ","
    quote: str = '"'
    encoding: str = "utf-8"
    header_row: int = 1
    null_values: tuple[str, ...] = ("",)


@dataclass(frozen=True)
class ExcelConfig:
    location: str
    pattern: str | None = None
    sheet: str | None = None
    header_row: int | None = None
    header_row_contains: str | None = None
    stop_at_first_cell: str | None = None
    ignore_columns: tuple[str, ...] = ()


Rows = list[tuple[int, list[str | None]]]


def _read_options(config: CsvConfig) -> dict[str, Any]:
    read = arrow_csv.ReadOptions(encoding=config.encoding, skip_rows=max(0, config.header_row - 1), autogenerate_column_names=True, block_size=1 << 24, use_threads=False)
    parse = arrow_csv.ParseOptions(delimiter=config.delimiter, quote_char=config.quote, newlines_in_values=True)
    return {"read_options": read, "parse_options": parse}


def read_csv(data: bytes, config: CsvConfig) -> pa.Table:
    """All cells as strings under normalised names. An unquoted null value is null, a quoted one never; blank lines are no records."""
    if config.header_row > 1 and config.header_row > len(data.splitlines()):
        raise ConnectorError(f"there is no header line {config.header_row}")
    if not data.strip():
        if config.header_row:
            raise ConnectorError(f"there is no header line {config.header_row}")
        return pa.table({})
    try:
        first = arrow_csv.open_csv(io.BytesIO(data), **_read_options(config)).schema.names
        cells = arrow_csv.ConvertOptions(column_types=dict.fromkeys(first, pa.string()), null_values=list(config.null_values), strings_can_be_null=True, quoted_strings_can_be_null=False)
        table = arrow_csv.read_csv(io.BytesIO(data), convert_options=cells, **_read_options(config))
    except (pa.ArrowInvalid, LookupError, UnicodeDecodeError) as error:
        wrong = re.search(r"Row #(\d+): Expected (\d+) columns, got (\d+)", str(error))
        raise ConnectorError(f"line {wrong[1]} has {wrong[3]} cells, the header {wrong[2]}" if wrong else f"not readable as {config.encoding} text: {error}") from error
    if not config.header_row:
        return table.rename_columns(unique_names([None] * table.num_columns))
    return table.slice(1).rename_columns(unique_names([c[0].as_py() for c in table.columns]))


def parse_csv(data: bytes, config: CsvConfig) -> tuple[list[str], Rows]:
    """(columns, numbered rows); a record's number counts records from the header line on."""
    table = read_csv(data, config)
    cells = zip(*(c.to_pylist() for c in table.columns), strict=True)
    return table.column_names, [(config.header_row + i, list(row)) for i, row in enumerate(cells, 1)]


# fixed values: names of the spreadsheet format
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = datetime(1899, 12, 30)


def sheets(data: bytes) -> list[tuple[str, str, str]]:
    """(name, visibility, part) of every sheet."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    found = []
    for s in book.iter(f"{_MAIN}sheet"):
        target = rels[s.get(f"{_REL}id")]
        found.append((s.get("name"), s.get("state", "visible"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return found


def _styles(z: zipfile.ZipFile) -> list[bool]:
    """For each cell style, whether it shows dates."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    formats = root.find(f"{_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in formats] if formats is not None else []
    return [i in _DATE_FORMATS or bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(i, "").lower()))) for i in ids]


def _cell(c: ElementTree.Element, shared: list[str], dates: list[bool]) -> str | None:
    """Text of a cell: integral numbers without a point, dates as ISO, blanks null; a formula without a cached value is null."""
    kind, value = c.get("t", "n"), c.find(f"{_MAIN}v")
    if kind == "inlineStr":
        text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
    elif value is None or value.text is None:
        return None
    elif kind == "s":
        text = shared[int(value.text)]
    elif kind == "b":
        text = "true" if value.text == "1" else "false"
    elif kind == "n":
        number, style = float(value.text), int(c.get("s", 0))
        if style < len(dates) and dates[style]:
            moment = _EPOCH + timedelta(seconds=round(number * 86400))
            text = moment.date().isoformat() if moment.time() == datetime.min.time() else moment.isoformat(sep=" ")
        else:
            text = str(int(number)) if number.is_integer() else repr(number)
    else:
        text = value.text
    return text.strip() or None


def _position(ref: str) -> int:
    at = 0
    for ch in re.match("[A-Z]+", ref)[0]:
        at = at * 26 + ord(ch) - 64
    return at - 1


def read_sheet(data: bytes, name: str | None) -> Rows:
    """Numbered rows of cells of a sheet; without a name, of the first visible one."""
    found = sheets(data)
    part = next((p for n, v, p in found if (n == name if name else v == "visible")), None)
    if part is None:
        raise ConnectorError(f"there is no sheet {name!r}; there are: {', '.join(n for n, _, _ in found)}")
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        dates, rows = _styles(z), []
        for i, row in enumerate(ElementTree.fromstring(z.read(part)).iter(f"{_MAIN}row"), 1):
            cells: list[str | None] = []
            for j, c in enumerate(row.iter(f"{_MAIN}c")):
                at = _position(c.get("r")) if c.get("r") else j
                cells += [None] * (at + 1 - len(cells))
                cells[at] = _cell(c, shared, dates)
            rows.append((int(row.get("r", i)), cells))
    return rows


def parse_excel(data: bytes, config: ExcelConfig) -> tuple[list[str], Rows]:
    """(columns, numbered rows): the header by row number, by a cell it contains, or the first row that isn't empty."""
    rows = read_sheet(data, config.sheet)
    wanted = (lambda n, cells: n == config.header_row) if config.header_row else (lambda n, cells: config.header_row_contains in cells) if config.header_row_contains else (lambda n, cells: any(cells))
    at = next((i for i, (n, cells) in enumerate(rows) if wanted(n, cells)), None)
    if at is None:
        raise ConnectorError("there is no header row")
    header = rows[at][1]
    width = max((len(c) for _, c in rows[at:]), default=0)
    header = header + [None] * (width - len(header))
    used = [j for j in range(width) if header[j] or any(len(c) > j and c[j] is not None for _, c in rows[at + 1 :])]
    names = unique_names([header[j] for j in used])
    kept = [(j, n) for j, n in zip(used, names, strict=True) if n not in {normalise(x) for x in config.ignore_columns} and header[j] is not None or (header[j] is None and n not in config.ignore_columns)]
    out: Rows = []
    for number, cells in rows[at + 1 :]:
        first = next((c for c in cells if c is not None), None)
        if config.stop_at_first_cell is not None and cells and cells[0] == config.stop_at_first_cell:
            break
        if first is not None:
            values = [cells[j] if j < len(cells) else None for j, _ in kept]
            if any(v is not None for v in values):
                out.append((number, values))
    return [n for _, n in kept], out


class FileConnector(Connector):
    capabilities = Capabilities(files=True)
    extensions: tuple[str, ...] = ()
    parse: Any = None

    def files(self) -> list[tuple[SourceFile, dict[str, str]]]:
        """Matching files with the named groups of the pattern, sorted by path."""
        out = []
        for f in list_files(self.spark, self.config.location):
            if self.config.pattern is not None:
                if m := re.search(self.config.pattern, f.path):
                    out.append((f, m.groupdict()))
            elif f.path.lower().endswith(self.extensions):
                out.append((f, {}))
        return out

    def newest(self) -> SourceFile:
        found = [f for f, _ in self.files()]
        if not found:
            raise ConnectorError(f"{self.config.location}: no file matches")
        return max(found, key=lambda f: (f.modified, f.path))

    def _rows(self, file: SourceFile) -> DataFrame:
        """Rows of a file, parsed on an executor; the names come first, from a pass that returns them alone."""
        config, parse = self.config, type(self).parse
        content = self.spark.read.format("binaryFile").load(file.path).select("content")

        def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for c in b.column("content"):
                    yield pa.RecordBatch.from_pydict({"name": parse(c.as_py(), config)[0]})

        columns = [r["name"] for r in content.mapInArrow(names, "name string").collect()]  # a row for each column

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for c in b.column("content"):
                    found = parse(c.as_py(), config)[1]
                    for low in range(0, len(found), 10_000):
                        some = found[low : low + 10_000]
                        arrays = [pa.array([r[0] for r in some], pa.int64())] + [pa.array([r[1][j] for r in some], pa.string()) for j in range(len(columns))]
                        yield pa.RecordBatch.from_arrays(arrays, names=["_row_number", *columns])

        return content.mapInArrow(rows, ", ".join(["`_row_number` bigint", *(f"`{n}` string" for n in columns)]))

    def extract(self, state: dict[str, Any] | None = None, full: bool = False) -> Iterator[Batch]:
        """A batch for each file whose path and etag the state doesn't have; the state grows with every batch."""
        seen = {tuple(x) for x in (state or {}).get("seen", [])}
        for file, found in self.files():
            if full or (file.path, file.etag) not in seen:
                lineage = {"_source_file": F.lit(file.path), "_file_etag": F.lit(file.etag)} | {f"_file_{k}": F.lit(v) for k, v in found.items()}
                seen.add((file.path, file.etag))
                yield Batch(self._rows(file).withColumns(lineage), {"seen": sorted(map(list, seen))}, file.path)

    def preview(self, n: int = 20) -> DataFrame:
        return self._rows(self.newest()).limit(n)

    def schema(self, rows: int = 10_000) -> DatasetSchema:
        """Columns of the newest file, with types that fit its first rows."""
        head = self._rows(self.newest()).drop("_row_number").limit(rows)
        kinds = infer_types(head)
        return DatasetSchema(tuple(SchemaColumn(n, kinds[n]) for n in head.columns))

    def size(self) -> dict[str, int]:
        """Files and bytes that a full extract reads."""
        found = [f for f, _ in self.files()]
        return {"files": len(found), "bytes": sum(f.size for f in found)}

    def metadata(self) -> dict[str, Any]:
        newest = self.newest()
        return {"type": self.type, "location": self.config.location, **self.size(), "newest": newest.path, "modified": newest.modified.isoformat()}

    def test(self) -> str:
        """What is wrong with the source, or an empty text."""
        try:
            self.preview(1).count()
        except Exception as error:  # whatever the store raises is the answer
            return f"{self.type}: {str(error).splitlines()[0]}"
        return ""


@register
class CsvConnector(FileConnector):
    type = "csv"
    config_class = CsvConfig
    extensions = (".csv", ".txt", ".tsv")
    parse = staticmethod(parse_csv)

    def streams(self) -> list[Stream]:
        return [Stream(self.config.location, self.config.location.rstrip("/").rpartition("/")[2], "files")]


@register
class ExcelConnector(FileConnector):
    type = "excel"
    config_class = ExcelConfig
    extensions = (".xlsx", ".xlsm")
    parse = staticmethod(parse_excel)

    def streams(self) -> list[Stream]:
        content = self.spark.read.format("binaryFile").load(self.newest().path).first()["content"]
        return [Stream(n, n, "sheet", v == "visible", {"visibility": v}) for n, v, _ in sheets(bytes(content))]


def write_xlsx(path: str, tables: dict[str, list[list[Any]]], hidden: tuple[str, ...] = ()) -> None:
    """A small workbook of inline strings and numbers, for samples and tests."""

    def cell(v: Any) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)):
            return f"<c><v>{v}</v></c>"
        escaped = str(v).replace("&", "&amp;").replace("<", "&lt;")
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escaped}</t></is></c>'

    rel = _REL.strip("{}")
    with zipfile.ZipFile(path, "w") as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" {"state=" + chr(34) + "hidden" + chr(34) if n in hidden else ""} r:id="r{i}"/>' for i, n in enumerate(tables, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN.strip("{}")}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i, _ in enumerate(tables, 1)) + "</Relationships>")
        for i, rows in enumerate(tables.values(), 1):
            body = "".join(f'<row r="{n}">{"".join(map(cell, row))}</row>' for n, row in enumerate(rows, 1) if any(v is not None for v in row))
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{_MAIN.strip("{}")}"><sheetData>{body}</sheetData></worksheet>')


def as_csv(rows: list[list[str]], delimiter: str = ",") -> bytes:
    out = io.StringIO()
    csv.writer(out, delimiter=delimiter).writerows(rows)
    return out.getvalue().encode()
