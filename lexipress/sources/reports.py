"""Reports for people as a Spark sink: ``df.write.format("report")``, Markdown or a workbook of several sheets.

Every task writes its rows, already in the report's format, as parts of a staging folder
beside the report, named by its attempt.  The commit joins the parts of the attempts that
count, one after another, into one file and puts it in place; an aborted job leaves nothing.

Options: ``path`` (in a folder that all share and pyarrow can open), ``kind`` (``markdown`` or
``workbook``), ``sheet`` (a column that tells which sheet or section a row is in; without it
all are in one), ``title``.
"""

from __future__ import annotations

import json
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

from ..plans.lineage import opened

#: Fixed value: rows that a sheet of a workbook can have; more go on in another sheet.
SHEET_ROWS = 1_048_576
#: Characters that XML cannot hold.
_UNFIT = {c: None for c in range(32) if c not in (9, 10, 13)}


@dataclass
class Written(ds.WriterCommitMessage):
    """The parts of one task: of each sheet the file and its rows."""

    partition: int = 0
    parts: dict[str, tuple[str, int]] = field(default_factory=dict)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReportSink)


class ReportSink(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "report"

    def writer(self, schema, overwrite: bool) -> ds.DataSourceWriter:
        kind = {"markdown": Markdown, "workbook": Workbook}[self.options.get("kind", "markdown")]
        return kind(schema, dict(self.options), overwrite)


class _Writer(ds.DataSourceWriter):
    def __init__(self, schema, options: dict, overwrite: bool):
        self.by = options.get("sheet")
        self.names = [n for n in schema.fieldNames() if n != self.by]
        self.path, self.title, self.overwrite = options["path"], options.get("title", "Report"), overwrite
        self.staging = f"{self.path}.parts-{uuid.uuid4().hex[:12]}"
        # Made once, where the write is planned: a task that comes after an abort finds no folder and writes nothing.
        files, folder = opened(self.staging)
        files.create_dir(folder, recursive=True)

    def line(self, values: list) -> str:
        raise NotImplementedError

    def join(self, files: fs.FileSystem, sheets: dict[str, list[tuple[str, int]]], out) -> None:
        raise NotImplementedError

    def write(self, iterator: Iterator) -> Written:
        files, folder = opened(self.staging)
        context = TaskContext.get()
        done, streams = Written(context.partitionId() if context else 0), {}
        try:
            for row in iterator:
                values = row.asDict()
                sheet = str(values[self.by]) if self.by else self.title
                if sheet not in streams:
                    name = f"{folder}/{done.partition:06d}-{uuid.uuid4().hex[:12]}"
                    streams[sheet], done.parts[sheet] = files.open_output_stream(name), (name, 0)
                name, n = done.parts[sheet]
                streams[sheet].write((self.line([values[c] for c in self.names]) + "\n").encode())
                done.parts[sheet] = (name, n + 1)
        finally:
            for s in streams.values():
                s.close()
        return done

    def commit(self, messages) -> None:
        files, path = opened(self.path)
        if not self.overwrite and files.get_file_info(path).type != fs.FileType.NotFound:
            self.abort(messages)
            raise FileExistsError(path)
        sheets: dict[str, list[tuple[str, int]]] = {}
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            for sheet, part in m.parts.items():
                sheets.setdefault(sheet, []).append(part)
        made = f"{path}.new-{uuid.uuid4().hex[:12]}"
        with files.open_output_stream(made) as out:
            self.join(files, dict(sorted(sheets.items())) or {self.title: []}, out)
        files.move(made, path)
        self.abort(messages)

    def abort(self, messages) -> None:
        """Nothing stays of any attempt, whether it counted or not."""
        files, folder = opened(self.staging)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class Markdown(_Writer):
    """A section with a table for each sheet."""

    def line(self, values: list) -> str:
        cells = ["" if v is None else str(v).replace("\\", "\\\\").replace("|", "\\|").replace("\r", "").replace("\n", "<br>") for v in values]
        return f"| {' | '.join(cells)} |"

    def join(self, files, sheets, out) -> None:
        out.write(f"# {self.title}\n".encode())
        for sheet, parts in sheets.items():
            out.write(f"\n## {sheet}\n\n{self.line(self.names)}\n|{'-|' * len(self.names)}\n".encode())
            for name, _ in parts:
                with files.open_input_stream(name) as part:
                    shutil.copyfileobj(part, out)


class Workbook(_Writer):
    """A sheet for each, numbers as numbers, all else as texts."""

    def line(self, values: list) -> str:
        cells = []
        for v in values:
            if isinstance(v, int | float) and not isinstance(v, bool) and v == v and abs(v) < 1e15:
                cells.append(f"<c><v>{v!r}</v></c>")
            elif v is None:
                cells.append("<c/>")
            else:
                text = json.dumps(v, ensure_ascii=False, default=str) if isinstance(v, list | dict) else str(v)
                # A line of the part is a row, so line ends are written as references.
                cells.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text.translate(_UNFIT), {chr(10): "&#10;", chr(13): "&#13;"})}</t></is></c>')
        return f"<row>{''.join(cells)}</row>"

    def join(self, files, sheets, out) -> None:
        names: list[str] = []
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
            for sheet, parts in sheets.items():
                rows = (line for name, _ in parts for line in _lines(files, name))
                following, at = next(rows, None), 0
                while following is not None or not at:
                    at += 1
                    names.append(_sheet_name(sheet if at == 1 else f"{sheet} {at}", names))
                    with book.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as page:
                        page.write(f'<worksheet xmlns="{_MAIN}"><sheetData>\n{self.line(self.names)}\n'.encode())
                        for _ in range(SHEET_ROWS - 1):
                            if following is None:
                                break
                            page.write(following)
                            following = next(rows, None)
                        page.write(b"</sheetData></worksheet>")
            numbers = range(1, len(names) + 1)
            sheets_ = "".join(f'<sheet name={quoteattr(n)} sheetId="{k}" r:id="r{k}"/>' for k, n in zip(numbers, names, strict=True))
            book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{sheets_}</sheets></workbook>')
            links = "".join(f'<Relationship Id="r{k}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in numbers)
            book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
            book.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_SHEETS}.worksheet+xml"/>' for k in numbers)
            book.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_SHEETS}.sheet.main+xml"/>{kinds}</Types>')


# Names that a workbook's parts go by.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_SHEETS = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _lines(files: fs.FileSystem, name: str) -> Iterator[bytes]:
    with files.open_input_stream(name) as part:
        rest = b""
        while block := part.read(1 << 20):
            *whole, rest = (rest + block).split(b"\n")
            yield from (line + b"\n" for line in whole)


def _sheet_name(name: str, taken: list[str]) -> str:
    """At most 31 characters, none of those that a sheet's name must not have, unlike all others."""
    plain = "".join("_" if c in "[]:*?/\\'" else c for c in name.translate(_UNFIT))[:31] or "Sheet"
    unlike, k = plain, 2
    while unlike.lower() in {t.lower() for t in taken}:
        unlike, k = f"{plain[: 31 - len(f' {k}')]} {k}", k + 1
    return unlike
