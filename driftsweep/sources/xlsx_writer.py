"""Minimal .xlsx writer (values only) used to build test inboxes from the driver tables.

Cells: str (shared strings), int/float (numbers), bool, datetime/date (numbers with a date
style), None (no cell). One call builds one workbook in memory.
"""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
       '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
       '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
       '{sheets}</Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
         '</Relationships>')
_STYLES = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           '<numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm:ss"/></numFmts>'
           '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
           '<cellStyleXfs count="1"><xf/></cellStyleXfs>'
           '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs>'
           '</styleSheet>')


def _col(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _serial(v) -> float:
    if isinstance(v, dt.datetime):
        d = v - dt.datetime(1899, 12, 30)
    else:
        d = dt.datetime(v.year, v.month, v.day) - dt.datetime(1899, 12, 30)
    return d.days + d.seconds / 86400


def _row_xml(r: int, row, strings: dict[str, int]) -> str:
    cells = []
    for c, v in enumerate(row):
        ref = f"{_col(c)}{r}"
        if v is None:
            continue
        if isinstance(v, bool):
            cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (dt.datetime, dt.date)):
            style = 2 if isinstance(v, dt.datetime) else 1
            cells.append(f'<c r="{ref}" s="{style}"><v>{_serial(v)!r}</v></c>')
        elif isinstance(v, (int, float)):
            cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
        else:
            k = strings.setdefault(str(v), len(strings))
            cells.append(f'<c r="{ref}" t="s"><v>{k}</v></c>')
    return f'<row r="{r}">{"".join(cells)}</row>'


def write_workbook(file, sheets: dict[str, Iterable]) -> None:
    """Write a workbook into an open file; each sheet's rows are taken one at a time, only the distinct texts are held."""
    strings: dict[str, int] = {}
    names = list(sheets)
    wb = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
          '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
          'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
          + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
          + "</sheets></workbook>")
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
                      f'relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
            + f'<Relationship Id="rId{len(names) + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
              'relationships/styles" Target="styles.xml"/>'
            + f'<Relationship Id="rId{len(names) + 2}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
              'relationships/sharedStrings" Target="sharedStrings.xml"/></Relationships>')
    ct_sheets = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/'
                        'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names)))
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT.format(sheets=ct_sheets))
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/styles.xml", _STYLES)
        for i, rows in enumerate(sheets.values()):
            with z.open(f"xl/worksheets/sheet{i + 1}.xml", "w", force_zip64=True) as part:
                part.write(b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                           b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                for r, row in enumerate(rows, 1):
                    part.write(_row_xml(r, row, strings).encode())
                part.write(b"</sheetData></worksheet>")
        with z.open("xl/sharedStrings.xml", "w", force_zip64=True) as part:
            part.write(('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                        f'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" count="{len(strings)}">').encode())
            for text in strings:
                part.write(f'<si><t xml:space="preserve">{escape(text)}</t></si>'.encode())
            part.write(b"</sst>")


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    buf = io.BytesIO()
    write_workbook(buf, sheets)
    return buf.getvalue()


EXCEL_MAX_DATA_ROWS = 1_048_575   # sheet row limit minus the header row


def write_fixture_workbooks(spark, sf_dir: str, inbox: str, layout=None) -> None:
    """Write a workbook fixture dataset (default ``upper_S1``) as ``upper.xlsx``.

    Rows are dealt to workbooks of at most Excel's row limit (the format's own bound), so
    none grows without limit; each workbook is written by one task, row by row in the order of ``src_row``, with Python file
    I/O, which needs the inbox on a POSIX-mounted shared folder (true for local runs and tests).
    """
    import pyarrow as pa
    from pyspark.sql import functions as F

    from driftsweep.sources import fixtures

    from driftsweep.session import ship_package

    ship_package(spark)
    lay = layout or next(l for l in fixtures.LAYOUTS if l.fmt == "xlsx")
    root = inbox.rstrip("/")
    root = root[len("file:"):] if root.startswith("file:") else root
    headers = [h for h, _ in lay.columns]
    stem = lay.source.rsplit(".xlsx", 1)[0]
    rows = (fixtures.fixture_rows(spark, sf_dir).where(F.col("file_name") == lay.file_name)
            .select(F.floor(F.col("src_row") / F.lit(4 * EXCEL_MAX_DATA_ROWS)).cast("int").alias("book"), "src_row",
                    *[F.col(c).alias(f"c{i}") for i, (_, c) in enumerate(lay.columns)]))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        from itertools import chain, groupby

        def values() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for i, c in enumerate(b.columns) if i != 1), strict=True)   # all but src_row

        for book, mine in groupby(values(), key=lambda row: row[0]):
            name = lay.source if book == 0 else f"{stem}_{book + 1}.xlsx"
            os.makedirs(root, exist_ok=True)
            with open(os.path.join(root, name), "wb") as f:
                write_workbook(f, {lay.sheet or "Sheet1": chain([headers], (row[1:] for row in mine))})
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["entry"])

    books = rows.repartition("book").sortWithinPartitions("book", "src_row")
    books.mapInArrow(write, "entry string").collect()  # one row per workbook
