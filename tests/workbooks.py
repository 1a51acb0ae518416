"""Writes minimal .xlsx files for the tests."""

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _cell(column, row, value, shared):
    at = f"{chr(65 + column)}{row}"
    if value is None:
        return ""
    if isinstance(value, (int, float)):
        return f'<c r="{at}"><v>{value}</v></c>'
    if row % 2:
        shared.append(value)
        return f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
    return f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'


def write_workbook(path, sheets):
    shared = []
    with zipfile.ZipFile(path, "w") as book:
        entries, links = "", ""
        for i, (name, table) in enumerate(sheets.items(), 1):
            body = "".join(
                f'<row r="{r}">'
                + "".join(_cell(c, r, v, shared) for c, v in enumerate(line))
                + "</row>"
                for r, line in enumerate(table, 1)
            )
            book.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>',
            )
            entries += f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>'
            links += f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>'
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{entries}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}">{links}</Relationships>',
        )
        strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
