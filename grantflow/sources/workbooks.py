"""Workbooks: a distributed table of text cells, one task per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantflow import schemas


def _cells_function():
    """Cell reading function, sent to executors by value: they need not have this package."""
    def run(batches):
        import datetime
        import io
        import posixpath
        import re
        import zipfile
        from xml.etree import ElementTree as ET

        import pandas as pd

        columns = ["file", "row_idx", "cells", "link", "error"]
        rid = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

        def local(element):
            return element.tag.rsplit("}", 1)[-1]

        def named(root, name):
            return [e for e in root.iter() if local(e) == name]

        def text_of(element):
            return "".join(t.text or "" for t in named(element, "t"))

        def relations(book, part):
            folder, name = posixpath.split(part)
            rels = f"{folder}/_rels/{name}.rels"
            if rels not in book.namelist():
                return {}
            return {
                r.get("Id"): r.get("Target") for r in named(ET.fromstring(book.read(rels)), "Relationship")
            }

        def sheet_part(book):
            targets = relations(book, "xl/workbook.xml")
            for sheet in named(ET.fromstring(book.read("xl/workbook.xml")), "sheet"):
                if sheet.get("name") == "Sheet1":
                    target = targets[sheet.get(rid)]
                    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            raise KeyError("Sheet1")

        def shared(book):
            if "xl/sharedStrings.xml" not in book.namelist():
                return []
            return [text_of(si) for si in named(ET.fromstring(book.read("xl/sharedStrings.xml")), "si")]

        def date_styles(book):
            """Style index -> layout, for styles that show a number as a day."""
            if "xl/styles.xml" not in book.namelist():
                return {}
            root = ET.fromstring(book.read("xl/styles.xml"))
            custom = {n.get("numFmtId"): n.get("formatCode") or "" for n in named(root, "numFmt")}
            # Built-in day formats
            custom.update({"14": "mm-dd-yy", "15": "d-mmm-yy"})
            found = {}
            for block in named(root, "cellXfs"):
                for i, xf in enumerate(named(block, "xf")):
                    code = custom.get(xf.get("numFmtId"), "").split(";")[0].lower()
                    code = re.sub(r'\[[^\]]*\]|\\|"[^"]*"', "", code)
                    if "d" in code and "y" in code:
                        found[str(i)] = code
            return found

        def shown_day(number, code):
            day = datetime.date(1899, 12, 30) + datetime.timedelta(days=int(float(number)))
            # What each letter run of a day format prints
            printed = {
                "yyyy": f"{day.year:04d}", "yy": f"{day.year % 100:02d}", "y": f"{day.year % 100:02d}",
                "mmmm": day.strftime("%B"), "mmm": day.strftime("%b"),
                "mm": f"{day.month:02d}", "m": str(day.month), "dd": f"{day.day:02d}", "d": str(day.day),
            }
            return re.sub(r"y+|m+|d+", lambda m: printed.get(m.group(), m.group()), code)

        def value_of(cell, strings, dates):
            kind = cell.get("t")
            if kind == "inlineStr":
                return text_of(cell)
            raw = next((v.text or "" for v in cell if local(v) == "v"), "")
            if kind == "s":
                return strings[int(raw)]
            if kind == "b":
                return "TRUE" if raw == "1" else "FALSE"
            if kind is None and raw and cell.get("s") in dates:
                return shown_day(raw, dates[cell.get("s")])
            if kind in (None, "n") and re.fullmatch(r"-?\d+(\.0+)?([eE]\+?\d+)?", raw):
                return str(int(float(raw))) if not raw.lstrip("-").isdigit() else raw
            return raw

        def column_index(ref):
            n = 0
            for ch in re.match(r"[A-Z]+", ref).group():
                n = n * 26 + ord(ch) - 64
            return n - 1

        def links_of(book, part):
            """Row number -> target of the link on column F."""
            targets, found = relations(book, part), {}
            with book.open(part) as stream:
                for _, element in ET.iterparse(stream):
                    if local(element) == "hyperlink" and re.match(r"F\d", element.get("ref", "")):
                        first, _, last = element.get("ref").partition(":")
                        ends = [int(re.search(r"\d+", r).group()) for r in (first, last or first)]
                        for row in range(ends[0], ends[1] + 1):
                            found[row] = targets.get(element.get(rid))
                    elif local(element) == "row":
                        element.clear()
            return found

        def rows_of(book):
            part = sheet_part(book)
            strings, dates, links = shared(book), date_styles(book), links_of(book, part)
            number = 0
            with book.open(part) as stream:
                for _, element in ET.iterparse(stream):
                    if local(element) != "row":
                        continue
                    number = int(element.get("r") or number + 1)
                    cells = []
                    for cell in element:
                        at = column_index(cell.get("r")) if cell.get("r") else len(cells)
                        cells.extend([""] * (at - len(cells)))
                        cells.append(value_of(cell, strings, dates))
                    while cells and cells[-1] == "":
                        cells.pop()
                    yield number - 1, cells, links.get(number)
                    element.clear()

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as book:
                        # a first pass to the end: a file that breaks anywhere gives its error alone
                        for _ in rows_of(book):
                            pass
                        for row_idx, cells, link in rows_of(book):
                            rows.append((path, row_idx, cells, link, None))
                            if len(rows) == 5000:
                                yield pd.DataFrame(rows, columns=columns)
                                rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)
                except Exception as problem:  # one bad workbook is one error row
                    row = (path, None, None, None, f"{type(problem).__name__}: {problem}")
                    yield pd.DataFrame([row], columns=columns)

    return run


def read_sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_idx, cells, link, error) of the sheet named ``Sheet1`` of every workbook."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_cells_function(), schemas.CELLS)
