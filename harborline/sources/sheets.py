"""Readers of workbooks (xlsx) and of tables in HTML, as rows of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, place, row, cells): the rows of every sheet of xlsx files, cells as texts, null where blank.

    place is the sheet's position in the book, row its number in the sheet. A task holds one file, as its archive cannot be split;
    files spread over tasks. A file that is no workbook raises.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io
        import re
        import zipfile
        from xml.etree import ElementTree

        import pandas as pd

        tag = lambda e: e.tag.rpartition("}")[2]
        text = lambda e: "".join(t.text or "" for t in e.iter() if tag(t) == "t")

        def column(ref):
            n = 0
            for c in re.match("[A-Z]+", ref)[0]:
                n = n * 26 + ord(c) - 64
            return n - 1

        for pdf in batches:
            out = []
            for name, content in zip(pdf.path, pdf.content, strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = set(z.namelist())
                    shared = [text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
                    links = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
                    sheets = [e for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if tag(e) == "sheet"]
                    for place, sheet in enumerate(sheets):
                        target = links[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))]
                        file = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
                        for at, row in enumerate((e for e in ElementTree.fromstring(z.read(file)).iter() if tag(e) == "row"), 1):
                            cells: list = []
                            for c in row:
                                k = column(c.get("r")) if c.get("r") else len(cells)
                                cells += [None] * (k + 1 - len(cells))
                                value = next((e.text for e in c if tag(e) == "v"), None)
                                kind = c.get("t")
                                cells[k] = (shared[int(value)] if kind == "s" and value is not None else text(c) if kind == "inlineStr" else value) or None
                            out.append((name, sheet.get("name"), place, int(row.get("r") or at), cells))
            yield pd.DataFrame(out, columns=["path", "sheet", "place", "row", "cells"])

    return files.mapInPandas(run, "path string, sheet string, place int, row int, cells array<string>")


def with_header(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(path, sheet, place, row, columns.values()...): rows below each sheet's header, which is its first row that has a key column.

    columns: regular expression of a header cell -> name. The first entry is the key; sheets without it give no rows. Of several
    cells that fit, the first counts; a column no cell fits is null.
    """
    keys = list(columns)
    fits = lambda p: F.array_position(F.transform("cells", lambda c: F.coalesce(c.rlike(p), F.lit(False))), True).cast("int")
    head = rows.where(fits(keys[0]) > 0).groupBy("path", "sheet").agg(F.min_by(F.struct("row", *[fits(p).alias(f"c{i}") for i, p in enumerate(keys)]), "row").alias("h"))
    below = rows.join(head, ["path", "sheet"]).where(F.col("row") > F.col("h.row"))
    cell = lambda i: F.when(F.col(f"h.c{i}") > 0, F.try_element_at("cells", F.col(f"h.c{i}")))
    return below.select("path", "sheet", "place", "row", *[F.trim(cell(i)).alias(columns[p]) for i, p in enumerate(keys)])


def latest_sheet(rows: DataFrame, key: str, priority: Column) -> DataFrame:
    """One row of each key: from the sheet of highest priority, there the first row; rows without a key are left out."""
    w = Window.partitionBy(key).orderBy(F.desc("_priority"), "path", "place", "row")
    return rows.where(F.col(key).isNotNull()).withColumn("_priority", priority).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_priority")


def html_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """The frame's columns without `html`, and (row, head, cells) of every table row in it, by functions of Spark alone.

    Cells are texts without markup, entities of blanks, brackets and ampersands decoded, white space as one blank; head is
    true for rows of header cells only. Pages without a row, or null, give none.
    """
    inside = lambda text, tag: F.regexp_extract_all(text, F.lit(rf"(?is)<(?:{tag})\b[^>]*>(.*?)</(?:{tag})\s*>"), F.lit(1))

    def clean(cell):
        plain = F.regexp_replace(cell, r"(?s)<[^>]*>", " ")
        for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            plain = F.replace(plain, F.lit(entity), F.lit(char))
        return F.trim(F.regexp_replace(plain, r"[\s ]+", " "))

    own = [c for c in pages.columns if c != html]
    rows = pages.select(*own, F.posexplode(inside(F.col(html), "tr")).alias("row", "_tr"))
    head = ~F.col("_tr").rlike(r"(?i)<td\b")
    return rows.select(*own, "row", head.alias("head"), F.transform(inside(F.col("_tr"), "td|th"), clean).alias("cells"))


def _grids(text: str) -> list[list[tuple]]:
    """The tables of a page in order of their begin, each as (row, column, text, head, ids): a spanning cell stands in all its places."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.tables, self.open, self.skip = [], [], 0

        def end_cell(self):
            t = self.open[-1]
            if t["cell"] is not None:
                words, down, across, head, ids = t["cell"]
                t["rows"][-1].append((" ".join("".join(words).replace("\xa0", " ").split()), down, across, head, ids))
                t["cell"] = None

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            if tag == "table":
                self.open.append({"rows": [], "cell": None})
                self.tables.append(self.open[-1]["rows"])
            elif tag in ("script", "style"):
                self.skip += 1
            elif self.open:
                t = self.open[-1]
                if tag in ("tr", "td", "th"):
                    self.end_cell()
                if tag == "tr" or tag in ("td", "th") and not t["rows"]:
                    t["rows"].append([])
                if tag in ("td", "th"):
                    number = lambda k, most: min(most, int(a[k])) if (a.get(k) or "").isdigit() else 1
                    t["cell"] = ([], number("rowspan", 65_534), max(1, number("colspan", 1_000)), tag == "th", [])
                elif t["cell"] is not None and tag in ("br", "p", "div"):
                    t["cell"][0].append(" ")
                if t["cell"] is not None and a.get("id"):
                    t["cell"][4].append(a["id"])

        def handle_endtag(self, tag):
            if tag in ("script", "style"):
                self.skip = max(0, self.skip - 1)
            elif self.open and tag in ("td", "th", "tr"):
                self.end_cell()
            elif self.open and tag == "table":
                self.end_cell()
                self.open.pop()

        def handle_data(self, data):
            if self.open and self.open[-1]["cell"] is not None and not self.skip:
                self.open[-1]["cell"][0].append(data)

    reader = Reader()
    reader.feed(text)
    reader.close()
    while reader.open:
        reader.end_cell()
        reader.open.pop()
    out = []
    for rows in reader.tables:
        taken, grid = set(), []
        for r, cells in enumerate(rows):
            c = 0
            for words, down, across, head, ids in cells:
                while (r, c) in taken:
                    c += 1
                for y in range(r, min(len(rows), r + down) if down else len(rows)):  # 0: down to the end
                    for x in range(c, c + across):
                        if (y, x) not in taken:
                            taken.add((y, x))
                            grid.append((y, x, words, head, ids))
                c += across
        out.append(sorted(grid, key=lambda g: g[:2]))
    return out


def html_grid(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, table, row, col, text, head, ids) of every place of every table of a page, spans filled, nested tables apart.

    text: the cell's own words, white space as one blank; ids: of the cell and the elements in it. Null pages give none.
    """

    def run(frames):
        import pandas as pd

        for pdf in frames:
            rows = [(k, t, *cell) for k, text in zip(pdf[key], pdf[html], strict=True) if text for t, grid in enumerate(_grids(text)) for cell in grid]
            yield pd.DataFrame(rows, columns=[key, "table", "row", "col", "text", "head", "ids"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, `table` int, `row` int, col int, text string, head boolean, ids array<string>")


# fixed forms of the script that fills rate cells: where a cell's block begins, its kinds of rates, its values
SCRIPT_CELL, SCRIPT_KIND, SCRIPT_VALUE = r'showID = "#(\w+_)" \+ "', r'<span title="([^"]+)"><a href="#"><span class="textColor">(\w+)</span>', r"<span><a href=.{0,2}#.{0,2}>([^<]*)</a>"


def script_cells(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, cell, place, name, kind, value) of what a page's script puts into its empty cells, by functions of Spark alone.

    cell: the id of the element that is filled. Kinds and values of a cell are matched by their order, as far as both go.
    """
    blocks = pages.select(key, F.explode(F.regexp_extract_all(html, F.lit(r"(?s)(" + SCRIPT_CELL + r".*?)(?=showID = |</script>|\z)"), F.lit(1))).alias("b"))
    of = lambda pattern, i: F.regexp_extract_all("b", F.lit(pattern), F.lit(i))
    cell = F.concat(F.regexp_extract("b", SCRIPT_CELL, 1), F.regexp_extract("b", SCRIPT_CELL + r'(\w+)"', 2))
    found = blocks.select(key, cell.alias("cell"), F.posexplode(F.arrays_zip(of(SCRIPT_KIND, 1).alias("name"), of(SCRIPT_KIND, 2).alias("kind"), of(SCRIPT_VALUE, 1).alias("value"))).alias("place", "x"))
    return found.where("x.kind is not null and x.value is not null").select(key, "cell", "place", "x.name", "x.kind", F.trim("x.value").alias("value"))
