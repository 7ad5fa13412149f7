"""Spanning cells, script-filled cells and enclosing headings against plain walks."""

import random

from harborline.operators import core
from harborline.sources import sheets


def brute(rows):
    """Places of spanning cells by marking a matrix, cell after cell; rows of (text, down, across)."""
    grid = {}
    for r, cells in enumerate(rows):
        for text, down, across in cells:
            c = 0
            while (r, c) in grid:
                c += 1
            for y in range(r, len(rows) if down == 0 else min(len(rows), r + down)):
                for x in range(c, c + across):
                    grid.setdefault((y, x), text)
    return grid


def test_spans_by_brute_force(spark):
    r = random.Random(9)
    pages, want = [], {}
    for k in range(30):
        rows = [[(f"{k}.{i}.{j}", r.choice([1, 1, 2, 3, 0]), r.choice([1, 1, 2])) for j in range(r.randrange(1, 5))] for i in range(r.randrange(1, 7))]
        want[k] = brute(rows)
        pages.append((k, "<table>" + "".join("<TR>" + "".join(f"<td rowspan='{d}' colspan={a}><b>{t}</b>" for t, d, a in cells) for cells in rows) + "</table>"))
    got = {}
    for x in sheets.html_grid(spark.createDataFrame(pages, "id int, html string"), "id").collect():
        assert x.table == 0 and (x.row, x.col) not in got.setdefault(x.id, {})
        got[x.id][x.row, x.col] = x.text
    assert got == want


def test_nested_tables_scripts_and_odd_pages(spark):
    html = "<p>x<table><tr><th id=a>A &amp;\xa0B<td>one<table><tr><td>in</td></tr></table> two<script>no()</script></td></tr><tr><td colspan=2 rowspan=x><i id='b'></i>end"
    got = sheets.html_grid(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<td>stray</td>")], "id int, html string"), "id").collect()
    assert sorted((x.table, x.row, x.col, x.text, x["head"], tuple(x.ids)) for x in got) == [(0, 0, 0, "A & B", True, ("a",)), (0, 0, 1, "one two", False, ()), (0, 1, 0, "end", False, ("b",)), (0, 1, 1, "end", False, ("b",)), (1, 0, 0, "in", False, ())]


def test_cells_that_a_script_fills(spark):
    one = lambda n, kinds, values: f'showID = "#rate_" + "{n}"; ' + "".join(f"<span title=\"{a}\"><a href=\"#\"><span class=\"textColor\">{b}</span>" for a, b in kinds) + "".join(f"htm2 += '<span><a href=\"#\">{v}</a>" for v in values)
    page = "<script>function f() {" + one(7, [("base", "A"), ("pact", "C")], [" 8% ", "5%"]) + one(9, [("base", "A")], ["3%", "spare"]) + "}</script>"
    got = sheets.script_cells(spark.createDataFrame([(1, page), (2, None), (3, "none")], "id int, html string"), "id").collect()
    assert sorted(tuple(x) for x in got) == [(1, "rate_7", 0, "base", "A", "8%"), (1, "rate_7", 1, "pact", "C", "5%"), (1, "rate_9", 0, "base", "A", "3%")]


def test_headings_as_a_stack(spark):
    """Rows in any order of codes: a heading goes when a shorter or foreign row comes."""
    r = random.Random(3)
    rows = []
    for g in "ab":
        code = ""
        for i in range(300):  # mostly below the row before, at times elsewhere
            n = r.choice([2, 4, 4, 6, 8, 10, 10, 10])
            code = code[: max(0, n - 2)] if r.random() < 0.8 else ""
            code += "".join(r.choice("12") for _ in range(n - len(code)))
            rows.append((g, i, code, f"n{i}"))
    want, stack, last = {}, {}, None
    for g, i, code, name in rows:
        stack = {} if g != last else {k: v for k, v in stack.items() if k < len(code) and code.startswith(v[0])}
        stack[len(code)] = (code, name)
        want[g, i] = " ".join(stack[k][1] for k in sorted(stack))
        last = g
    got = core.enclosing(spark.createDataFrame(rows, "g string, i int, code string, name string"), ["g"], "i", "code", "name").collect()
    assert {(x.g, x.i): x.path for x in got} == want and any(x.count(" ") == 4 for x in want.values())
