"""Quote tables that aren't flat, against a small parser with a stack."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from barhouse.functions import html
from barhouse.sources.pages import parse_day_pages
from workload import landed

BAR = ["<span>2023.12.20</span>", "41,250", "+1,000", "40,900", "42,050", "40,100", "812,300"]


class Tree(HTMLParser):
    """Elements as [name, attributes, children]; a closing tag closes all up to its own opening one."""

    def __init__(self):
        super().__init__()
        self.root = ["", {}, []]
        self.stack = [self.root]

    def handle_starttag(self, name, attrs):
        element = [name, dict(attrs), []]
        self.stack[-1][2].append(element)
        if name not in html.VOID:
            self.stack.append(element)

    def handle_startendtag(self, name, attrs):
        self.stack[-1][2].append([name, dict(attrs), []])

    def handle_endtag(self, name):
        if name in [e[0] for e in self.stack[1:]]:
            while self.stack.pop()[0] != name:
                pass

    def handle_data(self, data):
        self.stack[-1][2].append(data)


def below(element, name):
    for child in element[2]:
        if not isinstance(child, str):
            if child[0] == name:
                yield child
            yield from below(child, name)


def text(element):
    return "".join(c if isinstance(c, str) else text(c) for c in element[2] if isinstance(c, str) or c[0] not in ("script", "style"))


def plain_rows(page):
    tree = Tree()
    tree.feed(page)
    tables = [t for t in below(tree.root, "table") if "type2" in (t[1].get("class") or "").split()]
    out = []
    for row in below(tables[0], "tr") if tables else []:
        cells = [c for c in row[2] if not isinstance(c, str) and c[0] == "td"]
        span = next(below(cells[0], "span"), None) if cells else None
        out.append((text(span).strip() if span else "", [text(c).strip() for c in cells]) if len(cells) >= 7 else None)
    return out


def rows_of(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = df.select("i", html.quote_rows(F.col("html")).alias("r")).orderBy("i").collect()
    return [[None if r is None else (r["span"], r["cells"]) for r in row["r"] or []] for row in got]


def row(cells, cell="<td>{}</td>", around="<tr>{}</tr>"):
    return around.format("".join(cell.format(c) for c in cells))


def page(*rows, before="", after="</table>", tag='<table class="type2">'):
    return f"<html>{before}{tag}{''.join(rows)}{after}<p>end</p></html>"


INNER = "<table><tr><td>x</td><td>y</td></tr></table>"
WIDE = "<table>" + row(["<span>2023.12.19</span>", *"234567"]) + "</table>"
PAGES = {
    "flat": page("<tr><th>day</th></tr>", row(BAR), row(BAR[:2])),
    "nested in the third cell": page(row([*BAR[:2], INNER, *BAR[3:]]), row(BAR)),
    "nested in the first cell": page(row([INNER + BAR[0], *BAR[1:]])),
    "nested with a bar of its own": page(row([*BAR[:2], WIDE, *BAR[3:]]), row(BAR)),
    "nested twice": page(row([*BAR[:2], f"<table><tr><td>{WIDE}</td></tr></table>", *BAR[3:]])),
    "quote table inside a cell of another": page(row(BAR), before="<table><tr><td>", after="</table></td></tr></table>"),
    "cells not closed": page(row(BAR, "<td>{}"), row(BAR)),
    "last cell not closed": page("<tr>" + "".join(f"<td>{c}</td>" for c in BAR[:6]) + f"<td>{BAR[6]}</tr>", row(BAR)),
    "rows not closed": page(row(BAR, around="<tr>{}"), row(BAR, around="<tr>{}")),
    "table not closed": page(row(BAR), row([*BAR[:2], INNER, *BAR[3:]]), after=""),
    "bold not closed in a cell": page(row([*BAR[:2], "<b>x", *BAR[3:]])),
    "bold around cells": page(row(BAR, around="<tr><b>{}</b></tr>")),
    "comment with cells": page(row([*BAR[:2], "<!-- <td>no</td> </tr> <table> -->z", *BAR[3:]]), row(BAR)),
    "comment around a table end": page("<!-- </table> -->", row(BAR)),
    "script with tags": page(row([*BAR[:2], "<script>var a = '<td></table>';</script>q", *BAR[3:]])),
    "body and head": page(f"<thead><tr><th>d</th></tr></thead><tbody>{row(BAR)}</tbody>"),
    "stray ends": page("</td></tr></span>", row(BAR), "</b>", row(BAR)),
    "void elements": page(row([*BAR[:2], "a<br>b<img src='x'>c<hr/>", *BAR[3:]]), f"<tr><img>{row(BAR, around='{}')}</tr>"),
    "self-closing cell": page("<tr><td/>" + row(BAR, around="{}") + "</tr>"),
    "header cells in a row": page("<tr><th>h</th>" + row(BAR, around="{}") + "</tr>", row(BAR)),
    "upper case": page(row(BAR)).upper().replace("TYPE2", "type2"),
    "no quote table": "<table class='other'>" + row(BAR) + "</table>",
    "span in a nested span": page(row(["<span>a<span>2023.12.20</span>b</span>", *BAR[1:]]), row([INNER, *BAR[1:]])),
    "empty": "",
}


def test_pages_one_by_one(spark):
    assert dict(zip(PAGES, rows_of(spark, PAGES.values()), strict=True)) == {name: plain_rows(p) for name, p in PAGES.items()}


@pytest.mark.parametrize("seed", range(3))
def test_invented_pages(spark, seed):
    rng = random.Random(seed)
    bits = ["<tr>", "</tr>", "<td>", "</td>", "<td class='n'>", "<table>", "</table>", "<b>", "</b>", "<span>", "</span>", "<th>", "</th>", "t", "u v", "<br>", "<!-- <td> -->", row(BAR), row(BAR), INNER]
    pages = [page(*rng.choices(bits, k=rng.randint(0, 25)), after=rng.choice(["</table>", ""])) for _ in range(150)]
    assert rows_of(spark, pages) == [plain_rows(p) for p in pages]


def test_flat_pages_are_known_as_such(spark):
    """The fold is for the others only."""
    flat = {"flat", "comment with cells", "comment around a table end", "body and head", "bold not closed in a cell", "script with tags", "upper case"}
    inside = {name: html.F.lit(p) for name, p in PAGES.items() if name in flat | {"cells not closed", "nested in the third cell"}}
    tail = lambda p: F.regexp_extract(F.regexp_replace(p, html._HIDDEN, ""), html._FROM_TABLE, 0)
    told = spark.range(1).select(*[html._is_flat(F.regexp_extract(tail(p), html._INSIDE, 1)).alias(n) for n, p in inside.items()]).first().asDict()
    assert {n for n, is_flat in told.items() if is_flat} == flat


def test_long_page(spark):
    """No recursion that grows with the page."""
    long = page(row([*BAR[:2], INNER, *BAR[3:]]), *[row(BAR) for _ in range(300)], row(["x" * 200_000, *BAR[1:]]))
    flat = page(*[row(BAR) for _ in range(20_000)], row(["y" * 500_000, *BAR[1:]]))
    got = rows_of(spark, [long, flat])
    assert [len(r) for r in got] == [303, 20_001] and got[0][:1] == plain_rows(long)[:1]


def test_a_bar_beside_a_nested_table_is_a_bar(spark):
    pages = spark.createDataFrame([("005930", "2023-12-20", 1, PAGES["nested in the third cell"])], "symbol string, date string, page int, html string")
    got = parse_day_pages(pages).select("close", "volume").collect()
    assert [tuple(r) for r in got] == [("41250", "812300")] * 2


def test_flat_tables_are_told_by_one_match(spark):
    told = spark.range(1).select(html._is_flat(F.lit("<tr><td>1</td></tr>")).alias("flat"))
    plan = told._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") == 1 and "regexp_replace" not in plan
    many = F.concat(F.lit("<table class=type2>"), F.repeat(F.lit("<tr>" + "<td>1<br>2</td>" * 7 + "</tr>"), 20_000))
    assert spark.range(1).select(F.size(html.quote_rows(many))).first()[0] == 20_000


def test_pages_are_made_after_their_keys_are_spread(spark, tmp_path):
    orders = spark.range(10).selectExpr("id as o_orderkey", "id as o_custkey", "date'2024-01-02' as o_orderdate", "1e5 + id as o_totalprice", "'x' as o_comment")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    for pages in (landed.day_page_table, landed.uneven_page_table):
        plan = pages(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "type2" not in plan[plan.index("Repartition"):]
