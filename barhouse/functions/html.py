"""Quote-page expressions: table, rows and cells by regular expression, or by a stack of open tags.

Nearly all pages are flat: rows hold nothing but cells, and cells neither rows nor tables.
Those are cut by regular expressions. On any other page, tags are folded into a stack, as a
lenient parser does: a closing tag closes everything opened since its own opening one, and
one without an opening one says nothing. Only a row's direct cells count, whatever they hold.
Everything runs inside the JVM, so a page never crosses into Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from barhouse.functions.clean import strip

# The class of the quote table, and of the cell with the link to
# the last page; the fewest cells a data row has.
QUOTE_TABLE = "type2"
LAST_PAGE_CELL = "pgRR"
ROW_CELLS = 7

# Fixed value: elements that are closed where they are opened.
VOID = "area base br col embed hr img input link meta param source track wbr".split()


def _with_class(tag: str, name: str) -> str:
    quoted = "|".join(
        rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in ('"', "'")
    )
    return rf"<{tag}\b[^>]*?\sclass\s*=\s*(?:{quoted}|{name}(?=[\s>]))[^>]*>"


def _up_to(closing: str) -> str:
    """A group of everything before a closing tag, or the end; it goes from tag to tag, and not by single characters."""
    return rf"((?:[^<]++|<(?!/{closing}\s*>))*+)"


_HIDDEN = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>|[!?][^>]*>)"
_FROM_TABLE = rf"(?is){_with_class('table', QUOTE_TABLE)}.*\z"
_INSIDE = rf"(?is)\A<[^>]*>{_up_to('table')}"
_ROW = rf"(?is)<tr\b[^>]*>{_up_to('tr')}"
_CELL = rf"(?is)<td\b[^>]*>{_up_to('td')}"
_SPAN = rf"(?is)<span\b[^>]*>{_up_to('span')}"
_NBSP = r"(?i)&(?:nbsp|#160|#xa0);"
_TAG = r"(?s)<[^>]*>"
_LAST_CELL = rf"(?is){_with_class('td', LAST_PAGE_CELL)}(.*?)(?:</td\s*>|\z)"
_LINK = r"(?is)<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def quote_rows(html: Column) -> Column:
    """The rows of the first quote table: array<struct<span, cells>>.

    ``cells`` are texts as a reader sees them, ``span`` is that of the first
    cell's first span. Rows with too few cells are NULL. Rows of a table inside
    the quote table follow the row that holds them.
    """
    page = F.regexp_extract(F.regexp_replace(html, _HIDDEN, ""), _FROM_TABLE, 0)
    plain = F.replace(F.regexp_replace(page, _NBSP, " "), F.lit("&amp;"), F.lit("&"))
    return bound(plain, lambda tail: bound(F.regexp_extract(tail, _INSIDE, 1), lambda table: (
        F.when(_is_flat(table), _flat_rows(table)).otherwise(_stacked_rows(tail))
    )))


# Text and tags that are none of rows and cells; a cell of nothing else, and a row of nothing but cells and text.
_OTHER = r"[^<]++|<(?!/?(?:table|tr|td|th)\b[^>]*>)"
_WHOLE_CELL = rf"<t[dh]\b[^>]*>(?:{_OTHER})*+</t[dh]\b[^>]*>"
_WHOLE_ROW = rf"<tr\b[^>]*>(?:[^<]++|{_WHOLE_CELL})*+</tr\b[^>]*>"
_FLAT = rf"(?i)\A(?:{_OTHER}|{_WHOLE_CELL}|{_WHOLE_ROW})*+\z"


def _is_flat(table: Column) -> Column:
    """Whether a table is rows of cells, all closed, with no cells or tables inside them."""
    return table.rlike(_FLAT)


def _flat_rows(table: Column) -> Column:
    rows = F.regexp_extract_all(table, F.lit(_ROW), 1)
    split = F.transform(rows, lambda row: F.regexp_extract_all(row, F.lit(_CELL), 1))
    return F.transform(split, lambda cells: _quote_row(F.regexp_extract(F.get(cells, 0), _SPAN, 1), cells))


_TOKEN = r"(?s)<[^>]*>|[^<]+"
_NAME = r"^<(/?)([a-zA-Z][^\s/>]*)"
_ELEMENT = "struct<open: int, close: int, parent: int, name: string>"


def _stacked_rows(tail: Column) -> Column:
    """The rows of a page that starts with the quote table's tag."""
    return bound(F.regexp_extract_all(tail, F.lit(_TOKEN), 0), lambda tokens: bound(_elements(tokens), lambda elements: (
        F.transform(_named(elements, "tr"), lambda row: bound(
            F.filter(_named(elements, "td"), lambda cell: cell["parent"] == row["open"]),
            lambda cells: _stacked_row(tokens, elements, cells),
        ))
    )))


def _named(elements: Column, name: str) -> Column:
    return F.filter(elements, lambda e: e["name"] == name)


def _stacked_row(tokens: Column, elements: Column, cells: Column) -> Column:
    first = F.get(cells, 0)
    spans = F.filter(_named(elements, "span"), lambda e: (e["open"] > first["open"]) & (e["open"] < first["close"]))
    span = bound(F.get(spans, 0), lambda s: F.when(s.isNotNull(), _content(tokens, s)))
    whole = F.transform(cells, lambda cell: _content(tokens, cell))
    # Texts are only put together for a row that has enough cells.
    return F.when(F.size(cells) >= ROW_CELLS, _quote_row(F.coalesce(span, F.lit("")), whole))


def _content(tokens: Column, element: Column) -> Column:
    """Everything between an element's tags."""
    return F.array_join(F.slice(tokens, element["open"] + 2, element["close"] - element["open"] - 1), "")


def _elements(tokens: Column) -> Column:
    """Where each element of the first one opens and closes, and where the one around it opens, by opening place."""
    tags = F.transform(tokens, lambda token, i: F.struct(
        i.alias("at"),
        F.regexp_extract(token, _NAME, 1).alias("slash"),
        F.lower(F.regexp_extract(token, _NAME, 2)).alias("name"),
        token.endswith("/>").alias("closed"),
    ))
    known = F.filter(tags, lambda tag: (tag["name"] != "") & ~tag["name"].isin(VOID))
    none = F.array().cast(f"array<{_ELEMENT}>")
    start = F.struct(none.alias("stack"), none.alias("done"))
    state = F.aggregate(known, start, lambda state, tag: F.when(tag["slash"] == "", _opened(state, tag)).otherwise(_closed(state, tag)))
    # What nothing closed ends with the page; after the first element has closed, nothing counts.
    end = F.size(tokens)
    return bound(state, lambda s: F.sort_array(F.concat(s["done"], _ended(s["stack"], end))))


def _state(stack: Column, done: Column) -> Column:
    return F.struct(stack.alias("stack"), done.alias("done"))


def _element(open_: Column, close: Column, parent: Column, name: Column) -> Column:
    return F.struct(open_.alias("open"), close.alias("close"), parent.alias("parent"), name.alias("name")).cast(_ELEMENT)


def _opened(state: Column, tag: Column) -> Column:
    around = F.coalesce(F.get(state["stack"], F.size(state["stack"]) - 1)["open"], F.lit(-1))
    entry = F.array(_element(tag["at"], tag["at"] + 1, around, tag["name"]))
    inside = (F.size(state["stack"]) > 0) | (tag["at"] == 0)
    stack, done = state["stack"], state["done"]
    return F.when(~inside, state).when(tag["closed"], _state(stack, F.concat(done, entry))).otherwise(_state(F.concat(stack, entry), done))


def _closed(state: Column, tag: Column) -> Column:
    stack = state["stack"]
    from_top = F.array_position(F.reverse(stack["name"]), tag["name"]).cast("int")

    def popped(n: Column) -> Column:
        ended = _ended(F.slice(stack, F.size(stack) - n + 1, n), tag["at"])
        return F.when(n > 0, _state(F.slice(stack, 1, F.size(stack) - n), F.concat(state["done"], ended))).otherwise(state)

    return bound(from_top, popped)


def _ended(elements: Column, at: Column) -> Column:
    return F.transform(elements, lambda e: _element(e["open"], at, e["parent"], e["name"]))


def _quote_row(span: Column, cells: Column) -> Column:
    row = F.struct(_text(span).alias("span"), F.transform(cells, _text).alias("cells"))
    return F.when(F.size(cells) >= ROW_CELLS, row)


def _text(cell: Column) -> Column:
    return strip(F.regexp_replace(cell, _TAG, ""))


def last_page(html: Column) -> Column:
    """The page number behind the last-page link; 1 where there is none."""
    cell = F.regexp_extract(html, _LAST_CELL, 1)
    link = F.concat(F.regexp_extract(cell, _LINK, 1), F.regexp_extract(cell, _LINK, 2))
    return F.coalesce(F.regexp_extract(link, "page=([0-9]+)", 1).try_cast("int"), F.lit(1))
