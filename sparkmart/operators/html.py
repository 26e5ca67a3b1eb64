"""HTML extraction over stored pages.

One distributed parse turns every page into a *node table* - one row per
element with its tag, class, attributes, text content and the nearest
enclosing "scope" element (a card, a table row, a review item...). All
structure recovery after that (pivots, positional zips, de-duplication,
numbering) is ordinary DataFrame work, so pages are parsed once, in
Arrow batches, inside the executors.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from sparkmart.session import written

NODE_FIELDS = ("pos int, tag string, cls string, attrs map<string,string>, "
               "text string, scope string, scope_pos int, parent_cls string")
ERROR_TAG = "#error"   # the row of a page that could not be read to its end; its text is the error

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}


@cache
def _selector(sel: str) -> tuple[str, str | None, frozenset[str]]:
    """(tag, id, classes) of 'tag', '.class', 'tag.class.class' and 'tag#id' selectors."""
    name, _, rest = sel.partition("#") if "#" in sel else sel.partition(".")
    return (name, rest, frozenset()) if "#" in sel else (name, None, frozenset(filter(None, rest.split("."))))


def _matches(sel: str, tag: str, classes: list[str], elem_id: str | None = None) -> bool:
    name, own_id, of_class = _selector(sel)
    if name and name != tag:
        return False
    return elem_id == own_id if own_id is not None else of_class.issubset(classes)


class _Nodes:
    """The node rows of one page, built from its start tags, end tags and texts."""

    def __init__(self, scopes: Sequence[str], keep: set[str] | None):
        self.scopes, self.keep = scopes, keep
        self.rows: list[list] = []
        self.texts: list[str] = []      # stripped, in page order; an element's text is a run of them
        # frame: [tag, row, first text, class text, scope and its place for the elements inside]
        self.stack: list[tuple] = []
        self.pos = 0

    def described(self, tag: str, attrs: dict[str, str]) -> tuple[dict[str, str], str, str | None, bool]:
        """(attributes, class text, own scope, whether it gets a row) of a start tag, on any page."""
        classes = attrs["class"].split() if "class" in attrs else []
        own = None
        for s in self.scopes:
            if _matches(s, tag, classes, attrs.get("id")):
                own = s
                break
        return attrs, " ".join(classes), own, self.keep is None or tag in self.keep or own is not None

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        attrs, cls, own, kept = self.described(tag, attrs)
        _, _, _, parent_cls, scope, scope_pos = self.stack[-1] if self.stack else _TOP
        self.pos += 1
        row = None
        if kept:
            row = [self.pos, tag, cls, attrs, None, scope, scope_pos, parent_cls]
            self.rows.append(row)
        if tag not in _VOID:
            inside = (scope, scope_pos) if own is None else (own, self.pos)
            self.stack.append((tag, row, len(self.texts), cls, *inside))

    def end(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._close(i)
                return

    def _close(self, at: int) -> None:
        for _, row, first, *_ in self.stack[at:]:
            if row is not None:
                row[4] = "".join(self.texts[first:])
        del self.stack[at:]

    def text(self, data: str) -> None:
        s = data.strip()
        if s:
            self.texts.append(s)

    def finish(self) -> list[list]:
        self._close(0)
        return self.rows


_TOP = (None, None, 0, None, None, None)


class _NodeParser(HTMLParser):
    """Any page, through the standard library's parser."""

    def __init__(self, nodes: _Nodes):
        super().__init__(convert_charrefs=True)
        self.nodes = nodes

    def handle_starttag(self, tag, attrs):
        self.nodes.start(tag, {k: (v if v is not None else "") for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.nodes.end(tag)

    def handle_data(self, data):
        self.nodes.text(data)


# a page of these tokens only means the same to every HTML parser
_ATTRIBUTE = r'[ \t\n\r\f]+[A-Za-z][A-Za-z0-9_-]*="[^"<>&]*"'
# (start tag with its attributes, end tag or doctype, the text behind it); a "<" that begins no such token is one of three blanks
_TOKEN = re.compile(rf'<(?:([a-z][a-z0-9]*(?:{_ATTRIBUTE})*[ \t\n\r\f]*/?)|(/[a-z][a-z0-9]*|!(?i:doctype) [^<>]*))>([^<]*)|<')
_TAG_NAME = re.compile("[a-z][a-z0-9]*")
_NAME_VALUE = re.compile(r'\s+([^=]+)="([^"]*)"')
_RAW_TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


KNOWN_TAGS = 4096      # start tags, as they are written, whose description a task holds


def _plain_nodes(html: str, nodes: _Nodes, known: dict) -> list[list] | None:
    """What ``nodes`` would make of a page without comments, raw text with markup,
    loose quotes or the like, in one loop; None for any other page. ``known`` holds
    what start tags, as they are written, were found to be."""
    rows, stack, texts, pos, raw = [], [], [], 0, None
    cls = scope = scope_pos = None                # of the innermost open element
    at = html.find("<")
    before = unescape(html if at < 0 else html[:at]).strip()
    if before:
        texts.append(before)
    for start, end, text in _TOKEN.findall(html):
        if raw is not None:
            if end != raw:      # raw text ends with its own end tag only
                return None
            raw = None
        if start:
            found = known.get(start)
            if found is None:
                tag = _TAG_NAME.match(start).group()
                if tag in ("script", "style", "plaintext"):      # their text is not unescaped
                    return None
                found = nodes.described(tag, {k.lower(): v for k, v in _NAME_VALUE.findall(start)})
                found = (tag, *found, None if tag in _VOID else "/" + tag, "/" + tag if tag in _RAW_TEXT else None)
                if len(known) >= KNOWN_TAGS:
                    known.clear()
                known[start] = found
            tag, attrs, own_cls, own, kept, its_end, raw = found
            pos += 1
            row = None
            if kept:
                row = [pos, tag, own_cls, attrs, None, scope, scope_pos, cls]
                rows.append(row)
            if its_end:
                stack.append((its_end, row, len(texts), cls, scope, scope_pos))
                cls = own_cls
                if own is not None:
                    scope, scope_pos = own, pos
        elif end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == end:
                    while len(stack) > i:
                        _, row, first, cls, scope, scope_pos = stack.pop()
                        if row is not None:
                            row[4] = "".join(texts[first:])
                    break
        else:
            return None
        if text:
            text = (unescape(text) if "&" in text else text).strip()
            if text:
                texts.append(text)
    if raw is not None:
        return None
    for _, row, first, *_ in stack:
        if row is not None:
            row[4] = "".join(texts[first:])
    return rows


def page_nodes(html: str, scopes: Sequence[str], keep: set[str] | None, known: dict | None = None) -> list[list]:
    """The node rows of a page, in page order; a page that cannot be read to its
    end has the rows before that and one of ``ERROR_TAG``. ``known`` may be passed on from
    page to page that are read with the same scopes and tags."""
    nodes = _Nodes(scopes, keep)
    try:
        rows = _plain_nodes(html, nodes, {} if known is None else known)
        if rows is not None:
            return rows
        parser = _NodeParser(nodes)
        parser.feed(html)
        parser.close()
        return nodes.finish()
    except Exception as e:  # what was read stays, and the page is reported
        return [*nodes.rows, [nodes.pos + 1, ERROR_TAG, "", {}, f"{type(e).__name__}: {e}", None, None, None]]


def _plain_tokens(html: str) -> list | None:
    """The tokens of a page that is read by them, None for any other page."""
    return None if _plain_nodes(html, _Nodes((), None), {}) is None else _TOKEN.findall(html)


PAGES_A_TASK = 5000
PARSE_BYTES = 1 << 20      # of pages, between two batches of nodes


def _dealt(pages: DataFrame) -> DataFrame:
    """The pages dealt over all cores, and over more tasks the more there are: a small
    file may hold very many pages, and its reader would parse them in one task."""
    n, cores = pages.count(), pages.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-n // PAGES_A_TASK), min(2 * cores, -(-n // 200)), 1)
    return pages.repartition(tasks, *pages.columns)


def parse_nodes(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                scopes: Sequence[str] = (), keep_tags: Sequence[str] | None = None,
                materialize: bool = True) -> DataFrame:
    """Node table of every page (see module doc). ``scopes`` are simple
    selectors ('tag', '.class', 'tag.class' or 'tag#id'); ``keep_tags`` limits the
    emitted elements (scope elements are always emitted). ``text`` follows
    "get_text(strip=True)": stripped text pieces of the subtree, joined.

    Jobs that read the node table several times (fields, scopes, page attributes)
    have it written once as Parquet below the session's shared checkpoint folder: the
    Python parse runs once per page, and a lost executor re-reads the copy instead of
    re-parsing. A job that reads it once passes ``materialize=False``."""
    def columns(rows: list) -> list[pa.Array]:
        pos, tag, cls, attrs, text, scope, scope_pos, parent = zip(*rows) if rows else [()] * 8
        ends = np.cumsum([0, *map(len, attrs)])
        pairs = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array([k for a in attrs for k in a], pa.string()),
                                        pa.array([v for a in attrs for v in a.values()], pa.string()))
        return [pa.array(pos, pa.int32()), pa.array(tag, pa.string()), pa.array(cls, pa.string()), pairs, pa.array(text, pa.string()),
                pa.array(scope, pa.string()), pa.array(scope_pos, pa.int32()), pa.array(parent, pa.string())]

    nodes = _parsed(pages.select(id_col, html_col), scopes, keep_tags, lambda rows: rows, columns, NODE_FIELDS)
    return written(nodes, "nodes") if materialize else nodes


def page_rows(pages: DataFrame, pick: Callable[[list[list]], list[tuple]], fields: pa.Schema, scopes: Sequence[str] = (),
              keep_tags: Sequence[str] | None = None, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The rows (columns ``fields``) that ``pick`` makes of each page's nodes (lists in the order
    of ``NODE_FIELDS``), beside the ``page_id``: of a job that needs little of a node table, so that
    the rest of it does not leave the parse."""
    def columns(rows: list) -> list[pa.Array]:
        return [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(fields), fields)]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in from_arrow_schema(fields))
    return _parsed(pages.select(id_col, html_col), scopes, keep_tags, pick, columns, schema)


def _parsed(pages: DataFrame, scopes: Sequence[str], keep_tags: Sequence[str] | None, pick: Callable, columns: Callable,
            fields: str) -> DataFrame:
    """``page_id`` and ``columns`` of the rows that ``pick`` makes of each page's nodes."""
    keep, scopes = set(keep_tags) if keep_tags else None, list(scopes)
    kind = pages.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            step = max(1, int(batch.num_rows * PARSE_BYTES // max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows, of_page = [], []
                for i, html in enumerate(part.column(1).to_pylist()):
                    if html is not None:
                        found = pick(page_nodes(html, scopes, keep, known))
                        rows += found
                        of_page += [i] * len(found)
                ids = part.column(0).take(pa.array(of_page, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, *columns(rows)], names=names)

    schema = f"page_id {kind}, {fields}"
    names = StructType.fromDDL(schema).names
    return _dealt(pages).mapInArrow(run, schema)


def parse_rejects(nodes: DataFrame) -> DataFrame:
    """(page_id, error) of the pages that could not be read to their end."""
    return nodes.where(F.col("tag") == ERROR_TAG).select("page_id", F.col("text").alias("error"))


def attr(name: str) -> Column:
    return F.col("attrs").getItem(name)


def has_class(name: str, col: str = "cls") -> Column:
    return F.coalesce(F.array_contains(F.split(F.col(col), " "), name), F.lit(False))


def parent_has_class(name: str) -> Column:
    return has_class(name, "parent_cls")


def first_by_pos(nodes: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """First (document order) value per key - an aggregate, not a window."""
    return nodes.groupBy(*keys).agg(F.min_by(value, F.col("pos")).alias(name))


def dedupe_numbered(df: DataFrame, keys: Sequence[str], value: str, order: str = "pos",
                    name: str = "sort_order") -> DataFrame:
    """Order-preserving de-duplication of ``value`` within ``keys`` then
    1-based numbering in first-seen order."""
    first = df.groupBy(*keys, value).agg(F.min(order).alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_first", value)
    return first.withColumn(name, F.row_number().over(w).cast("int")).drop("_first")
