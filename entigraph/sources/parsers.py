"""Parsers of source texts: links, headings, tables, statutes, assistance listings, spreadsheets."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import collapse, strip, text

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


ANCHOR = re.compile(r"""<a(?=[\s/>])((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)>|</a\s*>""", re.I)
HREF = re.compile(r"(?:^|[\s\"'/])href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
UNREAD = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
MARKUP = re.compile(r"<[^>]*>")


def page_links(page: str | bytes | None) -> list[tuple[str, str]]:
    """(href, label with single spaces) of each link with an end tag. What lies between a start and the next end is the
    label; a start before that end begins anew."""
    text = page.decode("utf-8", "replace") if isinstance(page, bytes) else page or ""
    marks = list(ANCHOR.finditer(text := UNREAD.sub(" ", text)))
    out = []
    for mark, behind in zip(marks, marks[1:], strict=False):
        href = HREF.search(mark[1]) if mark[1] is not None else None
        if href and behind[1] is None:
            label = " ".join(unescape(MARKUP.sub(" ", text[mark.end() : behind.start()])).split())
            out.append((unescape(next(g for g in href.groups() if g is not None)), label))
    return out


#: Rows of a slice: what parsing gives is handed on so often, however much a value holds.
SLICE_ROWS = 2000


def exploded(df: DataFrame, column: str, schema: T.StructType, parse) -> DataFrame:
    """The other columns of df beside each row (a tuple) that parse gives for the value in `column`, in slices."""
    at, keep = df.columns.index(column), [i for i, c in enumerate(df.columns) if c != column]
    names = [df.columns[i] for i in keep] + schema.fieldNames()
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.list_(pa.string()) if isinstance(f.dataType, T.ArrayType) else pa.string() for f in schema.fields]

    def piece(batch, row, out):
        take = pa.array(row, pa.int64())
        new = [pa.array([r[j] for r in out], kinds[j]) for j in range(len(kinds))]
        return pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in keep), *new], names)

    def run(batches):
        for batch in batches:
            row, out = [], []
            for i, value in enumerate(batch.column(at)):
                for r in parse(value.as_py()):
                    row.append(i)
                    out.append(r)
                    if len(out) == SLICE_ROWS:
                        yield piece(batch, row, out)
                        row, out = [], []
            yield piece(batch, row, out)

    return df.mapInArrow(run, T.StructType([*(df.schema.fields[i] for i in keep), *schema.fields]))


def links(df: DataFrame, html: str = "html", numbered: bool = False) -> DataFrame:
    """One row per link: href as written, label with single spaces; `numbered`, its place on the page as `at`."""
    schema = T.StructType().add("at", "long") if numbered else T.StructType()
    parse = (lambda page: [(i, *link) for i, link in enumerate(page_links(page))]) if numbered else page_links
    return exploded(df, html, schema.add("href", "string").add("label", "string"), parse)


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells: list[tuple[int, int, int, str]] = []
        self.table, self.row, self.col, self.parts = 0, 0, 0, None

    def _end(self):
        if self.parts is not None:
            self.cells.append((self.table, self.row, self.col, " ".join(" ".join(self.parts).split())))
        self.parts = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._end()
            self.table, self.row = self.table + 1, 0
        elif tag == "tr":
            self._end()
            self.row, self.col = self.row + 1, 0
        elif tag in ("td", "th"):
            self._end()
            self.col, self.parts = self.col + 1, []

    def handle_data(self, data):
        if self.parts is not None:
            self.parts.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self._end()


def page_cells(html: str | None) -> list[tuple[int, int, int, str]]:
    p = _Tables()
    p.feed(html or "")
    p.close()
    p._end()
    return p.cells


def tables(df: DataFrame, html: str = "html") -> DataFrame:
    """One row per table cell: table, row and col from 1, value."""
    return exploded(df, html, T.StructType().add("table", "long").add("row", "long").add("col", "long").add("value", "string"), page_cells)


def clean_number(c: Column | str) -> Column:
    """A section number without white space, section sign, "Sec." or "Section", and dots at the ends."""
    bare = F.regexp_replace(text(c), r"(?U)[\s§]", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)^(sec\.?|section)", ""), r"^[. ]+|[. ]+$", "")


_TAG = r"""<(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
_NAME = r"(?:[\w.-]{1,40}:)?"


def _untagged(c: Column, gap: str) -> Column:
    """The text of a piece of XML, with `gap` for each tag."""
    bare = F.regexp_replace(c, _TAG, gap)
    whole = F.xpath_string(F.concat(F.lit("<x>"), bare, F.lit("</x>")), F.lit("/x"))
    return F.when(bare.contains("&"), whole).otherwise(bare)


def _first(c: Column, name: str, gap: str) -> Column:
    return _untagged(F.regexp_extract(c, rf"(?s)<{_NAME}{name}(?:\s[^>]*)?>(.*?)</{_NAME}{name}\s*>", 1), gap)


def section_pieces(df: DataFrame, xml: str = "xml") -> DataFrame:
    """The other columns, section (its number), position and piece (its XML) of each section of statute files, one file a row.

    A file is cut at the tags of sections by an expression. Nearly all pieces are whole sections and go on as they are; those
    that are not belong to sections within sections and are put together from what lies at one depth. An inner section is no
    part of the outer one's piece. Namespaces and comments don't matter.
    """
    bare = F.regexp_replace(F.regexp_replace(text(xml), r"(?s)<!--.*?-->", " "), r"<!\[CDATA\[|\]\]>", "")
    cut = F.split(bare, rf"(?=<{_NAME}section[\s>])|(?<=</section>)|(?<=</[\w.-]{{1,40}}:section>)")
    keep = [c for c in df.columns if c != xml]
    pieces = df.withColumn("__file", F.monotonically_increasing_id()).select("__file", *keep, F.posexplode(cut).alias("__at", "piece"))
    opens, ends = F.col("piece").rlike(rf"^<{_NAME}section[\s>]"), F.col("piece").rlike(rf"</{_NAME}section>$")
    pieces = pieces.withColumns({"__opens": opens, "__ends": ends})
    whole = pieces.filter("__opens and __ends").select(*keep, "__at", "piece")
    so_far = Window.partitionBy("__file").orderBy("__at")
    rest = pieces.filter("not (__opens and __ends)")
    depth = F.sum(F.col("__opens").cast("int")).over(so_far) - F.coalesce(F.sum(F.col("__ends").cast("int")).over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = rest.withColumn("__depth", depth).filter("__depth > 0")
    rest = rest.withColumn("__own", F.last(F.when(F.col("__opens"), F.col("__at")), ignorenulls=True).over(Window.partitionBy("__file", "__depth").orderBy("__at")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", "piece"))), lambda p: p["piece"]), " ")
    rest = rest.groupBy("__file", *keep, "__own").agg(F.max("__at").alias("__at"), joined.alias("piece")).select(*keep, "__at", "piece")
    return whole.union(rest).select(*keep, clean_number(_first(F.col("piece"), "num", "")).alias("section"), F.col("__at").cast("long").alias("position"), "piece")


def section_texts(pieces: DataFrame) -> DataFrame:
    """Pieces of sections as heading and text."""
    return pieces.withColumns({"heading": collapse(_first(F.col("piece"), "heading", " ")), "text": collapse(_untagged(F.col("piece"), " "))}).drop("piece")


def _place(reference: str, behind: int) -> int:
    """The column (from 0) that a cell's reference such as "AB7" names; without one the next."""
    letters = re.match("[A-Z]*", reference)[0]
    number = 0
    for letter in letters:
        number = 26 * number + "ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(letter) + 1
    return number - 1 if letters else behind


def sheet_rows(raw: bytes | None) -> Iterator[tuple[int, str, int, list[str]]]:
    """(position, sheet, row from 1, cells) of a spreadsheet, read row by row with the standard library; besides the row
    at hand only the file's shared texts are held."""
    if not raw:
        return
    m = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

    def elements(z: zipfile.ZipFile, path: str, tag: str) -> Iterator[ET.Element]:
        with z.open(path) as f:
            for _, e in ET.iterparse(f):
                if e.tag == f"{m}{tag}":
                    yield e
                    e.clear()

    position = 0
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        have = "xl/sharedStrings.xml" in z.namelist()
        shared = ["".join(t.text or "" for t in e.iter(f"{m}t")) for e in elements(z, "xl/sharedStrings.xml", "si")] if have else []
        target = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{m}sheet"):
            path = target[sheet.get(rel)].lstrip("/")
            for number, row in enumerate(elements(z, path if path.startswith("xl/") else f"xl/{path}", "row"), 1):
                cells: list[str] = []
                for c in row.iter(f"{m}c"):
                    cells += [""] * (_place(c.get("r", ""), len(cells)) - len(cells))
                    if c.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in c.iter(f"{m}t")))
                    else:
                        value = c.findtext(f"{m}v") or ""
                        cells.append(shared[int(value)] if value and c.get("t") == "s" else value)
                yield position, sheet.get("name"), int(row.get("r", number)), cells
                position += 1


def workbook_rows(df: DataFrame, content: str = "content") -> DataFrame:
    """The other columns, rec_idx (order in the file), sheet, row and cells of each row of workbooks."""
    return exploded(df, content, T.StructType().add("rec_idx", "long").add("sheet", "string").add("row", "long").add("cells", T.ArrayType(T.StringType())), sheet_rows)


def parse_authorities(df: DataFrame, column: str) -> DataFrame:
    """One row per code citation in `column`: authority_sequence (from 1), authority_citation, usc_title, usc_section.

    A text without a citation gives one row with the whole text as citation; an empty text gives none.
    """
    pattern = r"(?i)((\d+)\s*U\.?S\.?C\.?\s*(?:§{1,2}\s*)?([0-9A-Za-z._-]+))"  # fixed value
    every = lambda group: F.regexp_extract_all(strip(column), F.lit(pattern), group)
    found = F.arrays_zip(every(1).alias("authority_citation"), every(2).alias("usc_title"), every(3).alias("usc_section"))
    none = F.array(F.struct(strip(column).alias("authority_citation"), F.lit("").alias("usc_title"), F.lit("").alias("usc_section")))
    rows = df.filter(strip(column) != "").select(*df.columns, F.posexplode(F.when(F.size(found) > 0, found).otherwise(none)).alias("__at", "__c"))
    return rows.select(*df.columns, (F.col("__at") + 1).alias("authority_sequence"), "__c.*")
