"""Narrative documents to sections and overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CHUNK_CHARS, CHUNK_OVERLAP

#: A heading is "Item" with its number and letter; white space may span lines.
HEADING = r"(item\s+[0-9]+[a-z]?\b\.?)"
_MARK = "\x01"


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def html_text(raw: str | None) -> str:
    """The text of a page, white space collapsed; never raises."""
    if not raw:
        return ""
    parser = _Text()
    parser.feed(raw)
    parser.close()
    return " ".join(" ".join(parser.parts).split())


def strip_html(column: Column) -> Column:
    @F.pandas_udf("string")
    def strip(raw: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in raw:
            yield s.map(html_text)

    return strip(column)


def sections(text: Column) -> Column:
    """array<struct<pos, section, body>>: the text from each heading on; without one, a single "Document"."""
    marked = F.regexp_replace(text, "(?iU)" + HEADING, _MARK + "$1")
    parts = F.split(marked, _MARK)
    found = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p, i: F.struct(i.alias("pos"), F.regexp_replace(F.regexp_extract(p, "(?iU)^" + HEADING, 1), r"(?U)\s+", " ").alias("section"), F.trim(p).alias("body")))
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.lit("Document").alias("section"), F.trim(text).alias("body")))
    # No pattern is searched in texts without a heading's letters, as most are; a dotted capital and a dotless i count as an i.
    may = F.contains(F.lower(text), F.lit("item")) | F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u0131")) | F.contains(text, F.lit(_MARK))
    return F.when(~may, whole).otherwise(F.when(F.size(parts) > 1, found).otherwise(whole))


def windows(body: Column, most: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Overlapping windows of at most ``most`` characters; the last ends with the text."""
    if not 0 <= overlap < most:
        raise ValueError("the overlap must be smaller than the window")
    step = most - overlap
    last = F.when(F.length(body) <= most, F.lit(0)).otherwise(F.ceil((F.length(body) - most) / F.lit(float(step))).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(body, i * step + 1, F.lit(most)))


def chunked(docs: DataFrame, key: str, text: str, most: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """``docs`` exploded to (…, section, chunk_index, text): the index runs through a document's sections."""
    carried = [c for c in docs.columns if c != text]
    one = docs.select(*carried, F.explode(sections(F.col(text))).alias("s"))
    two = one.select(*carried, "s.pos", "s.section", F.posexplode(windows(F.col("s.body"), most, overlap)).alias("at", "text")).filter("text <> ''")
    w = Window.partitionBy(key).orderBy("pos", "at")
    return two.withColumn("chunk_index", F.row_number().over(w) - 1).drop("pos", "at")
