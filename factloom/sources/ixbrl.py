"""Inline XBRL documents to fact rows, with a parser that tolerates broken markup."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from decimal import Decimal, InvalidOperation
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CONCEPTS, PREFIX, REVENUE_ALIAS

TARGETS = tuple(PREFIX + c for c in (*CONCEPTS, REVENUE_ALIAS))


class _Node:
    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children, self.text = tag, attrs, [], ""
        self.local = tag.rpartition(":")[2]

    def all(self, local: str) -> Iterator[_Node]:
        left = self.children[::-1]
        while left:
            node = left.pop()
            if node.local == local:
                yield node
            left.extend(node.children[::-1])

    def first(self, local: str) -> _Node | None:
        return next(self.all(local), None)

    def full_text(self) -> str:
        return self.text + "".join(c.full_text() for c in self.children)


class _Tree(HTMLParser):
    """Unclosed elements end with their parent; stray end tags are ignored."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in self.VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        for node in self.open[-1:]:
            node.text += data


def parsed_date(text: str | None) -> date | None:
    try:
        y, m, d = (text or "").strip().split("-")[:3]
        return date(int(y), int(m), int(d))
    except ValueError:
        return None


def parsed_value(text: str, scale: str | None = None, sign: str | None = None) -> Decimal | None:
    """The number that a fact reports; null if it reports none."""
    bare = "".join(text.split()).replace(",", "")
    if bare.startswith("(") and bare.endswith(")"):
        bare = "-" + bare[1:-1]
    try:
        value = Decimal(bare)
    except InvalidOperation:
        return None
    if not value.is_finite():
        return None
    try:
        value = value.scaleb(int(scale)) if scale else value
    except ValueError:
        pass
    return -value if sign == "-" else value


def _label(node: _Node | None) -> str:
    measure = node.first("measure") if node else None
    return measure.full_text().strip().rpartition(":")[2] if measure else ""


def parse(html: str | None, targets: tuple[str, ...] = TARGETS, segments: bool = True) -> list[dict]:
    """Fact rows in document order: concept, value, unit, period, segment; facts without a known context are dropped."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    contexts = {}
    for c in tree.root.all("context"):
        at, begins, ends = c.first("instant"), c.first("startdate"), c.first("enddate")
        members = "; ".join(m.full_text().strip() for m in c.all("explicitmember"))
        start = None if at else parsed_date(begins.full_text() if begins else None)
        end = parsed_date(at.full_text()) if at else parsed_date(ends.full_text() if ends else None)
        contexts[c.attrs.get("id")] = (start, end, members or None)
    units = {}
    for u in tree.root.all("unit"):
        over, under = u.first("unitnumerator"), u.first("unitdenominator")
        units[u.attrs.get("id")] = f"{_label(over)}/{_label(under)}" if over and under else _label(u) or u.attrs.get("id")
    rows = []
    for f in tree.root.all("nonfraction"):
        name, ref, unit = f.attrs.get("name"), f.attrs.get("contextref"), f.attrs.get("unitref")
        if name not in targets or ref not in contexts:
            continue
        start, end, segment = contexts[ref]
        if segment and not segments:
            continue
        rows.append({"fact_name": name, "fact_value": parsed_value(f.full_text(), f.attrs.get("scale"), f.attrs.get("sign")), "unit": units.get(unit, unit or None), "period_start": start, "period_end": end, "segment": segment, "ord": len(rows)})
    return rows


#: Facts that a task gathers before it gives them out.
ROWS_A_BATCH = 10_000

_OUT = "accession_number string, status string, detail string, fact_name string, fact_value decimal(38,10), unit string, period_start date, period_end date, segment string, ord int"
_KINDS = pa.schema([("accession_number", pa.string()), ("status", pa.string()), ("detail", pa.string()), ("fact_name", pa.string()), ("fact_value", pa.decimal128(38, 10)), ("unit", pa.string()), ("period_start", pa.date32()), ("period_end", pa.date32()), ("segment", pa.string()), ("ord", pa.int32())])


def facts(docs: DataFrame, targets: tuple[str, ...] = TARGETS, segments: bool = True) -> DataFrame:
    """Facts of (accession_number, raw_html); a document that fails gives one row with its status, never an exception."""

    def one(accession: str, html: str | None) -> list[dict]:
        try:
            rows = [{"accession_number": accession, "status": "success"} | r for r in parse(html, targets, segments)] or [{"accession_number": accession, "status": "empty"}]
            for r in rows:
                if r.get("fact_value") is not None:
                    r["fact_value"] = pa.scalar(r["fact_value"], _KINDS.field("fact_value").type).as_py()
            return rows
        except Exception as e:  # noqa: BLE001  one bad document must not end the batch
            return [{"accession_number": accession, "status": "failed", "detail": str(e)[:500]}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for accession, html in zip(batch["accession_number"].to_pylist(), batch["raw_html"], strict=True):
                rows += one(accession, html.as_py())
                if len(rows) >= ROWS_A_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _KINDS], schema=_KINDS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _KINDS], schema=_KINDS)

    return docs.select("accession_number", "raw_html").mapInArrow(run, _OUT)


def register(spark: SparkSession) -> None:
    """The table function ixbrl_facts(accession_number, raw_html) for SQL: the facts of one document, none of one that can't be read."""

    class Facts:
        def eval(self, accession: str, html: str):
            try:
                rows = parse(html)
            except Exception:  # noqa: BLE001  one bad document must not end the query
                return
            for r in rows:
                yield accession, r["fact_name"], r["fact_value"], r["unit"], r["period_start"], r["period_end"], r["segment"], r["ord"]

    spark.udtf.register("ixbrl_facts", F.udtf(Facts, returnType="accession_number string, fact_name string, fact_value decimal(38,10), unit string, period_start date, period_end date, segment string, ord int"))
