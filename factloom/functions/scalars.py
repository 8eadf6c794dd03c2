"""Scalar functions as Column expressions: text, dates, numbers, hashes, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CLIP

SEPARATOR = "\x1f"


def bare_concept(name: Column) -> Column:
    """Without what stands before the first colon; later colons stay."""
    return F.regexp_replace(name, "^[^:]*:", "")


def measure_label(measure: Column) -> Column:
    """What stands after the last colon."""
    return F.substring_index(F.trim(measure), ":", -1)


def fact_value(text: Column, scale: Column | None = None, sign: Column | None = None) -> Column:
    """Reported number text to decimal: commas and spaces dropped, (x) negative, times 10**scale, null if no number.

    A scale that is no integer counts as 0; sign "-" negates.
    """
    bare = F.regexp_replace(text, r"(?U)[\s,]", "")
    inner = F.when(bare.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.regexp_replace(bare, r"[()]", ""))).otherwise(bare)
    value = inner.try_cast("decimal(38,10)")
    if scale is not None:
        power = F.coalesce(scale.try_cast("int"), F.lit(0))
        value = (value * F.pow(F.lit(10.0), power).cast("decimal(20,6)")).try_cast("decimal(38,10)")
    if sign is not None:
        value = F.when(F.trim(sign) == "-", -value).otherwise(value)
    return value


def iso_date(text: Column) -> Column:
    """The date of an ISO text, with or without a time; null if there is none."""
    return F.try_to_date(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd")


def as_date(value: Column) -> Column:
    """A date, a timestamp's date, or what the first ten characters of a text say; null for anything else."""
    return F.try_to_date(F.substring(F.trim(value.cast("string")), 1, 10), "yyyy-MM-dd")


def padded_id(text: Column) -> Column:
    return F.lpad(text, 10, "0")


def undashed(accession: Column) -> Column:
    """An accession number as paths have it: without dashes."""
    return F.replace(accession, F.lit("-"), F.lit(""))


def percent_text(share: Column, places: int = 0, plus: bool = False) -> Column:
    """A share as percent text; of two equally near, the even last place."""
    text = F.format_string(f"%{'+' if plus else ''}.{places}f%%", F.bround((share * 100).cast("decimal(38,12)"), places).cast("double"))
    return F.when(share.isNotNull(), text)


def fixed_text(x: Column, places: int) -> Column:
    """A number with a fixed count of places; of two equally near, the even last one."""
    return F.when(x.isNotNull(), F.format_string(f"%.{places}f", F.bround(x.cast("decimal(38,12)"), places).cast("double")))


def plain(df: DataFrame, zone: str = "Z") -> DataFrame:
    """Decimals as doubles, dates and times as ISO text: what a JSON answer can hold."""
    def one(f) -> Column:
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            return F.col(f.name).cast("double").alias(f.name)
        if kind == "date":
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if kind.startswith("timestamp"):
            return F.concat(iso_instant(F.col(f.name)), F.lit(zone)).alias(f.name)
        return F.col(f.name)

    return df.select(*map(one, df.schema))


def as_json(df: DataFrame) -> Column:
    """A row as JSON text, nulls kept."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def bare_id(text: Column) -> Column:
    """Without leading zeros; all zeros give "0"."""
    return F.coalesce(F.nullif(F.regexp_replace(text, "^0+", ""), F.lit("")), F.lit("0"))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b clipped to [-10, 10]; 0 where either is missing or b is 0."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return F.when(q.isNull() | F.isnan(q), F.lit(0.0)).otherwise(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), q)))


def signed_log(x: Column) -> Column:
    """sign(x) * log10(1 + |x|); 0 where x is missing."""
    return F.coalesce(F.signum(x.cast("double")) * F.log10(1 + F.abs(x.cast("double"))), F.lit(0.0))


def finite(x: Column) -> Column:
    """As double; null where it is no number, NaN or infinite."""
    v = x.try_cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v)


def joined_hash(*parts: Column) -> Column:
    """SHA-256 over the parts with \\x1f between them, null as the empty text."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def fact_hash() -> Column:
    """Identity of a fact: accession, concept, period and segment."""
    return joined_hash(F.col("accession_number"), F.col("fact_name"), F.col("period_start"), F.col("period_end"), F.col("segment"))


def iso_instant(ts: Column) -> Column:
    """ISO text in UTC, without the fraction where there are no microseconds."""
    fraction = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == "000000", base).otherwise(F.concat(base, F.lit("."), fraction))


def snippet(text: Column, n: int) -> Column:
    """White space collapsed; cut to n characters with an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, n)), F.lit("…")))


def word_terms(text: Column, longer_than: int = 0) -> Column:
    """Distinct lower-case runs of letters and digits."""
    terms = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(terms, lambda w: F.length(w) > longer_than))


def best_sentence_window(text: Column, question: Column) -> Column:
    """The text from the sentence on that shares most terms with the question; the first of equals; all of it if none does."""
    sentences = F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), F.trim), lambda s: s != "")
    wanted = word_terms(question, 2)
    scores = F.transform(sentences, lambda s: F.size(F.array_intersect(wanted, word_terms(s))))
    at = F.array_position(scores, F.array_max(scores)).cast("int")
    cut = F.array_join(F.slice(sentences, at, F.greatest(F.size(sentences) - at + 1, F.lit(0))), " ")
    return F.when((F.size(sentences) <= 1) | (F.size(wanted) == 0) | (F.array_max(scores) == 0), text).otherwise(cut)


def violations(raw: Column) -> Column:
    """Violations from JSON text; an empty list where it can't be read."""
    parsed = F.from_json(raw, "array<struct<rule_id:string,severity:double,message:string>>")
    return F.coalesce(parsed, F.array().cast("array<struct<rule_id:string,severity:double,message:string>>"))


def ticker_is(column: str, ticker: str) -> Column:
    return F.upper(F.col(column)) == ticker.upper()


def checked(name: str, value, low=None, high=None):
    """The value, or ValueError outside the bounds that a read query allows."""
    if (low is not None and value < low) or (high is not None and value > high):
        raise ValueError(f"{name} must be between {low} and {high}, not {value}")
    return value
