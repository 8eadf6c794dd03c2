"""JSON payloads of the filing service to rows, and document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUBMISSIONS = "cik string, name string, tickers array<string>, exchanges array<string>, filings struct<recent:struct<accessionNumber:array<string>,form:array<string>,filingDate:array<string>,reportDate:array<string>,primaryDocument:array<string>>>"
COMPANY_FACTS = "cik bigint, entityName string, facts map<string,map<string,struct<label:string,description:string,units:map<string,array<struct<`end`:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string>>>>>>"


def submissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUBMISSIONS).json(path, multiLine=True)


def arrays_to_rows(df: DataFrame, keys: list[str], arrays: dict[str, str]) -> DataFrame:
    """Parallel arrays to rows; where one is shorter its values are null."""
    zipped = F.arrays_zip(*[F.col(path).alias(name) for name, path in arrays.items()])
    return df.select(*keys, F.explode(zipped).alias("_z")).select(*keys, *[F.col(f"_z.{n}").alias(n) for n in arrays])


def filings_of(payload: DataFrame, forms: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Filings of submissions payloads, by form and inclusive date range."""
    recent = "filings.recent."
    rows = arrays_to_rows(payload.withColumn("ticker", F.try_element_at("tickers", F.lit(1))), ["cik", "ticker"], {"accession_number": recent + "accessionNumber", "filing_type": recent + "form", "filing_date": recent + "filingDate", "period_of_report": recent + "reportDate", "primary_document": recent + "primaryDocument"})
    if forms:
        rows = rows.filter(F.col("filing_type").isin(*forms))
    if start:
        rows = rows.filter(F.col("filing_date") >= start)
    return rows.filter(F.col("filing_date") <= end) if end else rows


def company_facts(spark: SparkSession, path: str) -> DataFrame:
    """(cik, fact_name, unit, period_end, fact_value, accession_number, form, filed) of company-facts payloads."""
    raw = spark.read.schema(COMPANY_FACTS).json(path, multiLine=True)
    one = raw.select("cik", F.explode("facts").alias("taxonomy", "concepts")).select("cik", "taxonomy", F.explode("concepts").alias("concept", "c"))
    two = one.select("cik", F.concat_ws(":", "taxonomy", "concept").alias("fact_name"), F.explode("c.units").alias("unit", "v")).select("cik", "fact_name", "unit", F.explode("v").alias("v"))
    return two.select("cik", "fact_name", "unit", F.col("v.end").cast("date").alias("period_end"), F.col("v.val").alias("fact_value"), F.col("v.accn").alias("accession_number"), "v.form", F.col("v.filed").cast("date").alias("filed"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, raw_html) of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("raw_html"))


def index_links(html: DataFrame, key: str, column: str) -> DataFrame:
    """Links inside an index page's tables, those to queries dropped."""
    tables = F.regexp_extract_all(F.col(column), F.lit(r"(?is)<table\b.*?</table>"), F.lit(0))
    links = F.flatten(F.transform(tables, lambda t: F.regexp_extract_all(t, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))))
    return html.select(key, F.explode(links).alias("href")).filter(~F.col("href").startswith("?"))


def search_url(base: str, query: str, form: str | None = None, start: str | None = None, end: str | None = None) -> str:
    """Where to ask for a full-text search: a phrase, a form, and a range of dates if both ends are named."""
    from urllib.parse import quote, urlencode

    asked = {"q": f'"{query}"'} | ({"forms": form} if form else {})
    if start and end:
        asked |= {"dateRange": "custom", "startdt": start, "enddt": end}
    return f"{base}?{urlencode(asked, quote_via=quote)}"


def search_hits(payload: DataFrame) -> DataFrame:
    """Accessions of full-text search hits (``_id``, ``_source``), the id itself where the source names none."""
    return payload.select(F.coalesce("_source.accession_no", F.substring_index("_id", ":", 1)).alias("accession_number"))


def resolved_ids(tickers: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ticker with its id, tickers without one), case folded on both sides."""
    a, b = tickers.withColumn("_t", F.upper("ticker")), known.select(F.upper("ticker").alias("_t"), "cik")
    return a.join(b, "_t").drop("_t"), a.join(b, "_t", "left_anti").drop("_t")


def fresh(cache: DataFrame, ttl_seconds: int, now) -> DataFrame:
    """Rows whose cached_at is younger than the limit."""
    return cache.filter(F.col("cached_at") > F.lit(now) - F.expr(f"interval {ttl_seconds} seconds"))


def pending(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Candidates that aren't completed."""
    return candidates.join(done.select(key), key, "left_anti")
