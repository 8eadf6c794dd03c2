"""A seeded corpus of well-formed annual filings, made of column expressions.

Every number is drawn from a hash of the seed, the company, what it is for and
the year, so any partitioning gives the same rows and no task needs another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PREFIX

#: Kinds of companies: net income and operating income by revenue, liabilities by assets, revenue by assets.
KINDS = (
    ("utility", 0.09, 0.17, 0.62, 0.32),
    ("grocery", 0.025, 0.04, 0.66, 2.4),
    ("machinery", 0.075, 0.11, 0.55, 0.85),
    ("pharma", 0.17, 0.24, 0.45, 0.5),
    ("shipping", 0.06, 0.1, 0.58, 0.65),
    ("startup", -0.2, -0.18, 0.3, 0.4),
)
_PAIRS = (("Revenues", "revenue", "USD", True), ("NetIncomeLoss", "net", "USD", True), ("OperatingIncomeLoss", "operating", "USD", True), ("Assets", "assets", "USD", False), ("Liabilities", "liabilities", "USD", False), ("EarningsPerShareBasic", "eps", "USD/shares", True), ("CommonStockSharesOutstanding", "shares", "shares", False))


def corpus(spark: SparkSession, companies: int = 120, years: int = 5, seed: int = 7, first_year: int = 2019) -> tuple[DataFrame, DataFrame]:
    """(facts, filings): a company's revenue grows by -6 to 14 % a year, its other figures follow its kind within a few percent."""
    if companies < 1 or years < 1:
        raise ValueError("companies and years must be 1 at least")

    def draw(what: str, *more: Column) -> Column:
        """Evenly from 0 to 1."""
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), F.col("id"), *more), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def around(middle: Column, what: str, width: float) -> Column:
        return middle + (2 * draw(what, F.col("y")) - 1) * width

    kind = F.element_at(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("name", "net", "operating", "lever", "turnover"), k, strict=True)]) for k in KINDS]), (F.col("id") % len(KINDS) + 1).cast("int"))
    growth = F.aggregate(F.sequence(F.lit(0), F.col("y")), F.lit(1.0), lambda total, y: total * (0.94 + 0.2 * draw("growth", y)))
    rows = spark.range(companies).select("id", kind.alias("k"), F.explode(F.sequence(F.lit(0), F.lit(years - 1))).alias("y"))
    rows = rows.withColumn("revenue", F.pow(F.lit(10.0), 7.5 + 3.5 * draw("size")) * growth)
    rows = rows.withColumns({"net": F.col("revenue") * around(F.col("k.net"), "net", 0.01), "operating": F.col("revenue") * around(F.col("k.operating"), "operating", 0.01), "assets": F.col("revenue") / (F.col("k.turnover") * around(F.lit(1.0), "turnover", 0.05)), "shares": F.pow(F.lit(10.0), 7 + 2 * draw("shares")) * (1 + 0.01 * F.col("y"))})
    rows = rows.withColumns({"liabilities": F.col("assets") * around(F.col("k.lever"), "lever", 0.03), "eps": F.col("net") / F.col("shares")})
    number = F.lpad((F.col("id") + 500_000).cast("string"), 10, "0")
    ends = F.make_date(F.lit(first_year) + F.col("y"), F.lit(12), F.lit(31))
    wide = rows.withColumns({"accession_number": F.concat_ws("-", number, F.lpad(((F.lit(first_year) + F.col("y")) % 100).cast("string"), 2, "0"), F.lpad((F.col("y") + 1).cast("string"), 6, "0")), "cik": (F.col("id") + 500_000).cast("string"), "ticker": F.concat(F.lit("Q"), F.lpad(F.col("id").cast("string"), 4, "0")), "period_of_report": ends, "filing_date": F.date_add(ends, (40 + 30 * draw("day", F.col("y"))).cast("int"))})
    listed = F.array(*[F.struct(F.lit(PREFIX + n).alias("fact_name"), F.col(c).alias("fact_value"), F.lit(u).alias("unit"), (F.trunc("period_of_report", "year") if lasts else F.lit(None).cast("date")).alias("period_start"), F.lit(i).alias("ord")) for i, (n, c, u, lasts) in enumerate(_PAIRS)])
    facts = wide.select("accession_number", F.col("period_of_report").alias("period_end"), F.inline(listed)).select("accession_number", "fact_name", "fact_value", "unit", "period_start", "period_end", F.lit(None).cast("string").alias("segment"), "ord")
    filings = wide.select("accession_number", "cik", "ticker", F.lit("10-K").alias("filing_type"), "filing_date", "period_of_report", F.col("k.name").alias("sector"))
    return facts, filings
