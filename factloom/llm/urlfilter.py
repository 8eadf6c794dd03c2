"""URL filtering by association rules, in DataFrame operations alone.

Stated (host, path) rules come first; the longest that fits decides.  For
other urls, FP-growth mines token combinations that go with a label; rules
pruned by confidence, support and redundancy are matched by an inverted index
from tokens to rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host/path, verdict)
STATED = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@dataclass(frozen=True)
class Mining:
    """support, confidence: least of a mined rule; few: rules up to which the index is broadcast;
    otherwise: the verdict where no rule matches.
    """

    support: float = 0.005
    confidence: float = 0.8
    few: int = 20_000
    otherwise: str = "allow"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: str = "url") -> Column:
    """After the first ``://`` up to / ? # or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(F.col(url)), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: str = "url") -> Column:
    """After the host up to ? # or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(_rest(F.col(url)), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str) -> Column:
    name, _, rest = rule.partition("/")
    return ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith("/" + rest)


def stated(rules: tuple[tuple[str, str], ...] = STATED) -> tuple[Column, Column]:
    """(rule, verdict) of the longest stated rule that fits host and path, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule, verdict = F.when(_fits(text), F.lit(text)).otherwise(rule), F.when(_fits(text), F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens() -> Column:
    """Distinct tokens of a url: its domain's last one and two labels, each other label, path steps but numbers, query keys."""
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    n = F.size(labels)
    tail = F.when(n >= 1, F.array(F.concat(F.lit("top:"), F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>"))
    pair = F.when(n >= 2, F.array(F.concat(F.lit("site:"), F.element_at(labels, F.when(n >= 2, -2).otherwise(-1)), F.lit("."), F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>"))
    other = F.transform(F.slice(labels, 1, F.greatest(n - 2, F.lit(0))), lambda x: F.concat(F.lit("name:"), x))
    steps = F.filter(F.split("path", "/"), lambda x: (x != "") & ~x.rlike(r"^[0-9]"))
    keys = F.filter(F.transform(F.split(F.regexp_extract(F.coalesce("url", F.lit("")), r"\?([^#]*)", 1), "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    return F.array_distinct(F.concat(tail, pair, other, F.transform(steps, lambda x: F.concat(F.lit("step:"), x)), F.transform(keys, lambda x: F.concat(F.lit("key:"), x))))


def mine(labelled: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """(rule_id, items, label, confidence, support) from rows of items (array of tokens) and label.

    A rule is dropped if a rule with fewer of the same tokens says the same
    with at least its confidence.  No labelled rows: no rules.
    """
    mark = "label="
    if labelled.isEmpty():
        empty = labelled.select(F.lit("").alias("rule_id"), "items", "label", F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support"))
        return empty.filter(F.lit(False))
    rows = labelled.select(F.array_append("items", F.concat(F.lit(mark), "label")).alias("items"))
    rules = FPGrowth(itemsCol="items", minSupport=conf.support, minConfidence=conf.confidence).fit(rows).associationRules
    rules = rules.filter(F.element_at("consequent", 1).startswith(mark) & ~F.exists("antecedent", lambda x: x.startswith(mark)))
    label = F.expr(f"substring(element_at(consequent, 1), {len(mark) + 1})")
    kept = rules.select(F.array_sort("antecedent").alias("items"), label.alias("label"), "confidence", "support")
    return _irredundant(kept.withColumn("rule_id", F.array_join("items", " ")))


def _irredundant(rules: DataFrame) -> DataFrame:
    """Drop rules that a shorter one covers: each rule meets its sub-rules through their tokens."""
    posting = rules.select(F.col("rule_id").alias("sub"), F.col("label").alias("sub_label"), F.col("confidence").alias("sub_confidence"), F.size("items").alias("sub_size"), F.explode("items").alias("token"))
    hits = rules.select("rule_id", "label", "confidence", F.size("items").alias("size"), F.explode("items").alias("token")).join(posting, "token")
    covered = hits.filter((F.col("sub_size") < F.col("size")) & (F.col("sub_label") == F.col("label")) & (F.col("sub_confidence") >= F.col("confidence")))
    covered = covered.groupBy("rule_id", "label", "sub", "sub_size").agg(F.count("*").alias("n")).filter(F.col("n") == F.col("sub_size")).select("rule_id", "label").distinct()
    return rules.join(covered, ["rule_id", "label"], "left_anti")


def match(items: DataFrame, rules: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """(key, mined_rule, mined_verdict) of each key of ``items`` (key, items) that a rule fits.

    The index lists each token's rules; a rule fits when all its tokens are
    hit.  The most confident fitting rule decides, then the longer, then block.
    """
    index = rules.select(F.explode("items").alias("token"), F.struct("rule_id", "label", "confidence", F.size("items").alias("size")).alias("rule"))
    if rules.count() <= conf.few:
        index = F.broadcast(index)
    hits = items.select("key", F.explode("items").alias("token")).join(index, "token").groupBy("key", "rule").agg(F.count("*").alias("n"))
    fits = hits.filter(F.col("n") == F.col("rule.size"))
    best = fits.groupBy("key").agg(F.max_by("rule", F.struct("rule.confidence", "rule.size", "rule.label", "rule.rule_id")).alias("rule"))
    return best.select("key", F.col("rule.rule_id").alias("mined_rule"), F.col("rule.label").alias("mined_verdict"))


def judge(pages: DataFrame, labels: DataFrame, conf: Mining = Mining(), rules: tuple[tuple[str, str], ...] = STATED) -> DataFrame:
    """Every row of ``pages`` (page_id, url) with host, path, rule, verdict and mined_rule.

    Rules are mined from the pages that a stated rule decides, with its verdict
    as label, and from others that ``labels`` (page_id, label) names.  A null
    url, or one without ``://``, has empty host and path and takes
    ``conf.otherwise``.  Null ids match no label; of labels that disagree on a
    page, the last by name counts, block before allow.  Repeated rows get equal
    results, rows with one id are judged by their own url; urls of any length
    are read whole, further columns not at all.  An empty table gives no rows.
    """
    rule, verdict = stated(rules)
    base = pages.select(pages["page_id"], pages["url"]).withColumn("host", host()).withColumn("path", path()).withColumn("rule", rule).withColumn("stated", verdict)
    base = base.withColumn("items", tokens()).withColumn("key", F.xxhash64("host", F.array_join("items", " ")))
    # Mining, matching and the verdicts read what was made of the urls once.
    base = shared.stored(base.drop("url"), "urls")
    named = labels.select(F.col("page_id").alias("_id"), F.col("label").alias("_label")).filter("_label is not null").groupBy("_id").agg(F.max("_label").alias("_label"))
    known = base.join(named, F.col("page_id") == F.col("_id"), "left").select("items", F.coalesce("stated", "_label").alias("label")).filter("label is not null and size(items) > 0")
    mined = mine(known, conf)
    # Pages with the same tokens are matched once.
    found = match(base.filter("rule is null").select("key", "items").dropDuplicates(["key"]), mined, conf)
    out = base.join(found.withColumnRenamed("key", "_key"), F.col("rule").isNull() & (F.col("key") == F.col("_key")), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("stated", "mined_verdict", F.lit(conf.otherwise)).alias("verdict"), "mined_rule")
