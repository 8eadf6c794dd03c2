"""Deterministic plausibility rules as column predicates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fixed_text, percent_text


@dataclass(frozen=True)
class Rule:
    """A rule fires where its predicate is true; a null predicate doesn't fire."""

    rule_id: str
    severity: float
    predicate: Column
    message: Column


def standard_rules() -> list[Rule]:
    """The ten rules in order."""
    c = F.col
    say = lambda pattern, *cols: F.format_string(pattern, *cols)
    wide = lambda x, most: F.abs(c(x)) > most
    jump = lambda x: (c(x) != 0) & (F.abs(c(x)) > 0.7)
    return [
        Rule("missing_required_fact", 0.95, c("required_coverage") < 1, say("%s of the required facts are present", percent_text(c("required_coverage")))),
        Rule("eps_reconciliation_failed", 0.95, wide("eps_consistency", 0.25), say("net income and shares miss reported EPS by %s", percent_text(c("eps_consistency"), 1, plus=True))),
        Rule("non_positive_scale", 0.90, (c("log_assets") <= 0) | (c("log_revenue") <= 0), say("scale is not positive: assets %s, revenue %s (log10)", fixed_text(c("log_assets"), 2), fixed_text(c("log_revenue"), 2))),
        Rule("implausible_leverage", 0.90, (c("leverage") < 0) | (c("leverage") > 1.5), say("liabilities are %s of assets", fixed_text(c("leverage"), 2))),
        Rule("implausible_net_margin", 0.85, wide("net_margin", 1.5), say("net margin %s", fixed_text(c("net_margin"), 2))),
        Rule("implausible_operating_margin", 0.85, wide("operating_margin", 1.5), say("operating margin %s", fixed_text(c("operating_margin"), 2))),
        Rule("implausible_asset_turnover", 0.85, (c("asset_turnover") < 0) | (c("asset_turnover") > 5), say("asset turnover %s", fixed_text(c("asset_turnover"), 2))),
        Rule("revenue_discontinuity", 0.80, jump("revenue_yoy"), say("revenue is %s times the year before", fixed_text(F.pow(F.lit(10.0), c("revenue_yoy")), 1))),
        Rule("assets_discontinuity", 0.80, jump("assets_yoy"), say("assets are %s times the year before", fixed_text(F.pow(F.lit(10.0), c("assets_yoy")), 1))),
        Rule("incomplete_fact_set", 0.50, c("fact_coverage") < 1, say("%s of the expected facts are present", percent_text(c("fact_coverage")))),
    ]


def evaluate(features: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``features`` with violations (by falling severity, then rule order) and rule_score, their largest severity."""
    rules = standard_rules() if rules is None else rules
    if not rules:
        return features.withColumn("violations", F.array().cast("array<struct<rule_id:string,severity:double,message:string>>")).withColumn("rule_score", F.lit(0.0))
    ranked = sorted(enumerate(rules), key=lambda r: (-r[1].severity, r[0]))
    made = F.array(*[F.when(F.coalesce(r.predicate, F.lit(False)), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), r.message.alias("message"))) for _, r in ranked])
    out = features.withColumn("violations", F.array_compact(made))
    return out.withColumn("rule_score", F.coalesce(F.array_max(F.transform("violations", lambda v: v["severity"])), F.lit(0.0)))
