"""Hybrid anomaly detection: isolation forest and rules, pinned scores, evaluation, drift report and gate."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CONTAMINATION, FEATURES, FLOORS, MAX_FLAG_RATE, REGRESSION_TOLERANCE, SEED, THRESHOLD, TOP_CONTRIBUTORS, TREES
from . import quality, rules
from .forest import Forest
from .ranks import running_total


def normalised(decision: Column, low: float, cut: float, high: float) -> Column:
    """1 at the lowest training decision, 0.6 at the contamination quantile, 0 at the highest; linear between, clipped."""
    span = lambda a, b: F.lit(float(b - a) if b > a else 1.0)
    below = THRESHOLD + (1 - THRESHOLD) * (cut - decision) / span(low, cut)
    above = THRESHOLD * (high - decision) / span(cut, high)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(decision <= cut, below).otherwise(above)))


def triggered_by(model: Column, rule: Column) -> Column:
    """What the blended score comes from; without a signal it is the model."""
    return F.when((model == 0) & (rule == 0), "model").when(rule > model, "rule").when(rule < model, "model").otherwise("both")


def contributors(features: tuple[str, ...], means: dict[str, float], stds: dict[str, float], top: int = TOP_CONTRIBUTORS) -> Column:
    """The features with the largest |z|, those with z = 0 left out; a deviation of 0 counts as 1."""
    z = [F.struct((F.abs(v)).alias("size"), F.lit(-i).alias("at"), F.lit(f).alias("feature"), v.alias("z")) for i, f in enumerate(features) for v in [(F.col(f) - means[f]) / (stds[f] or 1.0)]]
    ranked = F.slice(F.sort_array(F.filter(F.array(*z), lambda s: s["size"] > 0), False), 1, top)
    return F.transform(ranked, lambda s: F.struct(s["feature"].alias("feature"), s["z"].alias("z")))


def exact_quantile(rows: DataFrame, column: str, q: float, most: int = 100_000) -> float:
    """The q-quantile of all values, linear between ranks; sketches narrow the range until about ``most`` rows are left."""
    rows = rows.select(F.col(column).alias("v"))
    n = rows.count()
    at, skipped = q * (n - 1), 0
    low, high = int(np.floor(at)), int(np.ceil(at))
    while n > most:
        shares = [max(0.0, (low - skipped) / n - 1e-3), min(1.0, (high + 1 - skipped) / n + 1e-3)]
        a, b = rows.agg(F.percentile_approx("v", shares, 10_000)).first()[0]
        below, inside = rows.agg(F.count_if(F.col("v") < a), F.count_if(F.col("v").between(a, b))).first()
        if inside == n:
            break
        rows, n, skipped = rows.filter(F.col("v").between(a, b)), inside, skipped + below
    held = rows.groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect()
    ends = skipped + np.cumsum([r["n"] for r in held])
    x, y = (held[int(np.searchsorted(ends, k, "right"))]["v"] for k in (low, high))
    return float(x + (y - x) * (at - low))


@dataclass
class Detector:
    """Trees grow from a bounded sample of rows on the driver; marks, means and deviations are of all rows; scoring is distributed."""

    features: tuple[str, ...] = FEATURES
    contamination: float = CONTAMINATION
    threshold: float = THRESHOLD
    trees: int = TREES
    seed: int = SEED
    sample: int = 100_000
    forest: Forest | None = None
    marks: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    def fit(self, matrix: DataFrame, key: str = "accession_number") -> Detector:
        """``sample`` bounds the rows that trees grow from; they are chosen by a hash of the key and sorted by it."""
        n = matrix.count()
        share = 1 << 20 if n <= self.sample else self.sample * (1 << 20) // n
        some = matrix.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < share).select(key, *self.features).toPandas().sort_values(key)
        self.forest = Forest.fit(some[list(self.features)].to_numpy(float), self.trees, seed=self.seed)
        whole = matrix.select(*[F.col(c).cast("double").alias(c) for c in self.features])
        s = whole.agg(*[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(self.features) for f in (F.avg, F.stddev_pop)]).first()
        self.means, self.stds = ({c: s[f"{f}_{i}"] for i, c in enumerate(self.features)} for f in ("avg", "stddev_pop"))
        d = whole.select(self._decision().alias("d")).persist()
        low, high = d.agg(F.min("d"), F.max("d")).first()
        self.marks = {"low": low, "cut": exact_quantile(d, "d", self.contamination), "high": high}
        d.unpersist()
        return self

    def _decision(self) -> Column:
        forest = self.forest

        @F.pandas_udf("double")
        def decide(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(forest.decision(np.column_stack([s.to_numpy(float) for s in part])))

        return decide(*[F.col(c) for c in self.features])

    def score(self, matrix: DataFrame, rule_set: list[rules.Rule] | None = None) -> DataFrame:
        """``matrix`` with raw_decision, model_score, rule_score, score, is_anomaly, triggered_by, violations, top_contributors."""
        out = rules.evaluate(matrix, rule_set).withColumn("raw_decision", self._decision())
        out = out.withColumn("model_score", normalised(F.col("raw_decision"), **self.marks)).withColumn("score", F.greatest("model_score", "rule_score"))
        out = out.withColumn("is_anomaly", F.col("score") >= self.threshold).withColumn("triggered_by", triggered_by(F.col("model_score"), F.col("rule_score")))
        return out.withColumn("top_contributors", contributors(self.features, self.means, self.stds))

    def to_json(self) -> str:
        trees = [[a.tolist() for a in t] for t in self.forest.trees]
        return json.dumps({"features": self.features, "contamination": self.contamination, "threshold": self.threshold, "trees": self.trees, "seed": self.seed, "marks": self.marks, "means": self.means, "stds": self.stds, "sample": self.forest.sample, "forest": trees}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Detector:
        d = json.loads(text)
        forest = Forest([tuple(np.array(a) for a in t) for t in d.pop("forest")], d.pop("sample"))
        return cls(**d | {"features": tuple(d["features"])}, forest=forest)


def explain(threshold: float = THRESHOLD) -> Column:
    """One sentence on a score row."""
    named = F.array_join(F.transform("top_contributors", lambda c: F.format_string("%s (z=%+.2f)", c["feature"], c["z"])), ", ")
    said = F.array_join(F.transform("violations", lambda v: v["message"]), "; ")
    return F.format_string("score %.3f by %s; %s; %s", F.col("score"), F.col("triggered_by"), F.coalesce(F.nullif(said, F.lit("")), F.lit("no rule")), named)


def roc_auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """(roc_auc): rank sum with average ties over counts per distinct score; 0.5 with one class only."""
    per = rows.groupBy(score).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("p"))
    ranked = running_total(per, [], score, "n", "upto")
    s = ranked.withColumn("rank", F.col("upto") - F.col("n") + (F.col("n") + 1) / 2.0).agg(F.sum(F.col("rank") * F.col("p")).alias("r"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, q = F.col("p").cast("double"), (F.col("n") - F.col("p")).cast("double")
    return s.select(F.coalesce(F.try_divide(F.col("r") - p * (p + 1) / 2.0, p * q), F.lit(0.5)).alias("roc_auc"))


def confusion(rows: DataFrame, label: str, flag: str) -> DataFrame:
    """tp, fp, fn, tn, recall, precision, f1, flag_rate of one pass; a ratio without cases is 0."""
    hit, said = F.col(label) == 1, F.col(flag)
    s = rows.agg(F.count_if(hit & said).alias("tp"), F.count_if(~hit & said).alias("fp"), F.count_if(hit & ~said).alias("fn"), F.count_if(~hit & ~said).alias("tn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = F.col
    out = s.withColumn("recall", ratio(c("tp"), c("tp") + c("fn"))).withColumn("precision", ratio(c("tp"), c("tp") + c("fp")))
    return out.withColumn("f1", ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn"))).withColumn("flag_rate", ratio(c("tp") + c("fp"), c("tp") + c("fp") + c("fn") + c("tn")))


# Kinds of corruption, the concepts they hit, and their factors.
KINDS = ("scale", "sign", "drop", "eps")
TARGETS = ("Revenues", "NetIncomeLoss", "OperatingIncomeLoss", "Assets", "Liabilities")
FACTORS = {"scale": (1e-6, 1e-3, 1e3, 1e6), "sign": (-1.0,), "drop": (0.0,), "eps": (50.0, 100.0, 0.01)}


def corruption(accession: Column, rate: float, seed: int) -> Column:
    """(kind, fact_name, factor) of a filing's corruption, null for a filing left alone: drawn from hashes of its number.

    A filing's lot depends on its number and the seed alone, so no list of filings is gathered anywhere.
    """
    if not 0 < rate < 1:
        raise ValueError(f"rate {rate} is not between 0 and 1")
    draw = lambda salt, n: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), accession), F.lit(n)).cast("int")
    pick = lambda salt, values: F.element_at(F.array(*[F.lit(v) for v in values]), draw(salt, len(values)) + 1)
    kind = pick("kind", KINDS)
    concept = F.when(kind == "eps", "EarningsPerShareBasic").otherwise(pick("concept", TARGETS))
    factor = F.coalesce(*[F.when(kind == k, pick("factor", v)) for k, v in FACTORS.items()])
    hit = accession.isNotNull() & (draw("filing", 1 << 20) < int(rate * (1 << 20)))
    return F.when(hit, F.struct(kind.alias("kind"), F.concat(F.lit("us-gaap:"), concept).alias("fact_name"), factor.alias("factor")))


def with_corruption(facts: DataFrame, rate: float = 0.2, seed: int = 7) -> DataFrame:
    """Facts with one scale error, sign flip, dropped fact or EPS mismatch in about ``rate`` of the filings, values as double."""
    own = corruption(F.col("accession_number"), rate, seed)
    tagged = facts.withColumn("_edit", F.when(own["fact_name"] == F.col("fact_name"), own))
    value = F.col("fact_value").cast("double") * F.coalesce("_edit.factor", F.lit(1.0))
    return tagged.filter("_edit is null or _edit.kind <> 'drop'").withColumn("fact_value", value).select(*facts.columns)


def corrupted(facts: DataFrame, rate: float = 0.2, seed: int = 7) -> tuple[DataFrame, list[str]]:
    """:func:`with_corruption`, and the filings that it hit: for evaluation corpora, whose filings the driver can hold."""
    hit = facts.select("accession_number").filter(corruption(F.col("accession_number"), rate, seed).isNotNull()).distinct()
    return with_corruption(facts, rate, seed), sorted(r[0] for r in hit.collect())


def holdout(filings: DataFrame, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, held out) by a seeded hash of the key: the same filing falls on the same side in every run."""
    here = F.pmod(F.xxhash64(F.lit(seed), "accession_number"), F.lit(1 << 20)) < int(fraction * (1 << 20))
    return filings.filter(~here), filings.filter(here)


def drift_report(features: DataFrame, prediction: DataFrame | None = None) -> dict:
    """Worst level, drifted features by falling PSI, and whether all is well."""
    rows = [r.asDict() for r in features.collect()]
    drifted = sorted((r for r in rows if r["is_actionable"]), key=lambda r: (-r["psi"], r["feature"]))
    rank = {"OK": 0, "WARN": 1, "ALERT": 2}
    levels = [r["level"] for r in drifted]
    out = {"features": rows, "drifted": [r["feature"] for r in drifted]}
    if prediction is not None:
        out["prediction"] = prediction.first().asDict()
        levels.append(out["prediction"]["level"])
    out["level"] = max(levels, key=rank.get, default="OK")
    out["passed"] = out["level"] != "ALERT" and not out.get("prediction", {}).get("flag_rate_anomalous", False)
    return out


def gate(metrics: dict[str, float], before: dict[str, float] | None = None) -> list[str]:
    """Why a model may not ship: floors, flag rate, and what it loses against the one before."""
    why = [f"{k} {metrics[k]:.3f} is below {floor}" for k, floor in FLOORS.items() if metrics[k] < floor]
    if metrics["flag_rate"] > MAX_FLAG_RATE:
        why.append(f"flag_rate {metrics['flag_rate']:.3f} is above {MAX_FLAG_RATE}")
    return why + [f"{k} fell by {before[k] - metrics[k]:.3f}" for k in FLOORS if before and before[k] - metrics[k] > REGRESSION_TOLERANCE]


def evaluated(rows: DataFrame, label: str, score: str, flag: str, rate: float, threshold: float = THRESHOLD, seed: int = SEED) -> DataFrame:
    """One row: the counts and ratios of :func:`confusion`, the AUC, both classes' mean scores, and what the figures were made with."""
    means = rows.agg(*[F.coalesce(F.avg(F.when((F.col(label) == 1) == F.lit(c), F.col(score))), F.lit(0.0)).alias(n) for n, c in (("mean_score_corrupted", True), ("mean_score_clean", False))])
    one = confusion(rows, label, flag).crossJoin(roc_auc(rows, label, score)).crossJoin(means)
    return one.withColumns({"corruption_rate": F.lit(rate), "threshold": F.lit(threshold), "seed": F.lit(seed)})


def by_score(scored: DataFrame) -> DataFrame:
    """Score rows, highest first; equal scores by accession."""
    return scored.orderBy(F.col("score").desc(), "accession_number")


def flagged(scored: DataFrame) -> DataFrame:
    """(scored, flagged, violating): how many filings there are, are anomalies, break a rule."""
    return scored.agg(F.count("*").alias("scored"), F.count_if("is_anomaly").alias("flagged"), F.count_if(F.size("violations") > 0).alias("violating"))


def nonzero_shares(matrix: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(feature, share): the share of rows in which a feature isn't 0; no rows give no shares."""
    one = matrix.agg(*[F.avg((F.col(c) != 0).cast("double")).alias(c) for c in features])
    return one.unpivot([], list(features), "feature", "share").filter("share is not null")


def psi_of_scores(baseline: DataFrame, current: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    both = baseline.select(F.col("score").alias("value"), F.lit(True).alias("is_base")).unionByName(current.select(F.col("score").alias("value"), F.lit(False).alias("is_base")))
    return quality.prediction_drift(both, threshold)
