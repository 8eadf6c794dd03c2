"""Registered queries of the analytics operators, each with its SQL counterpart where SQL can say it.

The driver's tables stand in for the domain's: customers are companies, orders
are filings, line items are facts, return flags are concepts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import audit, chunks, detector, facts, features, marts, merge, metrics, nearest, quality, ranks, retrieve, rules, runs, serve
from ..schema import GROUNDING_FLOOR
from ..sources import ixbrl, payloads, synthetic, warehouse
from ..storage import path
from ..streaming import ingest
from . import batch

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(c: str):
    return F.col(c).cast("decimal(18,2)")


_MART_ROWS = "select o_custkey as cik, year(o_orderdate) as fiscal_year, l_returnflag as concept, cast(l_extendedprice as decimal(18,2)) as amount from lineitem join orders on l_orderkey = o_orderkey"
_MART_SQL = f"select cik, fiscal_year, max(case when concept in ('A') then amount end) as revenue, max(case when concept in ('N') then amount end) as net_income, max(case when concept in ('R') then amount end) as total_assets from ({_MART_ROWS}) group by cik, fiscal_year"


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("fiscal_year"))
    rows = li.join(orders, "l_orderkey").withColumn("amount", _money("l_extendedprice"))
    return marts.pivot(rows, ["cik", "fiscal_year"], "l_returnflag", "amount", {"revenue": ("A",), "net_income": ("N",), "total_assets": ("R",)})


@query(_MART_SQL)
def mart_pivot(spark, sf_dir):
    return _mart(spark, sf_dir)


@query(f"""
with m as ({_MART_SQL}),
y as (select *, lag(revenue) over (partition by cik order by fiscal_year) as prior_year_revenue, lag(net_income) over (partition by cik order by fiscal_year) as prior_year_net_income from m),
g as (select *, {", ".join(f"cast((({x} - prior_year_{x}) * 100)::decimal(38,0) as hugeint) as n_{x}, cast((prior_year_{x} * 100)::decimal(38,0) as hugeint) as d_{x}" for x in ("revenue", "net_income"))} from y)
select cik, fiscal_year, revenue, net_income, total_assets, prior_year_revenue, prior_year_net_income,
  {", ".join(f"case when d_{x} <> 0 then (sign(n_{x}) * sign(d_{x}) * ((abs(n_{x}) * 20000 + abs(d_{x})) // (2 * abs(d_{x})))::decimal(20,0) / 100)::double end as {x}_yoy_growth_pct" for x in ("revenue", "net_income"))} from g""")
def mart_yoy(spark, sf_dir):
    """The change to two places, of two equally near the one further from 0; here as double."""
    out = marts.year_over_year(_mart(spark, sf_dir))
    return out.withColumns({f"{m}_yoy_growth_pct": F.col(f"{m}_yoy_growth_pct").cast("double") for m in ("revenue", "net_income")})


@query("select l_orderkey, l_linenumber, cast(l_shipdate as date) as period_end, l_returnflag, cast(l_extendedprice as decimal(18,2)) as fact_value from lineitem join orders on l_orderkey = o_orderkey where o_custkey = 7 and l_linestatus = 'O' order by period_end, l_orderkey, l_linenumber limit 20 offset 5")
def timeseries_page(spark, sf_dir):
    facts = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession_number"), F.col("l_linenumber").alias("ord"), "l_linestatus", F.col("l_shipdate").cast("date").alias("period_end"), F.col("l_returnflag").alias("flag"), _money("l_extendedprice").alias("fact_value"), F.lit(None).cast("string").alias("segment")).withColumnRenamed("l_linestatus", "fact_name")
    filings = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession_number"), F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").alias("filing_date"))
    out = serve.time_series(facts, filings, "7", "O", None, 20, 5)
    return out.select(F.col("accession_number").alias("l_orderkey"), F.col("ord").alias("l_linenumber"), "period_end", F.col("flag").alias("l_returnflag"), "fact_value")


@query("select o_orderkey, o_orderstatus, o_orderdate, count(*) over () as total from orders where o_custkey = 7 order by o_orderdate desc, o_orderkey limit 10")
def filings_page(spark, sf_dir):
    filings = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession_number"), F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").alias("filing_date"), "o_orderstatus", F.lit("").alias("raw_html"))
    out = serve.filings_page(filings, "7", 10)
    return out.select(F.col("accession_number").alias("o_orderkey"), "o_orderstatus", F.col("filing_date").alias("o_orderdate"), "total")


@query("select l_linenumber, l_returnflag, l_quantity, l_shipdate from lineitem where l_orderkey = 33")
def facts_of_filing(spark, sf_dir):
    facts = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession_number"), F.col("l_linenumber").alias("ord"), F.col("l_returnflag").alias("fact_name"), "l_quantity", F.col("l_shipdate").alias("period_end"))
    filings = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession_number"))
    out = serve.facts_of_filing(facts, 33, filings)
    return out.select(F.col("ord").alias("l_linenumber"), F.col("fact_name").alias("l_returnflag"), "l_quantity", F.col("period_end").alias("l_shipdate"))


_LATEST = "select * from (select *, row_number() over (partition by user_id order by event_id desc) as n from events) where n = 1"


@query(f"select e.user_id, e.event_id, e.event_type, e.value, c_mktsegment from ({_LATEST}) e join customer on user_id = c_custkey where value >= 50 order by value desc, event_id limit 50")
def latest_score_queue(spark, sf_dir):
    latest = serve.latest_scores(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id").filter("value >= 50")
    joined = latest.join(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment"), "user_id")
    return serve.page(joined, [F.col("value").desc(), "event_id"], 50, 0)


@query("select user_id, event_id, event_type from events where event_id in (select max(event_id) from events group by user_id)")
def latest_semi_join(spark, sf_dir):
    return serve.latest_by_id(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("select event_id, ts, event_type from events where user_id = 11 order by event_id desc limit 25")
def audit_history(spark, sf_dir):
    log = _t(spark, sf_dir, "events").select(F.col("user_id").alias("accession_number"), F.col("event_id").alias("id"), "ts", "event_type")
    return serve.audit_history(log, 11, 25).select(F.col("id").alias("event_id"), "ts", "event_type")


_NEED = "select l_orderkey, max(case when l_returnflag = 'A' then 1 end) as a, max(case when l_returnflag = 'N' then 1 end) as n, max(case when l_returnflag = 'R' then 1 end) as r from lineitem group by l_orderkey"


def _complete(spark, sf_dir):
    return quality.completeness(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", ["A", "N", "R"])


@query(f"select l_orderkey, concat_ws(',', case when a is null then 'A' end, case when n is null then 'N' end, case when r is null then 'R' end) as missing, a is not null and n is not null and r is not null as is_complete from ({_NEED})")
def completeness(spark, sf_dir):
    return _complete(spark, sf_dir).withColumn("missing", F.array_join("missing", ","))


@query(f"select count(*) as total, count(*) filter (a is not null and n is not null and r is not null) as complete, count(*) filter (a is not null and n is not null and r is not null)::double / count(*) as ratio, count(*) filter (a is not null and n is not null and r is not null)::double / count(*) >= 0.95 as passed from ({_NEED})")
def completeness_summary(spark, sf_dir):
    return quality.completeness_summary(_complete(spark, sf_dir), 0.95)


_PSI_IN = "select value, ts < timestamp '2024-01-16' as is_base from events"


def _halves(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("value", (F.col("ts") < F.lit("2024-01-16").cast("timestamp")).alias("is_base"))


def _psi_sql(rows: str, edges: str, by: str = "") -> str:
    on, comma = (f"using ({by})", f"{by},") if by else ("on true", "")
    group = f"group by {by}" if by else ""
    return f"""
with v as ({rows}), e as ({edges}),
t as (select {comma} count(*) filter (is_base) as baseline_count, count(*) filter (not is_base) as current_count from v {group}),
b as (select {comma} len(list_filter(list_slice(edges, 2, len(edges) - 1), lambda x: value >= x)) as bin, count(*) filter (is_base) as b, count(*) filter (not is_base) as c from v join e {on} group by {comma} bin)
select {comma} round(sum((greatest(c::double / current_count, 1e-4) - greatest(b::double / baseline_count, 1e-4)) * ln(greatest(c::double / current_count, 1e-4) / greatest(b::double / baseline_count, 1e-4))), 9) as psi,
  any_value(baseline_count) as baseline_count, any_value(current_count) as current_count,
  case when round(sum((greatest(c::double / current_count, 1e-4) - greatest(b::double / baseline_count, 1e-4)) * ln(greatest(c::double / current_count, 1e-4) / greatest(b::double / baseline_count, 1e-4))), 9) >= 0.25 then 'ALERT'
   when round(sum((greatest(c::double / current_count, 1e-4) - greatest(b::double / baseline_count, 1e-4)) * ln(greatest(c::double / current_count, 1e-4) / greatest(b::double / baseline_count, 1e-4))), 9) >= 0.1 then 'WARN' else 'OK' end as level
from b join t {on} {group}"""


_UNIFORM = "select list_transform(range(0, 11), lambda i: case when i = 10 then hi + 1e-9 else lo + i * ((hi - lo) / 10) end) as edges from (select min(value) as lo, max(value) as hi from v)"
_QUANTILE = "select {by} list_concat([-'inf'::double], list_slice(e, 2, len(e) - 1), ['inf'::double]) as edges from (select {by} list_sort(list_distinct(list_transform(range(0, 11), lambda q: a[least(round_even(q * len(a) / 10.0, 0)::bigint, len(a) - 1) + 1]))) as e from (select {by} list(value order by value) as a from v where is_base {group}))"


@query(_psi_sql(_PSI_IN, _UNIFORM))
def psi_uniform(spark, sf_dir):
    return quality.psi(_halves(spark, sf_dir), [], strategy="uniform")


@query(_psi_sql(_PSI_IN, _QUANTILE.format(by="", group="")))
def psi_quantile(spark, sf_dir):
    return quality.psi(_halves(spark, sf_dir), [], strategy="quantile")


_LONG = "select feature, value, is_base from (select year(l_shipdate) < 1998 as is_base, l_quantity, l_discount, l_tax, l_extendedprice from lineitem) unpivot (value for feature in (l_quantity, l_discount, l_tax, l_extendedprice))"


@query(_psi_sql(_LONG, _QUANTILE.format(by="feature,", group="group by feature"), "feature"))
def psi_by_feature(spark, sf_dir):
    names = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    li = _t(spark, sf_dir, "lineitem").withColumn("early", F.year("l_shipdate") < 1998)
    return quality.feature_drift(li.filter("early"), li.filter("not early"), names).select("feature", "psi", "baseline_count", "current_count", "level")


@query("select round(avg(case when is_base then (value >= 60)::int end), 9) as baseline_flag_rate, round(avg(case when not is_base then (value >= 60)::int end), 9) as current_flag_rate from (" + _PSI_IN + ")")
def prediction_drift(spark, sf_dir):
    out = quality.prediction_drift(_halves(spark, sf_dir), 60.0)
    return out.select(F.round("baseline_flag_rate", 9).alias("baseline_flag_rate"), F.round("current_flag_rate", 9).alias("current_flag_rate"))


@query("select l_orderkey, l_returnflag, l_linenumber, l_quantity, l_shipdate from (select *, row_number() over (partition by l_orderkey, l_returnflag order by l_shipdate::date desc nulls last, l_linenumber, l_quantity, l_shipdate) as n from lineitem) where n = 1")
def fact_latest_period(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_quantity", "l_shipdate")
    return facts.latest_period(li, ["l_orderkey", "l_returnflag"], "l_shipdate", "l_linenumber")


@query("select o_custkey, o_orderstatus, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey, o_orderstatus order by (o_orderpriority like '1%') desc, case when o_orderpriority like '1%' then -o_orderkey else o_orderkey end) as n from orders) where n = 1")
def supersession(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", F.col("o_orderpriority").startswith("1").alias("is_latest"))
    return facts.superseded(o, ["o_custkey", "o_orderstatus"], "is_latest", "o_orderkey").drop("is_latest")


@query("select o_orderkey, coalesce(max(case when date_diff('day', o_orderdate::date, l_shipdate::date) >= 0 then date_diff('day', o_orderdate::date, l_shipdate::date) end), 0)::int as period_days from lineitem join orders on l_orderkey = o_orderkey group by o_orderkey")
def period_length(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate").join(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return facts.period_days(rows, "o_orderkey", "o_orderdate", "l_shipdate")


_RATIO = "case when {a} is null or {b} is null or {b} = 0 then 0.0 else greatest(-10.0, least(10.0, {a}::double / {b}::double)) end"


@query("select c_custkey, round(" + _RATIO.format(a="c_acctbal", b="(c_nationkey - 5)") + ", 9) as ratio, round(coalesce(sign(c_acctbal) * log10(1 + abs(c_acctbal)), 0), 9)::double as signed_log from customer")
def safe_ratio_signed_log(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", F.round(S.safe_ratio(F.col("c_acctbal"), F.col("c_nationkey") - 5), 9).alias("ratio"), F.round(S.signed_log(F.col("c_acctbal")), 9).alias("signed_log"))


@query("select o_orderkey, lag(o_orderkey) over w as prior_orderkey, lag(o_totalprice) over w as prior_price from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)")
def prior_filing(spark, sf_dir):
    prior = features.with_prior(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"], "p")
    return prior.select("o_orderkey", F.col("p.o_orderkey").alias("prior_orderkey"), F.col("p.o_totalprice").alias("prior_price"))


@query(f"select l_orderkey, (coalesce(a, 0) + coalesce(n, 0) + coalesce(r, 0)) / 3.0::double as coverage from ({_NEED})")
def coverage(spark, sf_dir):
    flags = marts.pivot(_t(spark, sf_dir, "lineitem").withColumn("one", F.lit(1)), ["l_orderkey"], "l_returnflag", "one", {"a": ("A",), "n": ("N",), "r": ("R",)})
    return flags.select("l_orderkey", features.coverage(("a", "n", "r")).alias("coverage"))


_FEATS = "select c_custkey, (c_acctbal - 3000) / 1000 as leverage, (c_acctbal - 5000) / 2000 as net_margin, c_nationkey / 20.0::double as required_coverage from customer"


@query(f"select c_custkey, case when required_coverage < 1 then 0.95 when leverage < 0 or leverage > 1.5 then 0.9 when abs(net_margin) > 1.5 then 0.85 else 0.0 end::double as rule_score, concat_ws(',', case when required_coverage < 1 then 'missing_required_fact' end, case when leverage < 0 or leverage > 1.5 then 'implausible_leverage' end, case when abs(net_margin) > 1.5 then 'implausible_net_margin' end) as fired from ({_FEATS})")
def rules_eval(spark, sf_dir):
    feats = _t(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_acctbal") - 3000) / 1000).alias("leverage"), ((F.col("c_acctbal") - 5000) / 2000).alias("net_margin"), (F.col("c_nationkey") / F.lit(20.0)).alias("required_coverage"))
    own = [r for r in rules.standard_rules() if r.rule_id in ("missing_required_fact", "implausible_leverage", "implausible_net_margin")]
    return rules.evaluate(feats, own).select("c_custkey", "rule_score", F.array_join(F.transform("violations", lambda v: v["rule_id"]), ",").alias("fired"))


_NORM = "greatest(0.0, least(1.0, case when value <= 5 then 0.6 + 0.4 * (5 - value) / 5 else 0.6 * (100 - value) / 95 end))"


@query(f"select event_id, round({_NORM}, 9)::double as model_score, case when {_NORM} = 0 and r = 0 then 'model' when r > {_NORM} then 'rule' when r < {_NORM} then 'model' else 'both' end as triggered_by, round(greatest({_NORM}, r), 9)::double as score from (select event_id, value, case when event_type = 'purchase' then 0.8 else 0.0 end::double as r from events)")
def blend_normalise(spark, sf_dir):
    rule = F.when(F.col("event_type") == "purchase", 0.8).otherwise(0.0)
    model = detector.normalised(F.col("value"), 0.0, 5.0, 100.0)
    return _t(spark, sf_dir, "events").select("event_id", F.round(model, 9).alias("model_score"), detector.triggered_by(model, rule).alias("triggered_by"), F.round(F.greatest(model, rule), 9).alias("score"))


@query("with s as (select avg(c_acctbal) as ma, stddev_pop(c_acctbal) as sa, avg(c_nationkey) as mn, stddev_pop(c_nationkey) as sn from customer) select c_custkey, case when abs((c_acctbal - ma) / sa) >= abs((c_nationkey - mn) / sn) then 'c_acctbal' else 'c_nationkey' end as top_feature, round(case when abs((c_acctbal - ma) / sa) >= abs((c_nationkey - mn) / sn) then (c_acctbal - ma) / sa else (c_nationkey - mn) / sn end, 6) as z from customer, s")
def z_contributors(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    s = c.agg(*[f(x).alias(n + x) for x in ("c_acctbal", "c_nationkey") for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    top = detector.contributors(("c_acctbal", "c_nationkey"), {x: s["m" + x] for x in ("c_acctbal", "c_nationkey")}, {x: s["s" + x] for x in ("c_acctbal", "c_nationkey")}, 1)
    return c.select("c_custkey", F.element_at(top, 1).alias("t")).select("c_custkey", F.col("t.feature").alias("top_feature"), F.round("t.z", 6).alias("z"))


@query("select l_orderkey, l_linenumber, sha256(concat_ws(chr(31), l_orderkey::varchar, l_returnflag, '', strftime(l_shipdate, '%Y-%m-%d'), l_linenumber::varchar)) as fact_hash from lineitem")
def fact_hash(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.joined_hash(F.col("l_orderkey"), F.col("l_returnflag"), F.lit(None).cast("date"), F.col("l_shipdate").cast("date"), F.col("l_linenumber")).alias("fact_hash"))


@query("select doc_id, sha256(text) as content_hash from documents")
def content_hash(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))


def _slices(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", _money("o_totalprice").alias("price"))
    return o.filter("o_custkey % 3 <> 0"), o.filter("o_custkey % 3 <> 1").withColumn("price", (F.col("price") + 1).cast("decimal(18,2)"))


@query("select o_orderkey, o_custkey, o_orderstatus, (o_totalprice::decimal(18,2) + case when o_custkey % 3 <> 1 then 1 else 0 end)::decimal(18,2) as price from orders")
def merge_upsert(spark, sf_dir):
    old, new = _slices(spark, sf_dir)
    return merge.upsert(old, new, ["o_orderkey"], [F.col("price")])


@query("select o_orderkey, o_custkey, o_orderstatus, (o_totalprice::decimal(18,2) + case when o_custkey % 3 = 0 then 1 else 0 end)::decimal(18,2) as price from orders")
def insert_if_absent(spark, sf_dir):
    old, new = _slices(spark, sf_dir)
    return merge.insert_if_absent(old, new, ["o_orderkey"])


@query("select o_custkey, o_orderstatus, max(o_orderkey) as o_orderkey from orders group by o_custkey, o_orderstatus")
def keep_newest(spark, sf_dir):
    return merge.keep_newest(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey"), ["o_custkey", "o_orderstatus"], "o_orderkey")


@query("with old as (select c_custkey as id, c_name from customer where c_nationkey < 10), top as (select coalesce(max(id), 0) as m from old) select id, c_name from old union all select m + row_number() over (order by c_name), c_name from customer, top where c_nationkey >= 10")
def stable_ids(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    old = c.filter("c_nationkey < 10").select(F.col("c_custkey").alias("id"), "c_name")
    return merge.upsert_stable_id(old, c.select("c_name"), ["c_name"])


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def resume_antijoin(spark, sf_dir):
    done = _t(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return payloads.pending(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, "o_custkey")


@query("select s_suppkey, s_name from supplier where s_nationkey in (select n_nationkey from nation where n_regionkey = 2)")
def cascade_prune(spark, sf_dir):
    parents = _t(spark, sf_dir, "nation").filter("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return merge.pruned_children(_t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), parents, "s_nationkey").drop("s_nationkey")


@query("select coalesce(c_custkey, n_nationkey) as k, coalesce(n_name, c_name) as name from (select c_custkey, c_name from customer) full join (select n_nationkey::bigint as n_nationkey, n_name from nation) on c_custkey = n_nationkey")
def metadata_overlay(spark, sf_dir):
    base = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return merge.overlay(base, _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("name")), "k")


_PAYLOAD = "concat_ws(chr(31), event_id::varchar, event_type)"
_CHAIN = f"with recursive e as (select user_id, event_id, {_PAYLOAD} as payload, row_number() over (partition by user_id order by event_id) as n from events), c as (select user_id, event_id, n, sha256(payload || chr(31)) as row_hash from e where n = 1 union all select e.user_id, e.event_id, e.n, sha256(e.payload || chr(31) || c.row_hash) from c join e on e.user_id = c.user_id and e.n = c.n + 1)"


def _chain(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return audit.fold(e, "user_id", "event_id", F.concat_ws(S.SEPARATOR, F.col("event_id").cast("string"), "event_type"))


@query(f"{_CHAIN} select user_id, event_id, row_hash from c")
def chain_build(spark, sf_dir):
    return _chain(spark, sf_dir)


@query("select false as valid, count(*) as total_rows, min(event_id) filter (event_id % 1000 = 7) as broken_at, 'content' as broken_reason from events")
def chain_verify(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "event_type")
    log = _chain(spark, sf_dir).join(e, "event_id").withColumn("event_type", F.when(F.col("event_id") % 1000 == 7, "changed").otherwise(F.col("event_type")))
    log = log.withColumn("prev_row_hash", F.lag("row_hash").over(Window.partitionBy("user_id").orderBy("event_id")))
    expected = F.sha2(F.concat_ws(S.SEPARATOR, F.col("event_id").cast("string"), "event_type", F.coalesce("prev_row_hash", F.lit(""))), 256)
    return audit.verify(log, expected, "event_id", "user_id").drop("checked")


@query("select user_id, event_type, arg_max(value, event_id) as records from events group by user_id, event_type")
def stage_counts(spark, sf_dir):
    return metrics.stage_counts(_t(spark, sf_dir, "events"), "user_id", "event_type", "value", "event_id")


@query("select user_id, count(*) as n, count(*) filter (event_type <> 'view') as failures, round(((count(*) - count(*) filter (event_type <> 'view')) * 1000000 // count(*)) / 1000000::decimal(18,0), 3)::double as rate from events group by user_id")
def success_rates(spark, sf_dir):
    return metrics.success_rate(_t(spark, sf_dir, "events"), "user_id", "event_type", "view")


@query("select user_id, day, round(greatest(epoch_us(e) - epoch_us(s), 0) / 1e6, 3) as seconds from (select user_id, day(ts)::int as day, arg_max(ts, event_id) filter (event_type = 'view') as s, arg_max(ts, event_id) filter (event_type = 'click') as e from events group by all) where s is not null and e is not null")
def stage_durations(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    return metrics.stage_durations(e, "user_id", "day", "event_type", "ts", "event_id", "view", "click")


_LAB = "select l.doc_id, toxic, n_chars >= 1500 as flag, n_chars::double as score from labels l join documents d using (doc_id)"


def _labelled(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return _t(spark, sf_dir, "labels").select("doc_id", "toxic").join(d, "doc_id").select("toxic", (F.col("n_chars") >= 1500).alias("flag"), F.col("n_chars").cast("double").alias("score"))


@query(f"with c as (select count(*) filter (toxic = 1 and flag) as tp, count(*) filter (toxic <> 1 and flag) as fp, count(*) filter (toxic = 1 and not flag) as fn, count(*) filter (toxic <> 1 and not flag) as tn from ({_LAB})) select *, tp::double / (tp + fn) as recall, tp::double / (tp + fp) as precision, 2.0::double * tp / (2 * tp + fp + fn) as f1, (tp + fp)::double / (tp + fp + fn + tn) as flag_rate from c")
def confusion(spark, sf_dir):
    return detector.confusion(_labelled(spark, sf_dir), "toxic", "flag")


@query(f"with r as (select toxic, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::double as rk from ({_LAB})) select round((sum(rk) filter (toxic = 1) - count(*) filter (toxic = 1) * (count(*) filter (toxic = 1) + 1) / 2.0::double) / (count(*) filter (toxic = 1) * count(*) filter (toxic <> 1)), 9)::double as roc_auc from r")
def roc_auc(spark, sf_dir):
    return detector.roc_auc(_labelled(spark, sf_dir), "toxic", "score").select(F.round("roc_auc", 9).alias("roc_auc"))


@query("select p_partkey, regexp_replace('part:' || p_brand || ':x', '^[^:]*:', '') as bare, split_part(p_type, ' ', -1) as label from part")
def canonical_name(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", S.bare_concept(F.concat(F.lit("part:"), "p_brand", F.lit(":x"))).alias("bare"), F.element_at(F.split(S.measure_label(F.col("p_type")), " "), -1).alias("label"))


@query("select p_partkey, case when p_size % 2 = 0 then -1 else 1 end * (p_retailprice::decimal(18,2) * 1000)::decimal(28,10) as fact_value from part")
def parse_value(spark, sf_dir):
    price = F.format_number(_money("p_retailprice"), 2)
    text = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("("), price, F.lit(")"))).otherwise(price)
    return _t(spark, sf_dir, "part").select("p_partkey", S.fact_value(text, F.lit("3")).cast("decimal(38,10)").alias("fact_value"))


@query("select event_id, (props->>'k')::bigint as k from events")
def json_decode(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("select o_custkey, o_orderkey, o_orderstatus from orders")
def arrays_to_rows(spark, sf_dir):
    packed = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("a"), F.collect_list("o_orderstatus").alias("b"))
    return payloads.arrays_to_rows(packed, ["o_custkey"], {"o_orderkey": "a", "o_orderstatus": "b"})


@query("select doc_id, i::int as at, substring(text, i * 1000 + 1, 1200) as body from (select doc_id, text, unnest(range(0, case when length(text) <= 1200 then 1 else ceil((length(text) - 1200) / 1000.0)::bigint + 1 end)) as i from documents)")
def chunk_windows(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunks.windows(F.col("text"))).alias("at", "body"))


@query(r"with m as (select doc_id, string_split(regexp_replace(replace(text, '. Th', '. Item 1A. Th'), '(item\s+[0-9]+[a-z]?\b\.?)', chr(1) || '\1', 'gi'), chr(1)) as p from documents) select doc_id, case when len(p) > 1 then len(p) - 1 else 1 end::int as n_sections, case when len(p) > 1 then 'Item 1A.' else 'Document' end as first_section from m")
def sections(spark, sf_dir):
    s = chunks.sections(F.replace("text", F.lit(". Th"), F.lit(". Item 1A. Th")))
    return _t(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n_sections"), F.element_at(s, 1)["section"].alias("first_section"))


@query()
def strip_html(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", chunks.strip_html(F.col("html")).alias("text"))


@query(r"select page_id, count(*) as n_links from (select page_id, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*[''" + '"' + r"]([^''" + '"' + r"]*)[''" + '"' + r"]', 1)) as href from pages) where not starts_with(href, '?') group by page_id")
def index_links(spark, sf_dir):
    wrapped = _t(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("<table>"), F.regexp_replace("html", r"(?i)</?table\b[^>]*>", ""), F.lit("</table>")).alias("html"))
    return payloads.index_links(wrapped, "page_id", "html").groupBy("page_id").agg(F.count("*").alias("n_links"))


def _documents(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "text")


@query()
def tokens(spark, sf_dir):
    """Every document's words and pairs with their counts.  No SQL: another engine's word boundaries aren't Unicode's; tested against brute force."""
    return retrieve.postings(_documents(spark, sf_dir), "doc_id", "text")


def _weighted(spark, sf_dir):
    post = retrieve.postings(_documents(spark, sf_dir), "doc_id", "text")
    return post, retrieve.weights(post, retrieve.idf(post, "doc_id"), "doc_id")


@query()
def tfidf_weights(spark, sf_dir):
    return _weighted(spark, sf_dir)[1].withColumn("weight", F.round("weight", 9))


@query()
def cosine_topk(spark, sf_dir):
    post, index = _weighted(spark, sf_dir)
    asked = _t(spark, sf_dir, "benchmark").select("item_id", "text")
    wanted = retrieve.weights(retrieve.postings(asked, "item_id", "text"), retrieve.idf(post, "doc_id"), "item_id")
    return retrieve.cosine_topk(index, wanted, "doc_id", "item_id", 5).select("item_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(r"select doc_id, case when length(flat) <= 280 then flat else rtrim(substring(flat, 1, 280)) || '…' end as snippet from (select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as flat from documents)")
def snippet(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", S.snippet(F.col("text"), 280).alias("snippet"))


@query()
def best_sentence(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", S.best_sentence_window(F.col("text"), F.lit("what with that this ththtion")).alias("window"))


def _answered(spark, sf_dir):
    asked = _t(spark, sf_dir, "benchmark").select("item_id", F.substring_index("text", ".", 1).alias("question"))
    top = nearest.best_chunks(_documents(spark, sf_dir), "doc_id", "text", asked, "item_id", "question", 5)
    rich = top.withColumn("accession_number", F.col("doc_id").cast("string")).join(asked, "item_id").withColumn("form_type", F.lit("10-K"))
    return retrieve.answers(rich, "item_id"), asked, rich


@query()
def grounded_answers(spark, sf_dir):
    return _answered(spark, sf_dir)[0]


@query()
def rag_eval(spark, sf_dir):
    """A hit: the text of a cited chunk has all terms of the question."""
    got, asked, rich = _answered(spark, sf_dir)
    wanted = retrieve.terms(F.col("question"), bigrams=False)
    cited = rich.filter((F.col("score") >= GROUNDING_FLOOR) | (F.col("rank") == 1))
    hits = cited.groupBy("item_id").agg(F.max((F.size(wanted) > 0) & (F.size(F.array_except(wanted, retrieve.terms(F.col("text"), bigrams=False))) == 0)).alias("hit"))
    hit = F.col("hit")
    cases = asked.join(got, "item_id", "left").join(hits, "item_id", "left").select((F.length("question") > 0).alias("expect_grounded"), F.coalesce("grounded", F.lit(False)).alias("grounded"), F.coalesce(hit, F.lit(False)).alias("hit"), F.coalesce(F.exists("citations", lambda c: c["score"] > 0), F.lit(False)).alias("valid"))
    return retrieve.evaluation(cases)


_IX = "<html xmlns:ix='i' xmlns:xbrli='x'><xbrli:context id='c'><xbrli:period><xbrli:startDate>%s-01-01</xbrli:startDate><xbrli:endDate>%s</xbrli:endDate></xbrli:period></xbrli:context><xbrli:unit id='u'><xbrli:measure>iso4217:USD</xbrli:measure></xbrli:unit><p><ix:nonFraction name='us-gaap:Revenues' contextRef='c' unitRef='u' scale='3'>%s</ix:nonFraction><p>open"


@query("select o_orderkey::varchar as accession_number, 'success' as status, 'us-gaap:Revenues' as fact_name, (o_totalprice::decimal(18,2) * 1000)::double as fact_value, 'USD' as unit, make_date(year(o_orderdate)::int, 1, 1) as period_start, o_orderdate::date as period_end from orders")
def ixbrl_facts(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    html = F.format_string(_IX, F.year("o_orderdate").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.format_number(_money("o_totalprice"), 2))
    out = ixbrl.facts(o.select(F.col("o_orderkey").cast("string").alias("accession_number"), html.alias("raw_html")))
    return out.select("accession_number", "status", "fact_name", F.col("fact_value").cast("double").alias("fact_value"), "unit", "period_start", "period_end")


@query()
def forest_scores(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("accession_number"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    own = detector.Detector(features=("l_quantity", "l_extendedprice", "l_discount", "l_tax")).fit(li)
    return own.score(li, []).select("accession_number", "raw_decision", "score", "is_anomaly", "triggered_by", "top_contributors")


@query()
def synthetic_features(spark, sf_dir):
    rows, filings = synthetic.corpus(spark, 40, 4)
    return features.build(rows, filings)


@query()
def corruption(spark, sf_dir):
    rows, filings = synthetic.corpus(spark, 40, 4)
    broken = detector.with_corruption(rows)
    marked = features.build(broken, filings).withColumn("corrupted", detector.corruption(F.col("accession_number"), 0.2, 7).isNotNull())
    return rules.evaluate(marked).select("accession_number", "corrupted", "rule_score", F.size("violations").alias("n_violations"))


# Runs, metrics and the warehouse: orders are filings, line items facts, events the stage audit.


def _audit(spark, sf_dir):
    kinds = {"view": "ingest", "click": "parse", "purchase": "load"}
    stage = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in kinds.items()], F.lit("validate"))
    status = F.when(F.col("event_id") % 2 == 0, "started").otherwise("completed")
    return _t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 40).cast("string").alias("run_id"), stage.alias("stage"), status.alias("status"), F.floor("value").cast("int").alias("records_processed"), F.col("ts").alias("created_at"))


_AUDIT = "select event_id as id, (user_id % 40)::varchar as run_id, case event_type when 'view' then 'ingest' when 'click' then 'parse' when 'purchase' then 'load' else 'validate' end as stage, case when event_id % 2 = 0 then 'started' else 'completed' end as status, floor(value)::int as records_processed, ts as created_at from events"


@query(f"select run_id, stage, status, coalesce(records_processed, 0) as records_processed, created_at, id from ({_AUDIT}) order by created_at desc, id desc limit 40")
def recent_runs(spark, sf_dir):
    return runs.recent(_audit(spark, sf_dir))


@query(f"select coalesce(arg_max(records_processed, id) filter (stage = 'ingest'), 0) as filings_ingested, coalesce(arg_max(records_processed, id) filter (stage = 'ingest'), 0) as filings_downloaded, coalesce(arg_max(records_processed, id) filter (stage = 'parse'), 0) as filings_parsed, coalesce(arg_max(records_processed, id) filter (stage = 'validate'), 0) as filings_validated, coalesce(arg_max(records_processed, id) filter (stage = 'load'), 0) as filings_loaded from ({_AUDIT}) where run_id = '7'")
def run_counts(spark, sf_dir):
    return metrics.run_counts(_audit(spark, sf_dir), "7")


def _outcomes(spark, sf_dir):
    return _audit(spark, sf_dir).withColumn("extraction_status", F.when(F.col("id") % 5 == 0, "failed").otherwise("success"))


@query(f"select case when count(*) = 0 then 1.0 else round((count(*) filter (id % 5 <> 0))::double / count(*), 3) end::double as parsing_success_rate, count(*) filter (id % 5 = 0) as parsing_failure_count, 1.0::double as validation_success_rate from ({_AUDIT}) where run_id = '7' and stage = 'parse'")
def run_rates(spark, sf_dir):
    return metrics.run_rates(_outcomes(spark, sf_dir), "7")


def _model_runs(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("string").alias("run_id"), F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 90 + 10).cast("int").alias("filings_scored"), (F.col("o_orderkey") % 10).cast("int").alias("anomalies_flagged"), F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("created_at"))


@query("select (o_orderkey % 10)::int as anomalies_flagged, round((o_orderkey % 10)::double / (o_orderkey % 90 + 10), 3)::double as anomaly_rate from (select *, row_number() over (order by o_orderdate::date desc, o_orderkey desc) as n from orders where o_custkey % 50 = 7) where n = 1")
def anomaly_rate(spark, sf_dir):
    return metrics.anomaly_rate(_model_runs(spark, sf_dir), "7")


_SPANS = f"select stage, arg_max(created_at, (created_at, id)) filter (status = 'started') as s, arg_max(created_at, (created_at, id)) filter (status = 'completed') as e from ({_AUDIT}) where run_id = '7' group by stage"


@query(f"with t as ({_SPANS}) select case stage when 'ingest' then 'fetch_new_filings' when 'parse' then 'parse_xbrl_facts' when 'validate' then 'validate_quality_gates' else 'load_to_warehouse' end as stage, round(greatest(epoch_us(e) - epoch_us(s), 0) / 1e6, 3) as seconds from t where s is not null and e is not null union all select 'total', round(greatest(epoch_us(max(e)) - epoch_us(min(s)), 0) / 1e6, 3) from t")
def run_durations(spark, sf_dir):
    return metrics.run_durations(_audit(spark, sf_dir), "7").select(F.explode("durations_seconds").alias("stage", "seconds"))


def _facts(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession_number"), F.col("l_returnflag").alias("fact_name"), F.col("l_extendedprice").alias("fact_value"), F.col("l_shipdate").cast("date").alias("period_end"), F.when(F.col("l_linestatus") == "F", "part").alias("segment"), F.col("l_linenumber").alias("ord"))


def _filings(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession_number"), F.col("o_custkey").cast("string").alias("cik"), F.lit("T").alias("ticker"), F.lit("10-K").alias("filing_type"), F.col("o_orderdate").cast("date").alias("filing_date"), F.col("o_orderdate").cast("date").alias("period_of_report"), F.col("o_orderpriority").alias("pipeline_run_id"))


@query("select l_orderkey as accession_number, string_agg(distinct l_returnflag, ',' order by l_returnflag) as names from lineitem join orders on l_orderkey = o_orderkey where o_orderpriority = '1-URGENT' and l_linestatus <> 'F' group by l_orderkey")
def facts_of_run(spark, sf_dir):
    rows = runs.facts_of_run(_facts(spark, sf_dir), _filings(spark, sf_dir), "1-URGENT")
    return runs.names_by_filing(rows).withColumn("names", F.array_join("names", ","))


_WINDOWS = "select l_returnflag as fact_name, l_extendedprice::double as value, l_shipdate::date < date '1998-08-01' - 365 as is_base from lineitem where l_linestatus <> 'F' and l_returnflag in ('N', 'R') and l_shipdate::date >= date '1998-08-01' - 730"


@query(f"select fact_name, is_base, count(*) as n, round(sum(value), 2) as total from ({_WINDOWS}) group by all")
def psi_windows(spark, sf_dir):
    rows = runs.windows(_facts(spark, sf_dir), ["N", "R"], date(1998, 8, 1), 730)
    return rows.groupBy("fact_name", "is_base").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("select distinct l_orderkey as accession_number from lineitem order by 1")
def distinct_accessions(spark, sf_dir):
    return runs.accessions(_facts(spark, sf_dir))


@query("select page_id as accession_number, html as raw_html from pages where length(html) > 0 and page_id in (select doc_id from labels)")
def raw_html_scan(spark, sf_dir):
    filings = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("accession_number"), F.col("html").alias("raw_html"))
    return warehouse.raw_html(filings, _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("accession_number")))


@query("select o_orderkey as accession_number, o_custkey::varchar as cik, o_orderdate::date as filing_date from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')")
def metadata_scan(spark, sf_dir):
    wanted = _facts(spark, sf_dir).filter("fact_name = 'R'")
    return warehouse.metadata(_filings(spark, sf_dir), wanted).select("accession_number", "cik", "filing_date")


@query("with f as (select o_orderkey from orders where o_orderdate::date >= date '1995-01-01' order by o_orderdate::date desc, o_orderkey limit 1000) select l_orderkey as accession_number, count(*) as n from lineitem join f on l_orderkey = o_orderkey group by l_orderkey")
def training_scan(spark, sf_dir):
    rows, _ = warehouse.training(_filings(spark, sf_dir), _facts(spark, sf_dir), date(1995, 1, 1), 1000)
    return rows.groupBy("accession_number").agg(F.count("*").alias("n"))


@query("select l_orderkey as accession_number, 'load' as stage, case when bool_or(l_linestatus = 'F') then 'failed' else 'success' end as extraction_status from lineitem group by l_orderkey")
def stage_outcomes(spark, sf_dir):
    rows = _facts(spark, sf_dir).select("accession_number", F.when(F.col("segment").isNotNull(), "failed").otherwise("success").alias("status"), F.lit(None).cast("string").alias("detail"))
    return batch.outcomes(rows, "load", "r").select("accession_number", "stage", "extraction_status")


@query("select max(event_id) as last_id, arg_max(event_type, event_id) as last from events")
def chain_tail(spark, sf_dir):
    last, what = audit.tail(_t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("row_hash")))
    return spark.createDataFrame([(last, what)], "last_id bigint, last string")


@query("select o_orderkey, '{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"o_orderdate\":\"' || strftime(o_orderdate::date, '%Y-%m-%d') || '\",\"none\":null}' as j from orders")
def json_rows(spark, sf_dir):
    rows = S.plain(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), F.lit(None).cast("string").alias("none")))
    return rows.select("o_orderkey", S.as_json(rows).alias("j"))


@query("select event_id, case when event_id % 3 = 0 then 0 else 1 end::int as n, case when event_id % 3 <> 0 then event_type end as first_rule from events")
def violations_decode(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, "{broken").otherwise(F.concat(F.lit('[{"rule_id":"'), "event_type", F.lit('","severity":0.5,"message":"m"}]')))
    v = S.violations(raw)
    return _t(spark, sf_dir, "events").select("event_id", F.size(v).alias("n"), F.get(v, F.lit(0))["rule_id"].alias("first_rule"))


@query("select p_partkey, round_even(p_retailprice::decimal(18,2) / 1000, 0)::int::varchar || '%' as share, printf('%.1f', round_even(p_retailprice::decimal(18,2), 1)) as price from part")
def half_even_text(spark, sf_dir):
    price = _money("p_retailprice")
    return _t(spark, sf_dir, "part").select("p_partkey", S.percent_text(price.cast("decimal(28,8)") / 100_000).alias("share"), S.fixed_text(price, 1).alias("price"))


@query("select o_orderkey, replace(strftime(o_orderdate::date, '%Y-%m-%d'), '-', '') as bare, o_orderdate::date as day from orders")
def dashes_and_dates(spark, sf_dir):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return _t(spark, sf_dir, "orders").select("o_orderkey", S.undashed(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("bare"), S.as_date(stamp).alias("day"))


@query("select feature, round(share, 9) as share from (select avg((c_acctbal <> 0)::int)::double as c_acctbal, avg((c_nationkey <> 0)::int)::double as c_nationkey from customer) unpivot (share for feature in (c_acctbal, c_nationkey))")
def nonzero_shares(spark, sf_dir):
    return detector.nonzero_shares(_t(spark, sf_dir, "customer"), ("c_acctbal", "c_nationkey")).withColumn("share", F.round("share", 9))


@query(f"with s as ({_LAB}) select coalesce(round(avg(score) filter (toxic = 1), 6), 0)::double as mean_score_corrupted, coalesce(round(avg(score) filter (toxic <> 1), 6), 0)::double as mean_score_clean, count(*) filter (toxic = 1 and flag) as tp, 0.2::double as corruption_rate from s")
def evaluated(spark, sf_dir):
    out = detector.evaluated(_labelled(spark, sf_dir), "toxic", "score", "flag", 0.2)
    return out.select(F.round("mean_score_corrupted", 6).alias("mean_score_corrupted"), F.round("mean_score_clean", 6).alias("mean_score_clean"), "tp", "corruption_rate")


@query("select * from (select o_orderkey, o_custkey, row_number() over (order by o_orderdate::date, o_orderkey) as n from orders)")
def numbered(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return ranks.numbered(o, ["day", "o_orderkey"], "n").drop("day")


@query("select event_id, lag(event_type) over (order by event_id) as before from events")
def previous_row(spark, sf_dir):
    return ranks.previous(_t(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", "event_type", "before").select("event_id", "before")


@query("select o_orderkey from orders where o_custkey % 3 <> 0 union all select o_orderkey from orders where o_custkey % 3 <> 1")
def union_all(spark, sf_dir):
    a, b = _slices(spark, sf_dir)
    return a.select("o_orderkey").unionByName(b.select("o_orderkey"))


@query("select o_orderkey from orders where o_custkey % 3 <> 0 except select o_orderkey from orders where o_custkey % 3 <> 1")
def difference(spark, sf_dir):
    a, b = _slices(spark, sf_dir)
    return a.select("o_orderkey").subtract(b.select("o_orderkey"))


@query("select o_orderkey from orders where o_custkey % 3 <> 0 intersect select o_orderkey from orders where o_custkey % 3 <> 1")
def intersection(spark, sf_dir):
    a, b = _slices(spark, sf_dir)
    return a.select("o_orderkey").intersect(b.select("o_orderkey"))


@query("select user_id, max(ts) as high_water, count(distinct event_id) as n from events group by user_id")
def stream_ingest(spark, sf_dir):
    """Events as a file stream, each file once, deduplicated on their id within the watermark."""
    root = path(spark, "stream")
    schema = _t(spark, sf_dir, "events").schema
    # A pattern, as the table is one file at small scales and a folder at large ones.
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").withColumn("at", F.col("ts").cast("timestamp"))
    stream = ingest.deduplicated(source, ["event_id"], "at", "1 hour").drop("at")
    run = stream.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    done = spark.read.schema(schema).parquet(f"{root}/rows")
    water = ingest.high_water(done, "user_id", "ts")
    return water.join(done.groupBy("user_id").agg(F.count("*").alias("n")), "user_id")
