"""Units: merges, quality, features and rules, detector, audit chain, parsing, retrieval, registry, streams."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import audit, chunks, detector, facts, features, forest, merge, quality, registry, retrieve, rules, serve
from factloom.plans.pipeline import Run, Skip, StageFailed
from factloom.sources import client, ixbrl, payloads, synthetic
from factloom.streaming import ingest


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_merge_twice_is_once(spark):
    old = spark.createDataFrame([(1, None, 1.0), (2, "x", 2.0)], "k int, s string, v double")
    new = spark.createDataFrame([(1, None, 5.0), (1, None, 6.0), (3, "y", 3.0)], "k int, s string, v double")
    once = merge.upsert(old, new, ["k", "s"], [F.col("v")])
    assert rows(once) == [(1, None, 6.0), (2, "x", 2.0), (3, "y", 3.0)]
    assert rows(merge.upsert(once, new, ["k", "s"], [F.col("v")])) == rows(once)


def test_ids_stay(spark):
    old = spark.createDataFrame([(4, "a", 1), (9, "b", 2)], "id bigint, k string, v int")
    new = spark.createDataFrame([("b", 7), ("d", 8), ("c", 9)], "k string, v int")
    once = merge.upsert_stable_id(old, new, ["k"])
    assert rows(once) == [(10, "c", 9), (11, "d", 8), (4, "a", 1), (9, "b", 7)]
    assert rows(merge.upsert_stable_id(once, new, ["k"])) == rows(once)


def test_completeness(spark):
    f = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "k string, n string")
    per = quality.completeness(f, "k", "n", ["x", "y"])
    assert rows(per, "k", "missing") == [("a", []), ("b", ["y"])]
    with pytest.raises(quality.QualityError):
        quality.require_complete(per, 0.9)
    assert quality.completeness_summary(per.filter("false"), 0.9).first()["ratio"] == 1.0


@pytest.mark.parametrize("strategy", ["uniform", "quantile"])
def test_psi(spark, strategy):
    def level(a, b):
        data = [(float(x), True) for x in a] + [(float(x), False) for x in b]
        return quality.psi(spark.createDataFrame(data, "value double, is_base boolean"), [], strategy=strategy).first()

    assert abs(level(range(100), range(100))["psi"]) < 1e-6
    assert level([5] * 10, [5] * 10)["psi"] == 0
    assert level(range(1, 101), range(201, 301))["level"] == "ALERT"


def clean(spark, n=20, years=3):
    return synthetic.corpus(spark, n, years)


def test_clean_corpus_fires_no_rule(spark):
    f, filings = clean(spark)
    out = rules.evaluate(features.build(f, filings))
    assert out.count() == 60
    assert out.filter("rule_score > 0.6").count() == 0


def test_corpus_does_not_depend_on_partitions(spark):
    assert rows(clean(spark)[0].repartition(3)) == rows(clean(spark)[0])


def filing(spark, drop=(), **over):
    v = {"Revenues": 1e6, "NetIncomeLoss": 1e5, "OperatingIncomeLoss": 1.5e5, "Assets": 2e6, "Liabilities": 8e5, "EarningsPerShareBasic": 1.0, "CommonStockSharesOutstanding": 1e5} | over
    data = [("A", f"us-gaap:{k}", x, "USD", date(2024, 1, 1), date(2024, 12, 31), None, i) for i, (k, x) in enumerate(v.items()) if k not in drop]
    return spark.createDataFrame(data, "accession_number string, fact_name string, fact_value double, unit string, period_start date, period_end date, segment string, ord int")


def test_features(spark):
    r = features.build(filing(spark)).first()
    assert (r["net_margin"], r["operating_margin"], r["leverage"], r["roa"], r["asset_turnover"], r["eps_consistency"], r["fact_coverage"]) == pytest.approx((0.1, 0.15, 0.4, 0.05, 0.5, 0.0, 1.0))
    assert r["period_years"] == pytest.approx(365 / 366)
    assert features.build(filing(spark, EarningsPerShareBasic=2.0)).first()["eps_consistency"] == pytest.approx(-0.5)
    assert features.build(filing(spark, drop=["Assets"])).first()["required_coverage"] == pytest.approx(2 / 3)
    assert features.build(filing(spark, Revenues=float("nan"))).first()["net_margin"] == 0.0


def test_prior_filing(spark):
    f = filing(spark).unionByName(filing(spark, Revenues=1e7).withColumn("accession_number", F.lit("B")))
    meta = spark.createDataFrame([("A", "1", date(2023, 12, 31)), ("B", "1", date(2024, 12, 31))], "accession_number string, cik string, period_of_report date").withColumn("filing_date", F.col("period_of_report"))
    got = dict(rows(features.build(f, meta), "accession_number", "revenue_yoy"))
    assert got["A"] == 0.0 and got["B"] == pytest.approx(1.0, abs=1e-6)


def test_hybrid_detector(spark):
    f, filings = clean(spark, 30, 4)
    base = features.build(f, filings)
    fitted = detector.Detector(trees=60).fit(base)
    bad, chosen = detector.corrupted(f, 0.2)
    scored = fitted.score(features.build(bad, filings)).withColumn("label", F.col("accession_number").isin(*chosen).cast("int")).cache()
    assert detector.roc_auc(scored, "label", "score").first()[0] > 0.8
    assert detector.confusion(scored, "label", "is_anomaly").first()["recall"] > 0.5
    assert 0.02 <= fitted.score(base, []).agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0] <= 0.09
    again = detector.Detector.from_json(fitted.to_json()).score(base).select("accession_number", "score")
    assert rows(again) == rows(fitted.score(base.repartition(5)).select("accession_number", "score"))
    assert scored.select(detector.explain()).first()[0].startswith("score")


def test_marks_are_of_all_rows(spark):
    x = np.random.default_rng(1).normal(size=(3000, 2))
    x[:60] *= 8
    made = spark.createDataFrame([(str(i), *map(float, v)) for i, v in enumerate(x)], "accession_number string, a double, b double")
    fitted = detector.Detector(features=("a", "b"), trees=20, sample=400).fit(made)
    d = fitted.forest.decision(x)
    assert (fitted.marks["low"], fitted.marks["high"]) == (d.min(), d.max()) and fitted.marks["cut"] == pytest.approx(np.quantile(d, 0.05), rel=1e-12)
    assert [*fitted.means.values(), *fitted.stds.values()] == pytest.approx([*x.mean(axis=0), *x.std(axis=0)], rel=1e-9)
    v = spark.createDataFrame([(float(k),) for k in [*x[:, 0], *[0.25] * 900]], "v double")
    for q in (0.0, 0.05, 0.5, 0.6, 1.0):
        assert detector.exact_quantile(v, "v", q, 50) == pytest.approx(np.quantile([*x[:, 0], *[0.25] * 900], q), rel=1e-12)


def test_forest_finds_the_far_point():
    x = np.vstack([np.random.default_rng(0).normal(size=(300, 2)), [[9, 9]]])
    assert forest.Forest.fit(x, 50).decision(x).argmin() == 300
    with pytest.raises(ValueError):
        forest.Forest.fit(x[:1])


@pytest.mark.parametrize("scores,want", [((0, 1, 2, 3), 1.0), ((3, 2, 1, 0), 0.0), ((1, 1, 1, 1), 0.5)])
def test_auc(spark, scores, want):
    df = spark.createDataFrame(list(zip((0, 0, 1, 1), map(float, scores))), "l int, s double")
    assert detector.roc_auc(df, "l", "s").first()[0] == want
    assert detector.roc_auc(df.filter("l = 1"), "l", "s").first()[0] == 0.5


def test_gate():
    good = {"recall": 0.7, "precision": 0.5, "roc_auc": 0.9, "flag_rate": 0.1}
    assert not detector.gate(good)
    assert detector.gate(good | {"flag_rate": 0.5}) and detector.gate(good, good | {"recall": 0.9})


def chain(n=3):
    at = datetime(2024, 1, 1)
    given = [{"run_id": "r", "system_id": "s", "accession_number": f"a{i}", "stage": "parse", "extraction_status": "success", "detail": None, "content_hash": None, "created_at": at + timedelta(microseconds=5 * i)} for i in range(n)]
    return audit.chained(given)


@pytest.mark.parametrize("change,at", [(None, None), ("detail", 2), ("first", 1), ("middle", 3), ("tail", None)])
def test_chain(spark, change, at):
    log = chain()
    if change == "detail":
        log[1]["detail"] = "x"
    if change == "first":
        log[0]["extraction_status"] = "failed"
    if change == "middle":
        del log[1]
    if change == "tail":
        del log[2]
    schema = "id bigint, run_id string, system_id string, accession_number string, stage string, extraction_status string, detail string, content_hash string, prev_row_hash string, row_hash string, created_at timestamp"
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in log], schema)
    got = audit.verify(df, audit.row_hash(F.coalesce("prev_row_hash", F.lit("")))).first()
    assert (got["valid"], got["broken_at"], got["total_rows"]) == (at is None, at, len(log))


def test_hash_ignores_null_or_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string").select(S.joined_hash(F.col("x"), F.col("y")))
    assert len(set(df.collect())) == 1


IX = """<html><ix:header><xbrli:context id="d"><xbrli:period><xbrli:startDate>2023-10-01</xbrli:startDate><xbrli:endDate>2024-09-28</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="i"><xbrli:segment><xbrldi:explicitMember>x:ProductsMember</xbrldi:explicitMember></xbrli:segment><xbrli:period><xbrli:instant>2024-09-28</xbrli:instant></xbrli:period></xbrli:context>
<xbrli:unit id="u"><xbrli:divide><xbrli:unitNumerator><xbrli:measure>iso4217:USD</xbrli:measure></xbrli:unitNumerator><xbrli:unitDenominator><xbrli:measure>xbrli:shares</xbrli:measure></xbrli:unitDenominator></xbrli:divide></xbrli:unit></ix:header>
<ix:nonFraction name="us-gaap:Revenues" contextRef="d" unitRef="u" scale="6">391,035</ix:nonFraction><p>unclosed<ix:nonFraction name="us-gaap:Assets" contextRef="i" unitRef="q">(42)</ix:nonFraction>
<ix:nonFraction name="us-gaap:Assets" contextRef="gone" unitRef="u">1</ix:nonFraction>"""


def test_ixbrl(spark):
    got = ixbrl.parse(IX)
    assert [(r["fact_name"], r["fact_value"], r["unit"], r["period_start"], r["segment"]) for r in got] == [("us-gaap:Revenues", Decimal("391035000000"), "USD/shares", date(2023, 10, 1), None), ("us-gaap:Assets", Decimal(-42), "q", None, "x:ProductsMember")]
    assert [ixbrl.parsed_value(*a) for a in (("100", None, "-"), ("",), ("NaN",), ("5", "x"))] == [Decimal(-100), None, None, Decimal(5)]
    df = ixbrl.facts(spark.createDataFrame([("a", IX), ("b", None), ("c", "<<<")], "accession_number string, raw_html string"))
    assert {r["accession_number"]: r["status"] for r in df.collect()} == {"a": "success", "b": "empty", "c": "empty"}


def test_supersession_and_latest(spark):
    df = spark.createDataFrame([("k", None, 0, False, 1), ("k", None, 1, True, 2), ("k", None, 2, True, 3), ("q", None, 3, False, 4), ("q", None, 4, False, 5)], "f string, s string, ord int, latest boolean, v int")
    assert rows(facts.superseded(df, ["f", "s"], "latest", "ord"), "f", "v") == [("k", 3), ("q", 4)]


def test_chunks(spark):
    df = spark.createDataFrame([(1, "intro Item 1. Business is good. Item 1A. Risk"), (2, "x" * 2500)], "id int, text string")
    got = chunks.chunked(df, "id", "text")
    assert rows(got.filter("id = 1"), "chunk_index", "section") == [(0, "Item 1."), (1, "Item 1A.")]
    assert sorted(len(t) for (t,) in rows(got.filter("id = 2"), "text")) == [500, 1200, 1200]
    assert chunks.html_text("<p>a <b>b</b><script>no</script>&amp;c") == "a b &c"


def test_answers(spark):
    docs = spark.createDataFrame([("d1", "Revenue grew strongly. Cloud services drove growth."), ("d2", "Litigation risk is described here at length.")], "id string, text string")
    post = retrieve.postings(docs, "id", "text")
    idfs = retrieve.idf(post, "id")
    asked = spark.createDataFrame([("q1", "What drove cloud growth?"), ("q2", "zebra migrations")], "q string, question string")
    top = retrieve.cosine_topk(retrieve.weights(post, idfs, "id"), retrieve.weights(retrieve.postings(asked, "q", "question"), idfs, "q"), "id", "q", 2)
    rich = top.join(docs, "id").join(asked, "q").selectExpr("q", "question", "score", "rank", "text", "'s' as section", "id as accession_number", "'10-K' as form_type")
    got = retrieve.answers(rich, "q").collect()
    assert len(got) == 1 and got[0]["grounded"] and "Cloud services" in got[0]["text"]


def test_registry(tmp_path):
    r = registry.Registry(str(tmp_path))
    v = r.register("{}", {"metrics": {"recall": 0.7}}, datetime(2024, 1, 2))
    assert r.latest() == v and r.verify(v) and r.production() is None
    r.promote(v)
    assert r.production() == v
    (tmp_path / v / "model.json").write_text("changed")
    assert not r.verify(v)
    with pytest.raises(ValueError):
        r.promote(v)


def test_fetcher_retries():
    slept, answers = [], [(429, {"Retry-After": "2"}, ""), (503, {}, ""), (200, {}, "ok")]
    f = client.Fetcher(lambda url: answers.pop(0), rate=1000, sleep=slept.append, draw=lambda: 0.5)
    assert f.fetch("u") == "ok" and slept[0] == 3.5
    assert client.backoff(10, draw=lambda: 1.0) == 60.0


def test_payloads(spark, tmp_path):
    p = tmp_path / "s.json"
    p.write_text('{"cik": "1", "tickers": ["T"], "filings": {"recent": {"accessionNumber": ["a", "b"], "form": ["10-K", "8-K"], "filingDate": ["2024-01-01", "2024-02-01"], "reportDate": ["2023-12-31"], "primaryDocument": ["x", "y"]}}}')
    got = payloads.filings_of(payloads.submissions(spark, str(p)), ["10-K", "8-K"], "2024-01-01", "2024-02-01")
    assert rows(got, "accession_number", "ticker", "period_of_report") == [("a", "T", "2023-12-31"), ("b", "T", None)]


def test_queue_picks_latest_before_filter(spark):
    scores = spark.createDataFrame([(1, "a", 0.9, True, 1), (2, "a", 0.1, False, 1), (3, "b", 0.8, True, 1)], "id bigint, accession_number string, score double, is_anomaly boolean, model_run_id bigint")
    filings = spark.createDataFrame([("a", "T", date(2024, 1, 1)), ("b", "T", date(2024, 1, 2))], "accession_number string, ticker string, filing_date date")
    runs = spark.createDataFrame([(1, "v1")], "id bigint, model_version string")
    assert rows(serve.anomaly_queue(scores, filings, runs, "t", 0.5), "accession_number") == [("b",)]
    with pytest.raises(ValueError):
        serve.anomaly_queue(scores, filings, runs, "t", 2.0)


def test_stream_replay(spark, tmp_path):
    source, target = str(tmp_path / "in"), ingest.Snapshot(spark, str(tmp_path / "out"), "k int, v int")
    (tmp_path / "out").mkdir()
    for batch in ([(1, 1), (2, 2)], [(2, 5), (3, 3)]):
        spark.createDataFrame(batch, "k int, v int").coalesce(1).write.mode("append").parquet(source)
        ingest.ingest(spark, source, "k int, v int", target, ["k"], [F.col("v")], str(tmp_path / "cp"))
    assert rows(target.read()) == [(1, 1), (2, 5), (3, 3)]
    target.merge(spark.createDataFrame([(2, 5)], "k int, v int"), ["k"], [F.col("v")])
    assert rows(target.read()) == [(1, 1), (2, 5), (3, 3)]


def test_pipeline_run(spark, tmp_path):
    def fail(s, d):
        raise StageFailed("no")

    alerts = []
    ok = Run(spark, "r", str(tmp_path), [("a", lambda s, d: s.range(3)), ("b", fail), ("c", lambda s, d: d.filter("id > 0"))], optional=frozenset(["b"]))
    assert ok.execute().count() == 2
    assert [(x["stage"], x["status"]) for x in ok.audit] == [("a", "started"), ("a", "completed"), ("b", "started"), ("b", "failed"), ("c", "started"), ("c", "completed")]
    with pytest.raises(StageFailed):
        Run(spark, "q", str(tmp_path), [("b", fail)], alert=lambda s, w: alerts.append(s)).execute()
    assert alerts == ["b"]

    def skip(s, d):
        raise Skip

    assert Run(spark, "p", str(tmp_path), [("a", skip), ("b", fail)]).execute() is None
