"""Runs, metrics, batch, backfill, training, answers, alerts and storage of the package."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from factloom import __main__ as cli
from factloom import storage
from factloom.functions import scalars as S
from factloom.operators import alerts, answers, audit, detector, features, metrics, quality, ranks, registry, retrieve, rules, runs, serve
from factloom.plans import batch, views
from factloom.plans.pipeline import Run, StageFailed
from factloom.schema import CHAIN_AUDIT, FACTS, FILINGS, MODEL_RUNS, PREFIX, STAGE_AUDIT
from factloom.sources import payloads, synthetic, warehouse
from factloom.streaming.ingest import Snapshot

T0 = datetime(2024, 3, 1, 12)


def stage_rows(spark, rows):
    return spark.createDataFrame([(i, "r", s, status, n, None, T0 + timedelta(seconds=at)) for i, (s, status, n, at) in enumerate(rows)], STAGE_AUDIT)


def test_run_metrics(spark):
    audit_rows = stage_rows(spark, [("ingest", "started", None, 0), ("ingest", "completed", 5, 10), ("parse", "started", None, 12), ("parse", "completed", 4, 15.5), ("load", "started", None, 20), ("validate", "completed", 4, 30)])
    c = metrics.run_counts(audit_rows, "r").first()
    assert (c["filings_ingested"], c["filings_downloaded"], c["filings_parsed"], c["filings_loaded"]) == (5, 5, 4, 0)
    assert tuple(metrics.run_counts(audit_rows, "other").first()) == (0, 0, 0, 0, 0)
    d = metrics.run_durations(audit_rows, "r").first()[0]
    assert d == {"fetch_new_filings": 10.0, "parse_xbrl_facts": 3.5, "total": 30.0}
    assert metrics.run_durations(audit_rows, "other").first()[0] == {"total": 0.0}


def outcome_rows(spark, statuses):
    return spark.createDataFrame([(i, "r", "s", f"a{i}", "parse", x, None, None, None, "h", T0) for i, x in enumerate(statuses)], CHAIN_AUDIT)


@pytest.mark.parametrize("statuses,rate,bad", [((), 1.0, 0), (("success",) * 3, 1.0, 0), (("success", "failed", None), 0.333, 2), (("failed",), 0.0, 1)])
def test_parse_rates(spark, statuses, rate, bad):
    r = metrics.run_rates(outcome_rows(spark, statuses), "r").first()
    assert (r["parsing_success_rate"], r["parsing_failure_count"], r["validation_success_rate"]) == (rate, bad, 1.0)


def model_runs(spark, rows):
    return spark.createDataFrame([(i, "r", "v", "s", None, n, f, 0.6, None, None, at) for i, (n, f, at) in enumerate(rows)], MODEL_RUNS)


def test_anomaly_rate_is_of_the_newest_run(spark):
    r = metrics.anomaly_rate(model_runs(spark, [(10, 1, T0), (40, 6, T0 + timedelta(hours=1)), (7, 7, T0 - timedelta(hours=1))]), "r").first()
    assert (r["anomalies_flagged"], r["anomaly_rate"]) == (6, 0.15)
    assert tuple(metrics.anomaly_rate(model_runs(spark, [(0, 0, T0)]), "r").first()) == (0, 0.0)
    assert tuple(metrics.anomaly_rate(model_runs(spark, []), "r").first()) == (0, 0.0)


def test_records_restart_on_corruption(spark, tmp_path):
    to = str(tmp_path / "metrics")
    one = metrics.run_record(stage_rows(spark, [("ingest", "completed", 5, 1)]), outcome_rows(spark, ("success",)), model_runs(spark, []), "r", date(2024, 3, 1))
    assert metrics.records(spark, to).count() == 0
    metrics.append_record(one, to)
    (tmp_path / "metrics" / "part-bad.json").write_text("{not json\n")
    metrics.append_record(one.withColumn("run_id", F.lit("s")), to)
    assert sorted(r["run_id"] for r in metrics.records(spark, to).collect()) == ["r", "s"]
    doc = json.loads(metrics.document(spark, to, T0))
    assert [r["run_id"] for r in doc["runs"]] == ["r", "s"] and doc["runs"][0]["filings_ingested"] == 5 and doc["runs"][0]["durations_seconds"]["total"] == 0.0


def facts_table(spark, rows):
    return spark.createDataFrame([(a, n, v, "USD", None, end, seg, i) for i, (a, n, v, end, seg) in enumerate(rows)], FACTS.replace("decimal(20,4)", "double")).withColumn("fact_value", F.col("fact_value").cast("decimal(20,4)"))


def filings_table(spark, rows):
    return spark.createDataFrame([(a, "1", "AAA", "10-K", d, d, html, None, None, run) for a, d, html, run in rows], FILINGS)


DAY = date(2024, 6, 1)


def test_windows_and_validation(spark):
    names = ["Revenues", "NetIncomeLoss", "Assets"]
    rows = [("a", PREFIX + n, 1.0, DAY, None) for n in names] + [("b", PREFIX + "Revenues", 1.0, DAY, None), ("b", PREFIX + "Assets", 2.0, DAY, "part")]
    for k in range(100):
        rows += [("h", PREFIX + "Revenues", float(k), DAY - timedelta(days=150), None), ("h", PREFIX + "Assets", float(k), DAY - timedelta(days=(60 if k % 2 else 150)), None)]
    facts, filings = facts_table(spark, rows), filings_table(spark, [("a", DAY, "x", "run"), ("b", DAY, "x", "run"), ("h", DAY, "x", "old")])
    w = runs.windows(facts, [PREFIX + "Assets"], DAY, 200)
    assert {(r["is_base"], r["n"]) for r in w.groupBy("is_base").agg(F.count("*").alias("n")).collect()} == {(True, 50), (False, 51)}
    edge = facts_table(spark, [("x", "f", 1.0, DAY - timedelta(days=d), None) for d in (0, 50, 51, 101, 102)])
    assert [r["is_base"] for r in runs.windows(edge, ["f"], DAY, 101).orderBy("value", "is_base").collect()] == [False, False, True, True]
    report = runs.validate(facts, filings, "run", [PREFIX + "Assets", PREFIX + "Revenues"], DAY, 200, 0.95)
    assert report.exit_code == 1 and report.completeness["complete"] == 1 and report.completeness["missing"] == {"b": [PREFIX + "NetIncomeLoss", PREFIX + "Assets"]}
    assert [r["fact_name"] for r in report.drift] == [PREFIX + "Assets", PREFIX + "Revenues"] and "b: " in report.text()
    assert runs.validate(facts, filings, "none", [], DAY).completeness is None and runs.validate(facts, filings, "none", [], DAY).exit_code == 0
    assert runs.validate(facts, filings, "run", [], DAY, threshold=0.5).exit_code == 0


def test_missing_filings_are_counted_beyond_those_shown(spark):
    per = quality.completeness(facts_table(spark, [(f"a{i:02d}", "x", 1.0, DAY, None) for i in range(25)]), "accession_number", "fact_name", ["y"])
    row = runs.result(per, "r", 0.5).first()
    assert row["total"] == 25 and len(row["missing"]) == runs.SHOWN and "15 more" in runs.Report(row, []).text()


PAYLOAD = {"cik": "7", "name": "N", "tickers": ["AAA"], "exchanges": [], "filings": {"recent": {"accessionNumber": ["0-1", "0-2", "0-3"], "form": ["10-K", "10-Q", "8-K"], "filingDate": ["2023-01-05", "2023-05-05", "2023-06-01"], "reportDate": ["2022-12-31", "2023-03-31"], "primaryDocument": ["a", "b", "c"]}}}
DOC = "<html><xbrli:context id='c'><xbrli:period><xbrli:startDate>2022-01-01</xbrli:startDate><xbrli:endDate>2022-12-31</xbrli:endDate></xbrli:period></xbrli:context>" + "".join(f"<ix:nonFraction name='us-gaap:{n}' contextRef='c'>{v}</ix:nonFraction>" for n, v in (("Revenues", 100), ("NetIncomeLoss", 10), ("Assets", 200))) + "</html>"


@pytest.fixture
def fetch():
    """Nested, so that it goes to tasks by value; the second filing has no document."""
    doc = DOC

    def get(url):
        if "/02/" in url:
            raise OSError("no such document")
        return doc

    return get


@pytest.fixture
def payload(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PAYLOAD))
    return payloads.submissions(spark, str(tmp_path / "p.json"))


def test_backfill_resumes(spark, payload, fetch, tmp_path):
    doc = DOC
    tables, point = batch.Tables(str(tmp_path / "w")), batch.Checkpoint(spark, str(tmp_path / "w" / "checkpoint.json"))
    go = lambda f, **k: batch.backfill(spark, payload, f, "http://x", tables, point, "both", date(2023, 1, 1), date(2023, 12, 31), **k)
    assert go(fetch, dry_run=True) == batch.Totals(2, 0, 0) and point.read() == {}
    assert go(fetch) == batch.Totals(1, 3, 1)
    assert point.read() == {"7": {"completed": ["0-1"], "last_filing_date": "2023-01-05"}}
    assert go(lambda u: doc, resume=True) == batch.Totals(1, 3, 0)
    assert point.read()["7"]["completed"] == ["0-1", "0-2"]
    assert go(fetch, resume=True) == batch.Totals(0, 0, 0)
    assert Snapshot(spark, tables.at("facts"), FACTS).read().count() == 6 and Snapshot(spark, tables.at("filings"), FILINGS).read().count() == 2
    go(lambda u: doc)
    assert Snapshot(spark, tables.at("facts"), FACTS).read().count() == 6


def test_checkpoint_survives_corruption(spark, tmp_path):
    point = batch.Checkpoint(spark, str(tmp_path / "c.json"))
    (tmp_path / "c.json").write_text("{broken")
    assert point.read() == {}
    done = spark.createDataFrame([("1", "b", "2024-01-02"), ("1", "a", "2024-01-01")], "cik string, accession_number string, filing_date string")
    point.add(done)
    assert point.add(done.filter("accession_number = 'a'").withColumn("filing_date", F.lit("2023-01-01"))) == {"1": {"completed": ["a", "b"], "last_filing_date": "2024-01-02"}}


def test_since_last_run_starts_at_the_checkpoint(spark, payload):
    done = spark.createDataFrame([("7", "0-9", "2023-05-01")], "cik string, accession_number string, last_filing_date string")
    take = lambda **k: sorted(r["accession_number"] for r in batch.candidates(payload, "both", date(2023, 1, 1), date(2023, 12, 31), done, **k).collect())
    assert take() == ["0-1", "0-2"] and take(since_last_run=True) == ["0-2"] and batch.forms("8-K") == ["8-K"]


def test_batch_run(spark, payload, fetch, tmp_path):
    poor = DOC.replace("us-gaap:Assets", "us-gaap:Liabilities")
    tables, took = batch.Tables(str(tmp_path / "w")), []
    new = lambda s: payloads.filings_of(payload, ["10-K", "10-Q"])
    made = batch.run(spark, "r1", new, fetch, "http://x", tables, str(tmp_path / "work"), registry.Registry(str(tmp_path / "models")), pause=0)
    assert made.execute().count() == 1
    log = audit.Log(spark, tables.at("chain"))
    assert log.verify().first()["valid"]
    assert {(r["stage"], r["accession_number"], r["extraction_status"]) for r in log.read().collect()} == {("download", "0-1", "success"), ("download", "0-2", "failed"), ("parse", "0-1", "success"), ("load", "0-1", "success")}
    record = metrics.records(spark, tables.at("metrics")).first()
    assert record["run_id"] == "r1" and record["parsing_success_rate"] == 1.0 and record["filings_ingested"] == 2
    again = batch.run(spark, "r1", new, lambda u: 1 / 0, "http://x", tables, str(tmp_path / "work"), pause=0)
    assert again.execute().count() == 1 and again.audit == []
    assert batch.run(spark, "r2", lambda s: new(s).filter("accession_number = '0-1'"), fetch, "http://x", tables, str(tmp_path / "work"), pause=0).execute() is None
    bad = batch.run(spark, "r3", new, lambda u: poor, "http://x", tables, str(tmp_path / "work"), to={"list": took.append}, pause=0)
    with pytest.raises(StageFailed):
        bad.execute()
    assert [a.stage for a in took] == ["validate"] and "completeness" in took[0].text()


def test_stages_wait_and_go_on(spark, tmp_path):
    waits, calls = [], []

    def flaky(s, d):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("again")
        return d

    run = Run(spark, "r", str(tmp_path), [("a", lambda s, d: s.range(3)), ("b", flaky)], pause=300, sleep=waits.append)
    assert run.execute().count() == 3 and waits == [300, 300]
    assert Run(spark, "r", str(tmp_path), [("a", flaky), ("b", flaky), ("c", lambda s, d: d.limit(1))]).execute().count() == 1 and len(calls) == 3


def test_training_registers_the_baseline(spark, tmp_path):
    facts, filings = synthetic.corpus(spark, 30, 3)
    models = registry.Registry(str(tmp_path))
    got = batch.train(facts, filings, models, promote=True, trees=40, provenance=registry.provenance())
    assert models.production() == got.version and got.metrics["roc_auc"] > 0.7 and got.metrics["mean_score_corrupted"] > got.metrics["mean_score_clean"]
    base = warehouse.baseline(spark, models.folder(got.version))
    assert base.count() == models.metadata(got.version)["n_training_filings"] and warehouse.baseline(spark, str(tmp_path / "none")) is None
    rows, run, said = batch.score_stage(spark, facts, filings, models, "r", T0)
    assert said["scored"] == 90 and said["drift_level"] in ("OK", "WARN", "ALERT") and run.first()["model_version"] == got.version
    (tmp_path / got.version / "model.json").write_text("{}")
    rows, run, said = batch.score_stage(spark, facts, filings, models, "r", T0)
    assert rows is None and "changed" in said["reason"]
    assert batch.score_stage(spark, facts, filings, registry.Registry(str(tmp_path / "x")), "r", T0)[2]["reason"]


def test_alerts_are_independent(caplog):
    took = []

    def broken(alert):
        raise OSError("down")

    a = alerts.Alert("r", "parse", "boom", 3, {"host": "h"})
    assert alerts.dispatch(a, {"one": broken, "two": took.append}) == ["two"] and took == [a]
    assert alerts.dispatch(a, {"one": broken}) == [] and "boom" in caplog.text
    posted = []
    alerts.webhook("u", lambda url, body: posted.append(json.loads(body)) or 200)(a)
    assert "parse" in posted[0]["text"]
    with pytest.raises(OSError):
        alerts.webhook("u", lambda url, body: 500)(a)
    assert set(alerts.channels({"ALERT_WEBHOOK_URL": "u", "SMTP_HOST": "h"})) == {"webhook"} and set(alerts.channels({"SMTP_HOST": "h", "ALERT_EMAIL_TO": "t"})) == {"mail"}
    assert alerts.first_failed([{"stage": "a", "status": "completed"}, {"stage": "b", "status": "failed"}]) == "b" and alerts.first_failed([]) == "unknown"
    sent = []

    class Server:
        def __init__(self, *a, **k):
            pass

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def send_message(self, m):
            sent.append(m["Subject"])

    alerts.mail("h", "t", "f", connect=Server)(a)
    assert sent == ["Stage parse failed in run r"]


def test_log_appends_and_shows_tampering(spark, tmp_path):
    log = audit.Log(spark, str(tmp_path / "chain"))
    row = {"run_id": "r", "system_id": audit.system_id({}), "stage": "parse", "extraction_status": "success", "detail": None, "content_hash": None, "created_at": T0}
    assert audit.tail(log.read()) == (0, None) and log.append([]) == []
    log.append([row | {"accession_number": x} for x in "cab"])
    log.append([row | {"accession_number": "d"}])
    assert [(r["id"], r["accession_number"]) for r in log.read().orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    v = log.verify().first()
    assert v["valid"] and v["total_rows"] == v["checked"] == 4
    bad = log.read().withColumn("detail", F.when(F.col("id") == 3, "x").otherwise(F.col("detail")))
    v = audit.verify(bad, audit.row_hash(F.coalesce("prev_row_hash", F.lit("")))).first()
    assert (v["valid"], v["broken_at"], v["broken_reason"], v["checked"]) == (False, 3, "content", 3)
    assert audit.system_id({"PIPELINE_SYSTEM_ID": "me"}) == "me"


def test_fold_streams_a_long_chain(spark):
    import hashlib

    rows = spark.range(25_000).select((F.col("id") % 2).alias("c"), "id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("p"))
    got = {r["id"]: r["row_hash"] for r in audit.fold(rows.repartition(5), "c", "id", F.col("p")).collect()}
    last = ["", ""]
    for i in range(25_000):
        last[i % 2] = hashlib.sha256(f"p{i}\x1f{last[i % 2]}".encode()).hexdigest()
        assert got[i] == last[i % 2]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranked_ranges(spark, by):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 500).alias("v"), F.lit(2).alias("n")).repartition(6)
    got = ranks.running_total(rows, by, "v", "n", "upto").collect()
    assert all(r["upto"] == 2 * sum(1 for x in got if x["v"] <= r["v"] and (not by or x["g"] == r["g"])) for r in got[:60])
    before = {(r["g"], r["v"]): r["b"] for r in ranks.previous(rows, "v", "v", "b", by[0] if by else None).collect()}
    for g in range(3):
        own = sorted(v for h, v in before if not by or h == g)
        assert all(before[k] == (None if (i := own.index(k[1])) == 0 else own[i - 1]) for k in before if not by or k[0] == g)
    assert [r["v"] for r in ranks.numbered(rows, ["v"], "k").orderBy("k").collect()] == list(range(500))


def test_answers(spark, tmp_path):
    facts = facts_table(spark, [("a", "us-gaap:Revenues", 5.0, DAY, None), ("a", "us-gaap:Assets", 9.0, DAY, None)])
    html = "<p>Item 1A. Risk Factors.</p><p>Our harbour cranes may rust in salty winter storms.</p>"
    filings = filings_table(spark, [("a", DAY, html, "r"), ("b", DAY - timedelta(days=1), "", "r")])
    page = answers.as_document(answers.filings(filings, "aaa", 1))
    assert (page["ticker"], page["total"], page["limit"], [x["accession_number"] for x in page["items"]], page["items"][0]["filing_date"]) == ("AAA", 2, 1, ["a"], "2024-06-01")
    one = answers.as_document(answers.filing(facts, filings, "a"))
    assert [f["fact_name"] for f in one["facts"]] == ["us-gaap:Assets", "us-gaap:Revenues"] and one["facts"][1]["fact_value"] == 5.0
    with pytest.raises(serve.NotFound):
        answers.filing(facts, filings, "zz")
    assert answers.as_document(answers.series(facts, filings, "AAA", "us-gaap:Assets"))["series"][0]["period_end"] == "2024-06-01"
    said = answers.as_document(answers.ask(filings, "AAA", "Will harbour cranes rust in winter storms?", base="http://x"))
    assert said["grounded"] and said["citations"][0]["source_url"] == "http://x/1/a/" and "cranes" in said["answer"]
    with pytest.raises(serve.NotFound):
        answers.ask(filings, "ZZZ", "?")
    assert answers.trigger(filings, "aaa")["cik"] == "1" and answers.trigger(filings, "zz", lambda t, c: "run-1")["message"].startswith("run run-1")
    assert answers.health(spark) == {"status": "ok", "database": "ok", "cache": "disabled"} and answers.health(spark, lambda: 1 / 0)["cache"] == "unavailable"
    models = registry.Registry(str(tmp_path))
    with pytest.raises(serve.NotFound):
        answers.current_model(models)
    v = models.register("{}", {"seed": 1})
    models.promote(v)
    assert answers.current_model(models)["verified"]
    (tmp_path / v / "model.json").write_text("changed")
    assert not answers.current_model(models)["verified"]
    log = spark.createDataFrame([(i, "r", "s", "a", "parse", "success", None, None, None, f"h{i}", T0) for i in range(3)], CHAIN_AUDIT)
    got = answers.as_document(answers.audit(log, "a", 2))
    assert got["total"] == 3 and [x["id"] for x in got["items"]] == [2, 1] and got["items"][0]["created_at"] == "2024-03-01T12:00:00Z"


def test_anomaly_answer(spark):
    scores = spark.createDataFrame([(1, 1, "a", 0.9, True, '[{"rule_id":"r","severity":0.5,"message":"m"}]'), (2, 1, "a", 0.4, False, "{broken"), (3, 1, "b", 0.7, True, None)], "id bigint, model_run_id bigint, accession_number string, score double, is_anomaly boolean, rule_violations string")
    filings, made = filings_table(spark, [("a", DAY, "x", "r"), ("b", DAY, "x", "r")]), spark.createDataFrame([(1, "v1")], "id bigint, model_version string")
    got = answers.as_document(answers.anomalies(scores, filings, made, "AAA"))
    assert got["total"] == 2 and [(x["accession_number"], x["rule_violations"], x["model_version"]) for x in got["items"]] == [("b", [], "v1"), ("a", [], "v1")]
    assert answers.as_document(answers.anomalies(scores, filings, made, "AAA", 0.5))["total"] == 1


def test_cache(spark, tmp_path):
    c = warehouse.Cache(spark, str(tmp_path / "cache"))
    rows = spark.createDataFrame([("AAA", 1), ("BBB", 2)], "ticker string, v int")
    assert c.get("id", "ticker", "AAA", T0) is None and not c.ping() and c.left("id", "ticker", "AAA", T0) == -2
    c.put("id", rows, T0)
    c.put("id", rows.withColumn("v", F.col("v") + 10), T0 + timedelta(seconds=60))
    assert c.ping() and [r["v"] for r in c.get("id", "ticker", "AAA", T0 + timedelta(seconds=61)).collect()] == [11]
    assert c.left("id", "ticker", "AAA", T0 + timedelta(seconds=100)) == 3560
    assert c.get("id", "ticker", "AAA", T0 + timedelta(hours=2)) is None and c.left("id", "ticker", "AAA", T0 + timedelta(hours=2)) == -2
    c.evict("id")
    assert c.get("id", "ticker", "AAA", T0) is None


def test_warehouse_scans(spark):
    filings = filings_table(spark, [("a", DAY, "x", "r"), ("b", DAY - timedelta(days=9), "", "r"), ("c", DAY - timedelta(days=99), None, "r")])
    facts = facts_table(spark, [(a, "f", 1.0, DAY, None) for a in "aabbc"])
    assert [r[0] for r in warehouse.raw_html(filings, filings).collect()] == ["a"]
    assert warehouse.metadata(filings, facts.filter("accession_number = 'c'")).columns == list(warehouse.METADATA)
    count = lambda **k: (warehouse.training(filings, facts, **k)[0].count(), warehouse.training(filings, facts, **k)[1].count())
    assert count() == (5, 3) and count(since=DAY - timedelta(days=9)) == (4, 2) and count(limit=1) == (2, 1)
    mock_filings, mock_facts = warehouse.mock(spark)
    assert rules.evaluate(features.build(mock_facts, mock_filings)).filter("rule_score > 0").count() == 0


def test_features_by_name(spark):
    facts, filings = synthetic.corpus(spark, 3, 2)
    matrix = features.build(facts, filings)
    one = matrix.first()["accession_number"]
    assert features.column(matrix, "leverage").count() == 6 and features.row(matrix, one)["required_coverage"] == 1.0
    for bad in (lambda: features.column(matrix, "nope"), lambda: features.row(matrix, "nope")):
        with pytest.raises(KeyError):
            bad()
    held = features.by_concept(facts).first()["facts"]
    assert len(held) == 7 and held["Assets"] > 0


def test_corruption_is_spread_by_hash(spark):
    facts, _ = synthetic.corpus(spark, 200, 2)
    kind = detector.corruption(F.col("accession_number"), 0.2, 7)
    hit = facts.select("accession_number").distinct().select(kind["kind"].alias("k"))
    by = dict(hit.groupBy("k").count().collect())
    assert 40 < sum(n for k, n in by.items() if k) < 120 and set(by) == {None, *detector.KINDS}
    broken = detector.with_corruption(facts)
    changed = facts.withColumn("fact_value", F.col("fact_value").cast("double")).exceptAll(broken).select("accession_number").distinct().count()
    assert changed == sum(n for k, n in by.items() if k)
    with pytest.raises(ValueError):
        detector.corruption(F.lit("a"), 1.0, 7)


def test_texts_round_half_to_even(spark):
    r = spark.range(1).select(S.percent_text(F.lit(0.125)).alias("a"), S.percent_text(F.lit(0.135), 0).alias("b"), S.percent_text(F.lit(-0.0525), 1, plus=True).alias("c"), S.fixed_text(F.lit(2.5), 0).alias("d"), S.percent_text(F.lit(None).cast("double")).alias("e"), S.as_date(F.lit("2024-02-30")).alias("f"), S.as_date(F.lit(T0)).alias("g"), S.undashed(F.lit("0-1-2")).alias("h")).first()
    assert tuple(r) == ("12%", "14%", "-5.2%", "2", None, None, date(2024, 3, 1), "012")


def test_case_results(spark):
    cases = spark.createDataFrame([(1, "q", True, "a", ["cranes"]), (2, "q", True, "z", None), (3, "q", False, None, None)], retrieve.CASES)
    given = spark.createDataFrame([(1, True, [(1, "a", "s", "Harbour CRANES rust", 0.5)]), (2, True, [(1, "a", "s", "x", 0.5)])], "item_id bigint, grounded boolean, citations array<struct<rank:int,accession_number:string,section:string,snippet:string,score:double>>")
    got = retrieve.case_results(cases, given)
    assert [(r["item_id"], r["grounded"], r["hit"], r["valid"]) for r in got.orderBy("item_id").collect()] == [(1, True, True, True), (2, True, False, True), (3, False, False, False)]
    e = retrieve.evaluation(got.withColumn("latency_ms", F.lit(4.0))).first()
    assert (e["mean_latency_ms"], e["recall_at_k"], e["citation_validity"], e["grounding_accuracy"]) == (4.0, 0.5, 1.0, 1.0)


def test_search_url():
    assert payloads.search_url("http://s", "a b", "10-K", "2024-01-01", "2024-02-01") == "http://s?q=%22a%20b%22&forms=10-K&dateRange=custom&startdt=2024-01-01&enddt=2024-02-01"
    assert payloads.search_url("http://s", "a") == "http://s?q=%22a%22"


def test_views_and_table_functions(spark, tmp_path):
    facts, filings = synthetic.corpus(spark, 4, 3)
    names = views.up(spark, {"financial_facts": facts, "filings_raw": filings})
    got = spark.sql("select cik, fiscal_year, revenue, prior_year_revenue, revenue_yoy_growth_pct from mart_company_yoy order by cik, fiscal_year").collect()
    assert len(got) == 12 and got[0]["prior_year_revenue"] is None and got[1]["prior_year_revenue"] == got[0]["revenue"] and -6.01 <= float(got[1]["revenue_yoy_growth_pct"]) <= 14.01
    assert spark.sql("select * from anomaly_scores").count() == 0 and set(names) >= set(views.MARTS)
    spark.createDataFrame([("a", DOC), ("b", None)], "accession string, html string").createOrReplaceTempView("documents_in")
    rows = spark.sql("select f.fact_name, f.fact_value, f.period_end from documents_in d, lateral ixbrl_facts(d.accession, d.html) f order by f.ord").collect()
    assert [(r["fact_name"], int(r["fact_value"])) for r in rows] == [("us-gaap:Revenues", 100), ("us-gaap:NetIncomeLoss", 10), ("us-gaap:Assets", 200)]
    views.down(spark)
    assert not spark.catalog.tableExists("mart_company_yoy")


def test_an_answer_may_be_worded_anew(spark):
    filings = filings_table(spark, [("a", DAY, "<p>Harbour cranes may rust in salty winter storms.</p>", "r")])
    ask = lambda f: answers.ask(filings, "AAA", "Do harbour cranes rust in winter storms?", rephrase=f).first()["answer"]
    assert ask(lambda t: "anew") == "anew" and "cranes" in ask(lambda t: 1 / 0)


def test_storage(spark, tmp_path):
    to = str(tmp_path / "x.txt")
    assert storage.read_text(spark, to) is None
    storage.write_text(spark, to, "é1")
    storage.write_text(spark, to, "é2")
    assert storage.read_text(spark, to) == "é2" and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.txt"]
    (tmp_path / "f").write_bytes(b"abc")
    assert registry.file_sha256(str(tmp_path / "f"), 2) == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_commands(spark, tmp_path, capsys):
    tables = ["--tables", str(tmp_path / "w")]
    assert cli.main(["runs", *tables], spark) == 0 and cli.main(["verify", *tables], spark) == 2
    assert cli.main(["train", *tables, "--synthetic", "--companies", "12", "--years", "3", "--models", str(tmp_path / "m"), "--metrics-out", str(tmp_path / "new.json"), "--promote"], spark) == 0
    assert registry.Registry(str(tmp_path / "m")).production()
    good = {"recall": 0.7, "precision": 0.5, "f1": 0.6, "flag_rate": 0.1, "roc_auc": 0.9}
    (tmp_path / "good.json").write_text(json.dumps(good))
    (tmp_path / "bad.json").write_text(json.dumps(good | {"recall": 0.1}))
    assert cli.main(["gate", str(tmp_path / "good.json"), "--summary", str(tmp_path / "s.md")]) == 0 and "passed" in (tmp_path / "s.md").read_text()
    assert cli.main(["gate", str(tmp_path / "bad.json"), "--before", str(tmp_path / "good.json")]) == 1 and cli.main(["gate", str(tmp_path / "none.json")]) == 2
    audit.Log(spark, str(tmp_path / "w" / "chain")).append([{"run_id": "r", "system_id": "s", "accession_number": "a", "stage": "parse", "extraction_status": "success", "created_at": T0}])
    assert cli.main(["verify", *tables], spark) == 0 and "the chain holds" in capsys.readouterr().out
    target = Snapshot(spark, str(tmp_path / "w" / "facts"), FACTS)
    target.replace(facts_table(spark, [("a", PREFIX + "Revenues", 1.0, DAY, None)]))
    Snapshot(spark, str(tmp_path / "w" / "filings"), FILINGS).replace(filings_table(spark, [("a", DAY, "x", "run")]))
    assert cli.main(["validate", "run", *tables, "--as-of", "2024-06-01"], spark) == 1
    (tmp_path / "p.json").write_text(json.dumps(PAYLOAD))
    assert cli.main(["backfill", str(tmp_path / "p.json"), *tables, "--base", "http://x", "--start", "2023-01-01", "--end", "2023-12-31", "--dry-run"], spark) == 0
    assert cli.main(["demo", *tables, "--companies", "6", "--years", "3"], spark) == 0
