"""Every catalogue query against its SQL counterpart in another engine."""

import collections
import decimal
import math

import duckdb
import pytest
import regex

from factloom.operators import features, retrieve, rules
from factloom.plans import catalogue
from factloom.sources import synthetic

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return None if isinstance(v, float) and math.isnan(v) else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(spark, duck, sf, name):
    df = catalogue.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    q = duck.execute(catalogue.oracle_sql()[name])
    names = [x[0] for x in q.description]
    assert sorted(names) == columns
    want = ordered([tuple(plain(r[names.index(c)]) for c in columns) for r in q.fetchall()])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, sf, name):
    assert catalogue.queries()[name](spark, sf).count() > 0


def test_entry_module_imports():
    import __spark_entry__ as e

    assert set(catalogue.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.fixture
def asked(spark, tmp_path):
    """Documents and questions in any script; of each question but the last, one document holds the terms."""
    docs = [(1, "Die Übernahme der Mühle wurde geprüft. Ärger blieb aus."), (2, "Le café naïf était fermé."), (3, "Plain words about harbour cranes."), (4, "Harbour cranes: 5 € each."), (5, "Other plain matter.")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "Übernahme der Mühle. Mehr"), (2, "café naïf"), (3, "zebra migrations")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_answers_from_documents_in_any_script(spark, asked):
    got = {r["item_id"]: r for r in catalogue.queries()["grounded_answers"](spark, asked).collect()}
    assert {i: [c["accession_number"] for c in r["citations"]] for i, r in got.items()} == {1: ["1"], 2: ["2"]}
    assert all(r["grounded"] for r in got.values())
    r = catalogue.queries()["rag_eval"](spark, asked).first()
    assert r["recall_at_k"] == pytest.approx(2 / 3) and r["grounding_accuracy"] == pytest.approx(2 / 3)


def test_a_hit_has_all_terms_of_the_question(spark, tmp_path):
    docs = [(1, "The harbour cranes were painted blue."), (2, "Granite quarries reopened. In spring, the owners said so.")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cases = [(1, "The harbour cranes sank in fog."), (2, "Owners said spring quarries reopened.")]
    spark.createDataFrame(cases, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert catalogue.queries()["rag_eval"](spark, str(tmp_path)).first()["recall_at_k"] == pytest.approx(0.5)


def test_questions_that_share_only_a_prefix_are_no_hits(spark, tmp_path):
    spark.createDataFrame([(1, "The harbour cranes were painted blue.")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "The harbour cranes sank in fog.")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert catalogue.queries()["rag_eval"](spark, str(tmp_path)).first()["recall_at_k"] == 0


def brute_terms(text):
    """Words of two word characters at least without stop words, then pairs of neighbours."""
    own = [w for w in regex.findall(r"\b\w\w+\b", text.lower()) if w not in retrieve.LEFT_OUT]
    return own + [f"{a} {b}" for a, b in zip(own, own[1:])]


@pytest.fixture(scope="module")
def posted(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    return {i: collections.Counter(brute_terms(t)) for i, t in docs.items()}


def brute_weights(counts, df, n):
    raw = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in counts.items() if t in df}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in raw.items()}


def test_tokens_of_whole_documents(spark, sf, posted):
    got = collections.defaultdict(dict)
    for r in catalogue.queries()["tokens"](spark, sf).collect():
        got[r["doc_id"]][r["term"]] = r["tf"]
    assert got == {i: dict(c) for i, c in posted.items() if c}


def test_weights_and_best_documents(spark, sf, posted):
    df = collections.Counter(t for c in posted.values() for t in c)
    n = sum(1 for c in posted.values() if c)
    index = {i: brute_weights(c, df, n) for i, c in posted.items() if c}
    rows = catalogue.queries()["tfidf_weights"](spark, sf).collect()
    assert len(rows) == sum(len(c) for c in index.values())
    assert all(abs(index[r["doc_id"]][r["term"]] - r["weight"]) < 2e-9 for r in rows)
    best = collections.defaultdict(dict)
    for r in catalogue.queries()["cosine_topk"](spark, sf).collect():
        best[r["item_id"]][r["rank"]] = (r["doc_id"], r["score"])
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    for item in items:
        q = brute_weights(collections.Counter(brute_terms(item["text"])), df, n)
        scores = {i: round(sum(w * q.get(t, 0) for t, w in d.items()), 9) for i, d in index.items()}
        want = sorted((-s, i) for i, s in scores.items() if s)[:5]
        assert [round(-s, 6) for s, _ in want] == pytest.approx([best[item["item_id"]][k + 1][1] for k in range(len(want))], abs=2e-6)


def test_best_sentence_against_brute_force(spark, sf):
    wanted = [w for w in regex.findall("[a-z0-9]+", "what with that this ththtion") if len(w) > 2]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in catalogue.queries()["best_sentence"](spark, sf).collect():
        text = texts[r["doc_id"]]
        parts = [s for s in (x.strip(" ") for x in regex.split(r"(?<=[.!?])[ \t\n\x0B\f\r]+", text)) if s]
        scores = [len(set(wanted) & set(regex.findall("[a-z0-9]+", s.lower()))) for s in parts]
        want = text if len(parts) <= 1 or not max(scores) else " ".join(parts[scores.index(max(scores)) :])
        assert r["window"] == want


def test_corruption_and_features_agree(spark, sf):
    """Filings that weren't hit break no more rules than on the clean corpus."""
    clean = {r["accession_number"]: r["rule_score"] for r in rules.evaluate(features.build(*synthetic.corpus(spark, 40, 4))).collect()}
    got = catalogue.queries()["corruption"](spark, sf).collect()
    assert len(got) == len(clean) == catalogue.queries()["synthetic_features"](spark, sf).count()
    assert any(r["corrupted"] and r["rule_score"] > 0 for r in got) and all(s <= 0.6 for s in clean.values())
