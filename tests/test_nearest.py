"""Best chunks without a table of postings, against postings of every chunk."""

import os

import pytest
from pyspark.sql import functions as F

from factloom import storage
from factloom.operators import chunks, nearest, retrieve
from factloom.plans import catalogue

ODD = [
    (None, "Harbour cranes rust in winter storms."),
    (900001, "Harbour cranes rust in winter storms."),
    (900002, "Ωδός ΟΔΟΣ İTEM 7 item 1a. Harbour ² ½ áb \U0001d7d8\U0001d7d9 Ⓐⓑ cranes\nrust."),
    (900003, ""),
    (900004, None),
    (900005, "Item 1A. Harbour cranes. ITEM 7 Winter storms " + "and other harbours " * 200),
]


def by_postings(docs, asked, k):
    cut = chunks.chunked(docs, "doc_id", "text").withColumn("chunk_id", F.concat_ws("#", "doc_id", "chunk_index"))
    post = retrieve.postings(cut, "chunk_id", "text")
    idfs = retrieve.idf(post, "chunk_id")
    top = retrieve.cosine_topk(retrieve.weights(post, idfs, "chunk_id"), retrieve.weights(retrieve.postings(asked, "item_id", "question"), idfs, "item_id"), "chunk_id", "item_id", k)
    return top.join(cut.select("chunk_id", "doc_id", "section", "text"), "chunk_id")


@pytest.fixture(scope="module")
def case(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(ODD, "doc_id bigint, text string"))
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", F.substring_index("text", ".", 1).alias("question"))
    asked = asked.unionByName(spark.createDataFrame([(7001, "harbour cranes in winter storms"), (7001, "rust"), (7002, "οδός áb ²"), (7003, "zzzz"), (7004, ""), (None, "rust")], "item_id bigint, question string")).localCheckpoint()
    return docs, asked, {(r["item_id"], r["rank"]): r for r in by_postings(docs, asked, 5).collect() if r["item_id"] is not None}


@pytest.mark.parametrize("bounds", [{}, {"bits": 6, "first": 6, "at_once": 10, "slice_terms": 5000}])
def test_same_chunks_as_by_postings(spark, case, bounds):
    docs, asked, want = case
    got = {(r["item_id"], r["rank"]): r for r in nearest.best_chunks(docs, "doc_id", "text", asked, "item_id", "question", 5, **bounds).collect()}
    assert got.keys() == want.keys()
    for at, r in want.items():
        assert [got[at][c] for c in ("chunk_id", "doc_id", "section", "text")] == [r[c] for c in ("chunk_id", "doc_id", "section", "text")]
        assert got[at]["score"] == pytest.approx(r["score"], abs=1.1e-9)


def test_rows_of_one_id_are_separate(spark):
    docs = spark.createDataFrame([(1, "Harbour cranes."), (1, "Granite quarries."), (2, "Plain words."), (None, "Harbour storms."), (None, "Plain storms.")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(1, "granite"), (2, "storms")], "item_id bigint, question string")
    got = nearest.best_chunks(docs, "doc_id", "text", asked, "item_id", "question", 5).collect()
    assert sorted((r["item_id"], r["text"]) for r in got) == [(1, "Granite quarries."), (2, "Harbour storms."), (2, "Plain storms.")]


def stored_bytes(spark):
    root = storage.root(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(root) for f in files)


@pytest.mark.parametrize("name", ["grounded_answers", "rag_eval"])
def test_stores_less_than_the_documents(spark, name):
    sf = "/root/testdata/sf0.01"
    before = stored_bytes(spark)
    assert catalogue.queries()[name](spark, sf).count() > 0
    assert stored_bytes(spark) - before < os.path.getsize(f"{sf}/documents.parquet")
