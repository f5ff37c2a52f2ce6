"""Scores where documents lie, against the joins; skewed keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyloom.functions import fixed
from storyloom.functions import text as T
from storyloom.operators import maps, retrieval, scoring, topics
from storyloom.plans import catalogue


def test_rounded_like_spark(spark):
    x = [0.12345, 0.00005, 0.00015, 1.00005, 0.99995, 2 / 3, 0.28925000000000006]
    want = [r["y"] for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double").select("i", F.round("x", 4).alias("y")).orderBy("i").collect()]
    assert (scoring.rounded(np.array(x), 4) / 1e4).tolist() == want


def test_top_documents_like_the_joins(spark, monkeypatch):
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice(["claim", "network", "ledger", "zebra", "policy", "agent"]) for _ in range(n))
    docs = spark.createDataFrame([(i, some(rng.randint(0, 9))) for i in range(300)] + [(998, None), (999, "")], "d long, text string").repartition(5)
    asked = spark.createDataFrame([(f"q{i}", some(rng.randint(0, 4))) for i in range(12)] + [("none", "unheard")], "q string, text string")
    local = [retrieval.top_documents(docs, asked, "q", "d", "text", "text", 4), retrieval.top_bm25(docs, asked, "q", "d", "text", "text", 4)]
    assert all("FlatMapGroups" not in x._jdf.queryExecution().toString() for x in local)
    got = [sorted(map(tuple, x.collect())) for x in local]
    monkeypatch.setattr(retrieval, "HELD", 0)
    want = [retrieval.top_documents(docs, asked, "q", "d", "text", "text", 4), retrieval.top_bm25(docs, asked, "q", "d", "text", "text", 4)]
    assert got == [sorted(map(tuple, x.select(*y.columns).collect())) for x, y in zip(want, local)] and got[0] and got[1]


def some_texts(spark, seed, words):
    """Few words, so that there are many ties, one that every document has, and one in a document only."""
    rng = random.Random(seed)
    words = [f"word{chr(97 + i)}" for i in range(words)]
    docs = [(i, "common " + " ".join(rng.choices(words, k=rng.randrange(9)))) for i in range(200)] + [(900, None), (901, ""), (902, "lonely"), (903, "common lonely single")]
    asked = [(i, " ".join(rng.choices([*words, "common", "lonely", "unheard"], k=rng.randrange(1, 7)))) for i in range(25)] + [(90, ""), (91, None), (92, "common"), (None, "common")]
    return spark.createDataFrame(docs, "d long, text string").repartition(5), spark.createDataFrame(asked, "q long, text string")


def all_pairs(d, a, k):
    postings, idf = retrieval.weights(d, "d", "text")
    return sorted(map(tuple, retrieval.matches(retrieval.cosine(retrieval.weights(a, "q", "text", idf)[0], postings, "q", "d"), None, "q", "d", k).collect()))


@pytest.mark.parametrize(("words", "k", "common"), [(6, 1, 400_000), (20, 5, 3), (26, 5, 400_000)])
def test_top_essential_like_all_pairs(spark, monkeypatch, words, k, common):
    """Essential postings are read where documents lie: the rows of all pairs, and no pair or posting goes through a join."""
    d, a = some_texts(spark, words, words)
    monkeypatch.setattr(topics, "COMMON", common)
    got, reads = retrieval.top_essential(d, a, "q", "d", "text", "text", k)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString() and got.columns == ["q", "d", "sim", "rank"]
    assert sorted(map(tuple, got.collect())) == all_pairs(d, a, k)
    r = reads.head()
    assert 0 < r["read"] <= r["postings"]


def test_top_essential_by_joins(spark, monkeypatch):
    """Documents that share an id, and queries that workers can't hold; no queries at all."""
    d, a = some_texts(spark, 1, 6)
    twice = d.unionByName(spark.createDataFrame([(1, "common worda wordb")], d.schema))
    assert sorted(map(tuple, retrieval.top_essential(twice, a, "q", "d", "text", "text")[0].collect())) == all_pairs(twice, a, 5)
    assert retrieval.top_essential(d, a.limit(0), "q", "d", "text", "text")[0].count() == 0
    monkeypatch.setattr(retrieval, "HELD", 0)
    assert sorted(map(tuple, retrieval.top_essential(d, a, "q", "d", "text", "text")[0].collect())) == all_pairs(d, a, 5)


def test_essential_postings_are_few(spark):
    docs = [(i, f"alpha beta gamma delta number{chr(97 + i % 26)}{chr(97 + i // 26)} " + "filler " * (i % 7)) for i in range(400)]
    asked = spark.createDataFrame([(0, "alpha beta filler numberab"), (1, "gamma filler numberbc numberca")], "q long, text string")
    got, reads = retrieval.top_essential(spark.createDataFrame(docs, "d long, text string"), asked, "q", "d", "text", "text", 1)
    r = reads.head()
    assert r["read"] < r["postings"] / 10 and {(x["q"], x["rank"]) for x in got.collect()} == {(0, 1), (1, 1)}


def test_the_essential_query_joins_no_pairs(spark):
    """The catalogue's query: its rows come from a map over documents, not from a join of postings."""
    plan = catalogue.QUERIES["tfidf_cosine_essential"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_terms_like_the_columns(spark):
    docs = spark.createDataFrame([(1, "The Claim claim of é networks x ab abc"), (2, None), (3, "")], "d int, text string")
    stop = fixed.STOP_WORDS["retrieval"]
    got = {r["d"]: sorted(map(tuple, r["terms"])) for r in topics.term_rows(docs, "d", "text", stop).collect()}
    assert got == {r["d"]: sorted(map(tuple, r["t"])) for r in docs.select("d", T.frequencies(T.terms(F.col("text"), stop)).alias("t")).collect()}


def test_terms_without_plural_are_dealt(spark):
    """No join key of the counts is null where a term doesn't fold."""
    docs = spark.createDataFrame([(1, "claims claim glass"), (2, "claims network")], "doc_id int, text string")
    folded = topics.fold_plurals(topics.term_counts(docs))
    assert sorted((r["doc_id"], r["term"], r["tf"]) for r in folded.collect()) == [(1, "claim", 2), (1, "glass", 1), (2, "claim", 1), (2, "network", 1)]
    assert "__cut" not in folded._jdf.queryExecution().toString()


def test_edges_of_one_prefix_are_dealt(spark):
    stories = spark.createDataFrame([("AA-1", "see AA-2 and BB-1", "s"), ("AA-2", "AA-7", "s")], "story_id string, solution string, sprint string").withColumns({c: F.lit("") for c in ("acceptance_criteria", "summary")})
    edges = maps.reference_edges(stories, known_only=True)
    assert sorted((r["from"], r["to"]) for r in edges.collect()) == [("AA-1", "AA-2"), ("AA-2", "AA-7")]
    assert "salt" in edges._jdf.queryExecution().toString()
