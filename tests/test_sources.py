"""Readers and parsers on small files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from storyloom import config
from storyloom.sources import html, metadata, responses, stories, tables, transcripts, usage

STORY = """# INS-0001: pay claims: fast
\r
- **Status**: Done
- **Components**: A, B
- **Epic**:
- **Status**: In Progress

## Description

As a claims clerk, I want end-to-end payment of every claim.

## Solution

- **Owner**: nobody

## Description

The second one stands here.
"""


def story_files(tmp_path):
    folder = tmp_path / "Sprint 10" / "stories"
    folder.mkdir(parents=True)
    (folder / "INS-0001.md").write_text(STORY, encoding="utf-8")
    (folder / "note.md").write_text("no title\n", encoding="utf-8")
    (tmp_path / "Sprint 2" / "stories").mkdir(parents=True)
    (tmp_path / "Sprint 2" / "stories" / "INS-0002.md").write_text("# INS-0002: zwölf\n", encoding="utf-8")
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.md").write_text("# X", encoding="utf-8")
    return str(tmp_path)


def test_markdown_stories(spark, tmp_path):
    found = {r["story_id"]: r for r in stories.parse(stories.scan(spark, story_files(tmp_path))).collect()}
    assert set(found) == {"INS-0001", "INS-0002", "note"}
    r = found["INS-0001"]
    assert (r["sprint"], r["sprint_no"], r["summary"]) == ("Sprint 10", 10, "pay claims: fast")
    assert r["metadata"]["Status"] == "In Progress" and r["metadata"]["Epic"] == "" and "Owner" not in r["metadata"]
    assert r["sections"]["Description"]["content"] == "The second one stands here." and r["sections"]["Description"]["word_count"] == 5
    assert r["estimated_tokens"] == int(r["total_word_count"] * 1.3)
    assert found["INS-0002"]["summary"] == "zwölf" and found["note"]["summary"] == ""
    only = stories.scan(spark, str(tmp_path), "Sprint 2").collect()
    assert len(only) == 1


def test_markdown_compat_reads_metadata_anywhere(spark, tmp_path):
    found = stories.parse(stories.scan(spark, story_files(tmp_path)), compat=True).where("story_id = 'INS-0001'").head()
    assert found["metadata"]["Owner"] == "nobody"


def test_retrieval_view_and_order(spark, tmp_path):
    (tmp_path / "Sprint 3" / "stories").mkdir(parents=True)
    (tmp_path / "Sprint 3" / "stories" / "INS-0003 note.md").write_text("# no id: here\n\n## Solution\n\nfixed\n\n## Other\n\nleft out\n", encoding="utf-8")
    files = stories.scan(spark, story_files(tmp_path))
    found = {r["story_id"]: r for r in stories.retrieval_view(files).collect()}
    assert set(found) == {"INS-0001", "INS-0002", "INS-0003", "note"}
    assert found["INS-0003"]["summary"] == "" and found["INS-0003"]["text"] == "INS-0003 fixed"
    assert found["INS-0001"]["summary"] == "pay claims: fast" and found["INS-0001"]["components"] == "A, B"
    order = [(r["ordinal"], r["sprint"]) for r in stories.in_order(files).orderBy("ordinal").collect()]
    assert [n for n, _ in order] == [1, 2, 3, 4] and [s for _, s in order] == sorted(s for _, s in order)


def test_markdown_round_trip(spark):
    rows = spark.createDataFrame([("A-1", "title: x", "Done", "Some text here.")], "story_id string, summary string, status string, d string")
    files = rows.select(F.lit("/Sprint 3/stories/A-1.md").alias("file_path"), F.lit(1).cast("bigint").alias("file_size"), F.lit("Sprint 3").alias("sprint"), stories.to_markdown(rows, {"Status": "status"}, {"Description": "d"}).alias("text"))
    r = stories.flat(stories.parse(files)).head()
    assert (r["story_id"], r["summary"], r["status"], r["description"], r["type"]) == ("A-1", "title: x", "Done", "Some text here.", "Story")


PAGE = """<html><table><tr><td>no</td></tr></table><table id="issuetable"><thead><tr><th>Key</th></tr></thead><tbody>
<tr class="issuerow" data-issuekey="INS-1"><td class="issuekey"><a>INS-1</a></td><td class="summary">Fish &amp; chips</td><td class="status">Done</td>
<td class="status">Open</td><td class="description">one<br>two<ul><li>three</li></ul><table><tr><td>inner</td></tr></table></td></tr>
<tr><td class="issuekey">INS-2</td><td class="summary">no class</td></tr>
<tr class="issuerow"><td class="summary">no key</td></tr></tbody></table></html>"""


def test_html_issue_table(spark, tmp_path):
    for sprint, names in (("Sprint 1", ["a", "b"]), ("Sprint 2", ["c"])):
        (tmp_path / sprint).mkdir()
        for n in names:
            (tmp_path / sprint / f"{n}.html").write_text(PAGE if n != "b" else "<p>nothing", encoding="utf-8")
    pages = html.scan(spark, str(tmp_path))
    assert pages.count() == 3 and html.scan(spark, str(tmp_path), first_only=True).count() == 2
    rows = html.fields_exact(html.issue_rows(pages.where("sprint = 'Sprint 1'"))).orderBy("issue_key").collect()
    assert [r["issue_key"] for r in rows] == [None, "INS-1"]
    assert rows[1]["summary"] == "Fish & chips" and rows[1]["status"] == "Done"
    assert rows[1]["description"].startswith("one\ntwo") and "- three" in rows[1]["description"] and "inner" in rows[1]["description"]
    hinted = html.fields_hinted(html.issue_rows(pages.where("sprint = 'Sprint 1'"), rich=False)).orderBy("issue_key").collect()
    assert [(r["issue_key"], r["summary"], r["sprint_no"]) for r in hinted] == [("INS-1", "Fish & chips", 1), ("INS-2", "no class", 1)]


def test_markdown_tables(spark, tmp_path):
    (tmp_path / "README.md").write_text("| a |\n|---|\n| 1 |\n")
    (tmp_path / "one.md").write_text("| Req | Story |\n|---|:--|\n| R1 | INS-1 |\n| R2 |\n\n| Test |\n|---|\n| T1 | more |\n")
    (tmp_path / "two.md").write_text("| Story | Owner |\n|---|---|\n| INS-2 | me |\n")
    rows = tables.header_union(tables.table_rows(tables.scan(spark, str(tmp_path))))
    assert rows.columns == ["Source", "Req", "Story", "Test", "Owner"]
    assert sorted(map(tuple, rows.collect())) == [("one.md", "", "", "T1", ""), ("one.md", "R1", "INS-1", "", ""), ("one.md", "R2", "", "", ""), ("two.md", "", "INS-2", "", "me")]
    cells = spark.range(1).select(tables.appendix_rows(F.lit("x\n| a | b |\n|---|---|\n| 1 | 2 |\n"), 2)).head()[0]
    assert cells == [["1", "2"]]
    assert spark.range(1).select(F.size(tables.appendix_rows(F.lit("x"), 2))).head()[0] == 0
    many = "| a |\n|---|\n" + "| 1 |\n" * 5000
    assert tables.table_rows(spark.createDataFrame([("m.md", many), ("n.md", None), ("o.md", "no table")], "source string, text string")).count() == 5000


def test_transcripts(spark, tmp_path):
    text = lambda role, *items: json.dumps({"role": role, "message": {"content": list(items)}})
    t = lambda s: {"type": "text", "text": s}
    (tmp_path / "c1" / "subagents").mkdir(parents=True)
    lines = [
        text("user", t("<timestamp>2025-01-02</timestamp><user_query>\nexplain story INS-12 in scripts/a.py </user_query>")), "", "{broken",
        json.dumps({"role": "user", "message": {"content": "plain"}}), text("user", t("ok")),
        text("assistant", t("an answer"), {"type": "tool_use", "name": "Read", "input": {"path": "/x/knowledge/a.md"}}, {"type": "tool_use", "name": "Shell", "input": {"command": "l" * 200}}),
    ]
    (tmp_path / "c1" / "c1.jsonl").write_text("\n".join(lines))
    (tmp_path / "c1" / "subagents" / "s.jsonl").write_text(text("user", t("which <b>component</b> is used?")))
    messages = transcripts.scan(spark, str(tmp_path))
    q = {r["conversation_id"]: r for r in transcripts.queries(messages).collect()}
    assert set(q) == {"c1", "s"} and q["s"]["is_subagent"] and q["s"]["query"] == "which component is used?"
    assert q["c1"]["query"] == "explain story INS-12 in scripts/a.py" and q["c1"]["timestamp"] == "2025-01-02"
    assert q["c1"]["stories"] == ["INS-12"] and q["c1"]["paths"] == ["scripts/a.py"]
    calls = transcripts.tool_calls(messages).orderBy("tool").collect()
    assert [(c["tool"], len(c["target"])) for c in calls] == [("Read", 17), ("Shell", 120)]
    assert transcripts.flat_queries(transcripts.queries(messages)).count() == 1
    assert transcripts.answers(messages).head()["chars"] == 9


def test_usage_csv(spark, tmp_path):
    head = "﻿Date,User,Kind,Model,Max Mode,Input (w/ Cache Write),Input (w/o Cache Write),Cache Read,Output Tokens,Total Tokens,Cost\n"
    (tmp_path / "a.csv").write_text(head + '2025-01-02T03:04:05.6Z,u,k,m,No,"1,234",3.0,5,6,7,0.5\nbad,u,k,m,No,1,2,3,4,5,6\n2025-01-02 03:04:05,u,k,m,No,1,2,3,4,7,x\n', encoding="utf-8")
    rows = usage.read(spark, usage.discover([str(tmp_path / "*.csv")])).orderBy("ts").collect()
    assert [(r["input_with_cache"], r["input_without_cache"], r["cost"]) for r in rows] == [(1, 2, 0.0), (1234, 0, 0.5)]
    assert str(rows[1]["day"]) == "2025-01-02" and rows[0]["source_file"] == "a.csv"


def test_metadata(spark, tmp_path):
    base = tmp_path / "force-app" / "main" / "objects"
    for name, xml in (("Claim_Line__c", '<CustomObject xmlns="urn:x"><label>Claim Line</label></CustomObject>'), ("ns__Thing__c", "<broken"), ("Alert__e", None)):
        (base / name / "fields").mkdir(parents=True)
        (base / name / "fields" / "A.field-meta.xml").write_text("<x/>")
        if xml:
            (base / name / f"{name}.object-meta.xml").write_text(xml)
    found = {r["api_name"]: r for r in metadata.object_dictionary(spark, str(tmp_path)).collect()}
    assert {k: (r["label"], r["category"], r["namespace"], r["field_count"]) for k, r in found.items()} == {
        "Claim_Line__c": ("Claim Line", "custom_object", None, 1), "ns__Thing__c": ("Thing", "managed_package", "ns", 1), "Alert__e": ("Alert", "platform_event", None, 1),
    }
    assert found["Claim_Line__c"]["search_variants"] == ["claim line", "claim_line", "claimline"] and found["Claim_Line__c"]["initials"] == "CL"
    counts = metadata.folder_counts(metadata.scan(spark, str(tmp_path))).collect()
    assert [(r["folder"], r["label"], r["files"]) for r in counts] == [("objects", "Custom Objects & Fields", 5)]


def test_responses(spark, tmp_path):
    term = '{"term": "A", "expansion": "a", "definition": "d", "category": "c"}'
    files = {
        "g-000": {"custom_id": "g-000", "status": "success", "output": "```json\n{\"terms\": [" + term + "]}\n```"},
        "g-001": {"custom_id": "g-001", "status": "success", "output": '{"terms": [' + term + ', {"term": "B'},
        "g-002": {"custom_id": "g-002", "status": "success", "output": "no json"},
        "g-003": {"custom_id": "g-003", "status": "failed", "error": "late"},
    }
    for n, v in files.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(v))
    rows = {r["custom_id"]: r for r in responses.read(spark, str(tmp_path), "glossary").collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"g-000": "success", "g-001": "success", "g-002": "error", "g-003": "failed"}
    assert [t["term"] for t in rows["g-001"]["parsed"]["terms"]] == ["A"] and rows["g-002"]["raw_text"] == "no json"
    assert responses.read(spark, str(tmp_path), "glossary", compat=True).where("custom_id = 'g-002'").head()["status"] == "success"
    assert responses.sidecar(spark, str(tmp_path / "none.json")) is None and responses.sidecar(spark, str(tmp_path / "g-003.json")).head()["error"] == "late"


def test_config(tmp_path):
    text = 'paths:\n  sprints: "s # x"  # note\nextraction:\n  batch_size: 7\n  retry_on:\n    - timeout\nflag: yes\n'
    (tmp_path / "workspace.config.yaml").write_text(text)
    (tmp_path / "a" / "b").mkdir(parents=True)
    got = config.load(str(tmp_path / "a" / "b"))
    assert got["extraction"]["batch_size"] == 7 and got["extraction"]["retry_on"] == ["timeout"] and got["paths"]["sprints"] == "s # x" and got["flag"] is True and got["extraction"]["model"] == "model" and got["root"] == str(tmp_path)
    for n in ("Sprint 10", "Sprint 2", "x"):
        (tmp_path / n).mkdir()
    assert config.sprint_folders(str(tmp_path)) == ["Sprint 2", "Sprint 10"]


def parsed_cells(page, rich):
    parser = html.IssueTable(rich)
    parser.feed(page)
    parser.close()
    return list(enumerate(parser.rows, 1))


@pytest.mark.parametrize("seed", range(60))
def test_plain_markup_like_the_parser(seed):
    """Pages of plain tags don't need the parser, any others do; the cells are the same."""
    rng = random.Random(seed)
    bits = ['<table id="issuetable">', "<table class='issue x'>", "</table>", '<tr class="issuerow odd">', "<tr>", "</tr>", '<td class="Status" data-id="a">', "<td>", "</td>", "<th class=\"k\">", "</th>", "<br/>", "<br />", "<p>", "<li >",
            "text", " a &amp; b", "&lt", "&#65;x &", "\xa0", "é", "1 > 2", "\n"]
    odd = ["<TD>", "<td class=x>", "<!-- <td> -->", "<script>", "</script>", "<td class=\"a&amp;b\">", "<", "<td", "</td x>", "<?x>", "<td hidden>", "<title>", "</ td>", "<a:b>"]
    for i in range(60):
        page = '<table id="issuetable"><tr class="issuerow"><td>' * rng.randrange(2) + "".join(rng.choices(bits + odd * (i % 2), k=rng.randrange(30)))
        for rich in (False, True):
            assert html.cells_of(page, rich) == parsed_cells(page, rich), page


def test_plain_pages_are_not_parsed(monkeypatch):
    monkeypatch.setattr(html.IssueTable, "feed", lambda *_: 1 / 0)
    assert html.cells_of(PAGE, True)[0][1][1] == {"class": "summary", "content": "Fish & chips"}


def test_hinted_fields_in_order(spark):
    """Each cell goes to one field, found once: the plan grows with the hints, not with their square."""
    cell = lambda c, x: {"class": c, "content": x}
    cells = [[cell("statuscategory", "no"), cell("status summary", "a"), cell("status", "b"), cell("issuekey", "none"), cell("issuekey", "see AB-1"), cell("issuekey", "AB-2"), cell("status", "c"), cell("acceptance", "")], [cell("summary", "x")], []]
    rows = spark.createDataFrame([("Sprint 4", c) for c in cells], "sprint string, cells array<struct<class:string,content:string>>")
    out = html.fields_hinted(rows)
    assert [(r["issue_key"], r["summary"], r["status"], r["ac"], r["components"], r["sprint_no"]) for r in out.collect()] == [("AB-1", "a", "b", "", None, 4)]
    assert out._jdf.queryExecution().analyzed().toString().count("contains(") < 30
