"""More of the reference questions on the tables at hand, registered beside those of the catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions import fixed, stats
from storyloom.functions import text as T
from storyloom.operators import conversations, lookups, maps, profile, retrieval, sketches, topics
from storyloom.operators.phrases import mentions
from storyloom.plans import extraction
from storyloom.plans.catalogue import EDGES, NAMED, QUANTILE, SCORE, WORDS, _intents_sql, as_stories, component_rows, named_objects, query, questions, quoted, referring, scored, table, tokens_sql
from storyloom.sources import html, transcripts
from storyloom.tables import shared

# --- sources ----------------------------------------------------------------


def issue_pages(spark, sf_dir: str, rich: bool) -> DataFrame:
    """An export for each customer: a table of their orders, with lines and lists inside the cells."""
    orders = table(spark, sf_dir, "orders")
    text = lambda c: F.col(c).cast("string")
    cell = lambda cls, *parts: F.concat(F.lit(f'<td class="{cls}">'), *(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit("</td>"))
    key = F.concat(F.lit("ORD-"), text("o_orderkey"))
    if rich:
        cells = [cell("issuekey", '<a href="/x">', key, "</a>"), cell("summary", "Order of &amp; for ", text("o_custkey")), cell("status", "<span> ", F.col("o_orderstatus"), " </span>"), cell("priority", F.col("o_orderpriority")), cell("description", "one<br>", text("o_custkey"), "<p>two</p><ul><li>", F.col("o_orderstatus"), "</ul>")]
    else:
        cells = [cell("x", "?"), cell("colIssueKey", "see ", key), cell("a Summary", "s ", text("o_custkey")), cell("statusCategory", "no"), cell("status", F.col("o_orderstatus")), cell("priority", F.col("o_orderpriority")), cell("status", "second")]
    row = F.concat(F.lit('<tr class="issuerow odd">'), *cells, F.lit("</tr>"))
    rows = orders.select("o_custkey", F.struct("o_orderkey", row.alias("row")).alias("r")).groupBy("o_custkey").agg(F.array_sort(F.collect_list("r")).alias("rows"))  # a customer's own orders
    body = F.array_join(F.transform("rows", lambda r: r["row"]), "\n")
    return rows.select(F.concat(F.lit("Sprint "), text("o_custkey")).alias("sprint"), F.concat(F.lit('<p>x</p><table id="issuetable"><thead><tr><th>Key</th></tr></thead><tbody>'), body, F.lit("</tbody></table><table><tr class='issuerow'><td>no</td></tr></table>")).alias("html"))


@query("""SELECT 'Sprint ' || o_custkey AS sprint, CAST(o_custkey AS INTEGER) AS sprint_no, 'ORD-' || o_orderkey AS issue_key, 'Order of & for ' || o_custkey AS summary, o_orderstatus AS status, trim(o_orderpriority) AS priority,
    'one' || chr(10) || o_custkey || chr(10) || 'two' || chr(10) || '- ' || o_orderstatus AS description, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS row_no FROM orders""")
def issue_fields(spark, sf_dir):
    """Exports parsed by the exact classes of their cells."""
    pages = issue_pages(spark, sf_dir, True)
    rows = html.fields_exact(html.issue_rows(pages))
    return rows.select("sprint", F.col("sprint_no").cast("int").alias("sprint_no"), "issue_key", "summary", F.trim("status").alias("status"), F.trim("priority").alias("priority"), "description", "row_no")


@query("""SELECT 'Sprint ' || o_custkey AS sprint, 'ORD-' || o_orderkey AS issue_key, 's ' || o_custkey AS summary, o_orderstatus AS status, trim(o_orderpriority) AS priority FROM orders""")
def issue_fields_hinted(spark, sf_dir):
    """Exports parsed by hints in the classes of their cells."""
    rows = html.fields_hinted(html.issue_rows(issue_pages(spark, sf_dir, False), rich=False))
    return rows.select("sprint", "issue_key", "summary", "status", F.trim("priority").alias("priority"))


def messages(spark, sf_dir: str) -> DataFrame:
    """Conversations as transcripts: questions tagged at even turns, tools used by the assistant."""
    item = lambda kind, text, name, args: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), name.cast("string").alias("name"), args.cast("map<string,string>").alias("input"))
    none = F.lit(None)
    text = F.coalesce("text", F.lit(""))
    tagged = F.concat(F.lit("<timestamp>t"), F.col("turn").cast("string"), F.lit("</timestamp><user_query>\n"), text, F.lit("\n</user_query>"))
    file = F.concat(F.lit("/home/x/scripts/s"), (F.col("conv_id") % 7).cast("string"), F.lit(".py"))
    tool = F.when(F.col("turn") % 3 == 0, F.create_map(F.lit("path"), file)).otherwise(F.create_map(F.lit("pattern"), F.concat(F.lit("p"), F.col("turn").cast("string"))))
    asked = F.array(item("text", F.when(F.col("turn") % 2 == 0, tagged).otherwise(F.concat(F.lit("<b>"), text, F.lit("</b>"))), none, none))
    said = F.array(item("text", text, none, none), item("tool_use", none, F.when(F.col("turn") % 3 == 0, "Read").otherwise("Grep"), tool))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("conversation_id"), (F.col("conv_id") % 11 == 0).alias("is_subagent"), F.col("turn").alias("line_no"), "role", F.when(F.col("role") == "user", asked).otherwise(said).alias("content"))


@query(r"""SELECT CAST(conv_id AS VARCHAR) AS conversation_id, conv_id % 11 = 0 AS is_subagent, turn AS line_no, CASE WHEN turn % 2 = 0 THEN 't' || turn END AS timestamp, md5(q) AS query FROM (
    SELECT *, CASE WHEN turn % 2 = 0 THEN regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') ELSE trim(regexp_replace(regexp_replace('<b>' || text || '</b>', '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) END AS q FROM conversations WHERE role = 'user') WHERE length(q) >= 3""")
def transcript_questions(spark, sf_dir):
    return transcripts.queries(messages(spark, sf_dir)).select("conversation_id", "is_subagent", "line_no", "timestamp", F.md5("query").alias("query"))


@query("""SELECT CASE WHEN turn % 3 = 0 THEN 'Read' ELSE 'Grep' END AS tool, count(*) AS n FROM conversations WHERE role <> 'user' GROUP BY 1""")
def tool_counts(spark, sf_dir):
    return conversations.tools(transcripts.tool_calls(messages(spark, sf_dir)))


@query("""SELECT 'scripts/s' || conv_id % 7 || '.py' AS target, count(*) AS n FROM conversations WHERE role <> 'user' AND turn % 3 = 0 GROUP BY 1 ORDER BY n DESC, target LIMIT 5""")
def tool_targets(spark, sf_dir):
    return conversations.targets(transcripts.tool_calls(messages(spark, sf_dir)), "Read", 5)


# --- profile and maps -------------------------------------------------------


@query(f"""SELECT CASE q WHEN 1 THEN 'p10' WHEN 5 THEN 'p50' ELSE 'p90' END AS name, value FROM (WITH v AS (SELECT CAST({WORDS} AS DOUBLE) AS x FROM documents), {QUANTILE.format(n=10)}) WHERE q IN (1, 5, 9)
    UNION ALL SELECT CASE q WHEN 1 THEN 'p25' ELSE 'p75' END, value FROM (WITH v AS (SELECT CAST({WORDS} AS DOUBLE) AS x FROM documents), {QUANTILE.format(n=4)}) WHERE q IN (1, 3)""")
def word_percentiles(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(T.word_count(F.col("text")).alias("total_word_count"))
    return profile.percentiles(rows).withColumn("value", F.round("value", 4))


TOKENS = f"CAST(trunc({WORDS} * 1.3::DOUBLE) AS BIGINT)"


@query(f"""WITH d AS (SELECT octet_length(encode(text)) AS b, {TOKENS} AS t FROM documents), p AS (SELECT value FROM (WITH v AS (SELECT CAST({TOKENS} AS DOUBLE) AS x FROM documents), {QUANTILE.format(n=4)}) WHERE q = 3)
    SELECT median(t) AS median_tokens, median(b) AS median_bytes, CAST(sum(b) AS BIGINT) AS md_bytes, (SELECT value FROM p) AS p75_tokens, round((1 - sum(b) / 1000000000) * 100, 1) AS saved_pct FROM d""")
def retrieval_surface(spark, sf_dir):
    w = T.word_count(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(F.octet_length("text").alias("file_size"), T.estimated_tokens(w).alias("estimated_tokens"))
    return profile.retrieval_surface(rows, 1_000_000_000).withColumn("p75_tokens", F.round("p75_tokens", 4))


@query(f"SELECT trim(source) AS component, count(*) AS stories, CAST(sum({TOKENS}) AS BIGINT) AS tokens FROM documents GROUP BY 1 ORDER BY tokens DESC, component LIMIT 15")
def tokens_by_component(spark, sf_dir):
    return profile.tokens_by_component(as_stories(table(spark, sf_dir, "documents")))


@query("SELECT source AS sprint, count(*) AS stories, min(lang || '/' || doc_id) AS page FROM documents GROUP BY 1")
def files_by_sprint(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("sprint"), F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("file_path"))
    return profile.files_by_sprint(docs, docs)


@query(f"WITH {SCORE} SELECT source AS epic, count(*) AS stories, round(avg(score), 1) AS mean_quality FROM scored GROUP BY 1 ORDER BY stories DESC, epic LIMIT 20")
def epic_quality(spark, sf_dir):
    return maps.epic_quality(scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumn("epic", F.col("source")), score="score")


@query("""SELECT event_type AS model, count(*) AS n, count(DISTINCT user_id) AS users, true AS close FROM events GROUP BY 1""")
def users_by_sketch(spark, sf_dir):
    """Users of each kind of event from daily sketches, beside the exact numbers: whether they are within four standard errors."""
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("model"), F.col("user_id").cast("string").alias("user"))
    about = sketches.distinct_counts(sketches.merged(sketches.sketched(rows, ["day", "model"], ["user"]), ["model"]))
    exact = rows.groupBy("model").agg(F.count_distinct("user").alias("users"))
    near = F.abs(F.col("user") - F.col("users")) <= F.greatest(F.lit(2.0), 4 * sketches.distinct_error() * F.col("users"))
    return exact.join(about, "model").select("model", "n", "users", near.alias("close"))


# --- vocabulary -------------------------------------------------------------


@query(f"""WITH {NAMED}, refs AS (SELECT api_name, split_part(label, ' ', 1) AS label, count(DISTINCT doc_id) AS stories, count(DISTINCT source) AS sprints FROM o LEFT JOIN said USING (api_name) GROUP BY ALL)
    SELECT label, api_name, stories, sprints FROM refs QUALIFY row_number() OVER (PARTITION BY label ORDER BY stories DESC, api_name) = 1""")
def object_by_label(spark, sf_dir):
    """One object for each first word of a label: the one that most documents name."""
    docs = table(spark, sf_dir, "documents")
    objects = named_objects(docs).withColumn("label", F.split("label", " ")[0])
    return topics.by_label(topics.object_references(docs, objects, "doc_id", "text", "source"))


EXPANSION = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,6}"


@query(rf"""WITH w AS (SELECT regexp_extract_all(lower(text), '[a-zA-Z]{{2,}}') AS w FROM documents), o AS (SELECT DISTINCT upper(w[1][1] || w[2][1]) AS acronym, w[1] || ' ' || w[2] AS label, w[1] || '_' || w[2] || '__c' AS api_name FROM w WHERE len(w) >= 2),
    named AS (SELECT acronym, arg_min(label, api_name) AS label FROM o GROUP BY 1),
    m AS (SELECT doc_id, unnest(l) AS m, unnest(range(len(l))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[A-Z]{{2,5}}\s*\({EXPANSION}\)|{EXPANSION}\s*\([A-Z]{{2,5}}\)') AS l FROM documents)),
    e AS (SELECT doc_id, i, regexp_extract(m, '\b([A-Z]{{2,5}})\b', 1) AS acronym, regexp_extract(m, '({EXPANSION})', 1) AS expansion FROM m),
    inline AS (SELECT acronym, arg_max(expansion, {{'d': doc_id, 'i': i}}) AS inline FROM e WHERE length(expansion) > 3 GROUP BY 1)
    SELECT coalesce(n.acronym, i.acronym) AS acronym, coalesce(label, inline) AS meaning, CASE WHEN label IS NOT NULL THEN 'object' ELSE 'inline' END AS source FROM named n FULL JOIN inline i ON n.acronym = i.acronym""")
def acronym_meanings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = F.split("label", " ")
    objects = named_objects(docs).withColumn("initials", F.upper(F.concat(F.left(words[0], F.lit(1)), F.left(words[1], F.lit(1)))))
    return topics.acronym_meanings(docs, "text", "doc_id", objects)


@query(f"""WITH {NAMED}, spaces AS (SELECT DISTINCT label AS integration FROM o WHERE length(label) >= 8), pairs AS (SELECT doc_id, integration FROM documents JOIN spaces ON contains(lower(text), integration))
    SELECT integration, count(*) AS n, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM pairs GROUP BY 1 HAVING count(*) >= 2""")
def integration_support(spark, sf_dir):
    """Integrations by the namespaces of objects, here the pairs of words that documents begin with; no document names a platform."""
    docs = table(spark, sf_dir, "documents")
    objects = named_objects(docs).where(F.length("label") >= 8).withColumn("namespace", F.col("label"))
    return topics.integration_support(docs, "doc_id", "text", objects)


@query(f"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(split_part(text, chr(10), 1), '[ \\t\\r\\n\\f\\v]+')) AS w FROM documents),
    rows AS (SELECT DISTINCT doc_id, 2 AS step, 'title_gerund' AS source, lower(trim(w, ',:;()[]"''')) AS process FROM w UNION SELECT doc_id, 0, 'epic', lower(trim(lang)) FROM documents),
    kept AS (SELECT * FROM rows WHERE process <> '' AND (step = 0 OR process LIKE '%ing' AND length(process) >= 5 AND process NOT IN ({quoted(fixed.NOT_PROCESSES)}))),
    named AS (SELECT process, arg_min(source, {{'d': doc_id, 's': step}}) AS source FROM kept GROUP BY 1)
    SELECT process, n, examples, source FROM (SELECT process, count(*) AS n, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM (SELECT DISTINCT process, doc_id FROM kept) GROUP BY 1 HAVING count(*) >= 3) JOIN named USING (process)""")
def process_support(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("story_id"), F.col("lang").alias("epic"), F.lit("").alias("labels"), F.element_at(F.split("text", "\n"), 1).alias("summary"))
    return topics.process_support(rows)


# --- retrieval --------------------------------------------------------------


@query(f"WITH {_intents_sql()} SELECT conv_id AS conversation_id, turn AS line_no FROM q WHERE length(text) >= 10 AND NOT list_contains(intents, 'workspace_tooling')")
def eligible_questions(spark, sf_dir):
    return retrieval.eligible(questions(spark, sf_dir)).select("conversation_id", "line_no")


@query(f"""WITH w AS (SELECT regexp_extract_all(lower(text), '[a-zA-Z]{{2,}}') AS w FROM documents), c AS (SELECT w[1] || ' ' || w[2] AS component, count(*) AS stories FROM w WHERE len(w) >= 2 GROUP BY 1),
    t AS (SELECT term, count(*) AS n FROM (SELECT unnest({tokens_sql("text", "retrieval")}) AS term FROM conversations WHERE role = 'user') GROUP BY 1),
    a AS (SELECT component, sum(n) AS queries FROM c JOIN t ON contains(component, term) GROUP BY 1)
    SELECT component, stories, CAST(coalesce(queries, 0) AS BIGINT) AS queries, CASE WHEN stories >= 20 AND coalesce(queries, 0) < 3 THEN 'over' WHEN stories <= 2 AND queries >= 2 THEN 'under' ELSE 'balanced' END AS verdict FROM c LEFT JOIN a USING (component)""")
def component_coverage(spark, sf_dir):
    w = T.words(F.lower("text"))
    pairs = table(spark, sf_dir, "documents").select(F.try_element_at(w, F.lit(1)).alias("a"), F.try_element_at(w, F.lit(2)).alias("b")).where("b is not null")
    documented = pairs.groupBy(F.concat_ws(" ", "a", "b").alias("component")).agg(F.count("*").alias("stories"))
    return retrieval.component_coverage(documented, questions(spark, sf_dir))


BM25 = f"""counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tokens_sql("text", "retrieval")}) AS term FROM documents) GROUP BY ALL),
    lens AS (SELECT doc_id, sum(tf) AS len FROM counts GROUP BY 1), mean AS (SELECT avg(len) AS avg_len FROM lens),
    idfs AS (SELECT term, ln(1 + ((SELECT count(*) FROM documents) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM counts GROUP BY 1),
    asked AS (SELECT DISTINCT item_id, unnest({tokens_sql("text", "retrieval")}) AS term FROM benchmark),
    bm AS (SELECT item_id, doc_id, round(sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / avg_len))), 6) AS score FROM asked JOIN idfs USING (term) JOIN counts USING (term) JOIN lens USING (doc_id), mean GROUP BY ALL),
    bm_top AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM bm QUALIFY rank <= 10)"""


def bm25_top(spark, sf_dir: str) -> DataFrame:
    docs, asked = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").withColumnRenamed("text", "q_text")
    return retrieval.top_bm25(docs, asked, "item_id", "doc_id", "q_text", "text")


@query(f"WITH {BM25} SELECT item_id, doc_id, score, rank FROM bm_top")
def bm25_topk(spark, sf_dir):
    return bm25_top(spark, sf_dir)


@query(f"""WITH {BM25}, relevant AS (SELECT DISTINCT item_id, doc_id FROM benchmark b JOIN documents d ON contains(lower(d.text), lower(b.text)) AND b.text <> ''),
    wanted AS (SELECT item_id, count(*) AS wanted FROM relevant GROUP BY 1), got AS (SELECT item_id, count(*) FILTER (rank <= 5) AS at5, count(*) AS found, min(rank) AS first, sum(1 / log2(rank + 1)) AS dcg FROM bm_top JOIN relevant USING (item_id, doc_id) GROUP BY 1)
    SELECT item_id, round(coalesce(at5, 0) / 5, 6) AS precision_at_5, round(coalesce(found, 0) / wanted, 6) AS recall, round(coalesce(1 / first, 0), 6) AS reciprocal_rank,
      round(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(wanted, 10) + 1), lambda i: 1 / log2(i + 1))), 6) AS ndcg FROM wanted LEFT JOIN got USING (item_id)""")
def ranking_quality(spark, sf_dir):
    """How well BM25 finds the documents that hold a question's passage."""
    docs, asked = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    passages = asked.select("item_id", F.lower("text").alias("term"))
    relevant = mentions(docs, "doc_id", "text", passages).join(passages, "term").select("item_id", "doc_id")
    out = retrieval.ranking_quality(bm25_top(spark, sf_dir), relevant, "item_id", "doc_id")
    return out.select("item_id", *(F.round(c, 6).alias(c) for c in ("precision_at_5", "recall", "reciprocal_rank", "ndcg")))


# --- lookups ----------------------------------------------------------------


@query("""WITH r AS (SELECT l_orderkey AS story, CAST(year(l_shipdate) AS INTEGER) AS y, p_brand AS component FROM lineitem JOIN part ON l_partkey = p_partkey),
    now AS (SELECT DISTINCT component FROM r WHERE y = 1997) SELECT CAST(story AS VARCHAR) AS story_id, y AS sprint_no, count(DISTINCT component) AS shared FROM r JOIN now USING (component) WHERE y < 1997 GROUP BY ALL""")
def regression_scope(spark, sf_dir):
    rows = component_rows(spark, sf_dir).select(F.col("story").cast("string").alias("story_id"), F.col("span").alias("sprint_no"), F.col("component").alias("components"))
    return lookups.regression_scope(rows, 1997)


@query(r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\s*(?:[-*•]|\d+[.)])\s+', ''))), lambda x: x <> '') AS l FROM documents),
    i AS (SELECT doc_id, unnest(l) AS criterion, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS criterion_no FROM l), s AS (SELECT doc_id, 1 + quality AS criterion_no, count(*) AS scenarios FROM labels GROUP BY ALL)
    SELECT CAST(i.doc_id AS VARCHAR) AS story_id, i.criterion_no, md5(criterion) AS criterion, coalesce(scenarios, 0) AS scenarios, coalesce(scenarios, 0) = 0 AS gap FROM i LEFT JOIN s ON i.doc_id = s.doc_id AND i.criterion_no = s.criterion_no""")
def criteria_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("story_id"), F.col("text").alias("acceptance_criteria"))
    scenarios = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("story_id"), (F.col("quality") + 1).alias("criterion_no"))
    return lookups.criteria_coverage(lookups.criteria(docs), scenarios).select("story_id", "criterion_no", F.md5("criterion").alias("criterion"), "scenarios", "gap")


@query("SELECT doc_id, CASE WHEN lower(trim(source)) = 'src3' THEN 'component' ELSE 'text' END AS how FROM documents WHERE lower(trim(source)) = 'src3' OR contains(lower(text), 'src3')")
def touching_component(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("components"), F.col("text").alias("description"), F.lit(None).cast("string").alias("solution"))
    return lookups.touching(docs, "src3").select("doc_id", "how")


@query(f"""WITH {EDGES} SELECT DISTINCT 'out' AS way, "to" AS story_id FROM edges WHERE "from" = 'OK-5' UNION SELECT DISTINCT 'in', "from" FROM edges WHERE "to" = 'OK-5'""")
def related_stories(spark, sf_dir):
    return lookups.related(maps.reference_edges(referring(spark, sf_dir)), "OK-5")


@query("SELECT doc_id, coalesce('q' || quality, lang) AS lang, source FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)")
def metadata_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    said = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q")).select("doc_id", F.concat(F.lit("q"), F.col("q").cast("string")).alias("lang"))
    return lookups.preferring(docs, said, "doc_id", ["lang"])


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def labelled_lookup(spark, sf_dir):
    """Every labelled document, looked up in a table by buckets of its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    path = f"{shared(docs).getCheckpointDir().rstrip('/')}/lookup-{uuid.uuid4().hex}"
    lookups.write_lookup(docs, path, "doc_id")
    return lookups.looked_up_all(table(spark, sf_dir, "labels").select("doc_id"), path, "doc_id")


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'good' WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'labelled' ELSE 'documents' END AS tier FROM documents")
def cheapest_tier(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return lookups.tier_index([("good", labels.where("quality = 1")), ("labelled", labels), ("documents", table(spark, sf_dir, "documents"))], "doc_id")


# --- indexes ----------------------------------------------------------------


@query("""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang END AS action_type, left(text, CAST(doc_id % 20 AS INTEGER)) AS summary FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS id, summary, list_filter([CASE WHEN summary IS NULL THEN 'summary is missing' END, CASE WHEN action_type IS NULL THEN 'action_type is missing' END, CASE WHEN length(summary) < 10 THEN 'summary is too short' END], lambda x: x IS NOT NULL) AS problems FROM r""")
def assemble_with_faults(spark, sf_dir):
    """An index whose rows are kept whatever is wrong with them, with their problems."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.struct("doc_id").alias("__o"), F.col("doc_id").cast("string").alias("id"), F.left("text", (F.col("doc_id") % 20).cast("int")).alias("summary"), F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("action_type"), F.struct(F.lit(1)).alias("entities"), F.col("source").alias("business_domain"))
    return extraction.assemble(extraction.problems(rows, "story_summaries"), "story_summaries").select("id", "summary", "problems")
