"""The reference questions on the tables at hand, each with its twin in DuckDB's SQL.

Documents stand for stories (source for sprint, lang for type), conversations for
transcripts, events for usage, line items and parts for components of stories,
pages for exports, benchmark texts for questions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import fixed, stats
from storyloom.functions import text as T
from storyloom.operators import conversations, dedup, lookups, maps, profile, retrieval, topics, usage
from storyloom.plans import extraction
from storyloom.sources import html, stories, tables
from storyloom.tables import spread, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


def tokens_sql(text: str, stop: str, least: int = 3) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '[a-zA-Z]{{2,}}'), lambda w: length(w) >= {least} AND w NOT IN ({quoted(fixed.STOP_WORDS[stop])}))"


WORDS = "len(regexp_extract_all(text, '[a-zA-Z]{2,}'))"
TERMS = f"""
    counts AS (SELECT doc_id, source, term, count(*) AS tf FROM (SELECT doc_id, source, unnest({tokens_sql("text", "base")}) AS term FROM documents) GROUP BY ALL),
    dfs AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
    size AS (SELECT count(*) AS n FROM documents),
    idfs AS (SELECT term, df, ln(n / (1 + df)) AS idf FROM dfs, size WHERE df <= 0.8 * n)"""


def counted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    return topics.term_counts(spread(docs.select("doc_id", "text", "source")), "doc_id", "text", fixed.STOP_WORDS["base"], ["source"]), topics.corpus_size(docs)


# --- topics -----------------------------------------------------------------


@query(f"WITH {TERMS} SELECT term, df, CAST(sum(tf) AS BIGINT) AS tf, round(sum(tf) * any_value(idf), 4) AS score FROM counts JOIN idfs USING (term) GROUP BY term, df ORDER BY score DESC, term LIMIT 30")
def tfidf_top_terms(spark, sf_dir):
    return topics.top_terms(*counted(spark, sf_dir))


@query(f"""WITH {TERMS}, scored AS (SELECT source, term, round(sum(tf) * any_value(idf), 4) AS score FROM counts JOIN idfs USING (term) GROUP BY source, term)
    SELECT source, term, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, term) AS rank FROM scored QUALIFY rank <= 5""")
def tfidf_top_terms_by_source(spark, sf_dir):
    return topics.top_terms_by(*counted(spark, sf_dir), "source")


@query(f"""WITH {TERMS}, scored AS (SELECT doc_id, term, round(tf * idf, 6) AS score FROM counts JOIN idfs USING (term) WHERE round(tf * idf, 6) > 0),
    best AS (SELECT doc_id, term FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) = 1),
    sizes AS (SELECT term, count(*) AS docs FROM best GROUP BY term HAVING count(*) >= 3 ORDER BY docs DESC, term LIMIT 15)
    SELECT term, docs, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM best JOIN sizes USING (term) GROUP BY term, docs""")
def dominant_term_clusters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # read twice: for the idf, and for the scores
    rows = written(topics.term_rows(spread(docs.select("doc_id", "text")), "doc_id", "text", fixed.STOP_WORDS["base"]))
    counts = rows.select("doc_id", F.explode("terms").alias("t")).select("doc_id", "t.term", "t.tf")
    return topics.clusters(counts, written(topics.idf_table(counts, topics.corpus_size(docs))))


@query(f"""WITH counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tokens_sql("text", "base")}) AS term FROM documents) GROUP BY ALL),
    vocabulary AS (SELECT DISTINCT term AS singular FROM counts),
    folded AS (SELECT doc_id, coalesce(singular, term) AS term FROM counts LEFT JOIN vocabulary ON term LIKE '%s' AND length(term) > 3 AND singular = left(term, length(term) - 1))
    SELECT term, count(DISTINCT doc_id) AS df FROM folded GROUP BY term HAVING count(DISTINCT doc_id) >= 10""")
def plural_folded_df(spark, sf_dir):
    counts = topics.term_counts(table(spark, sf_dir, "documents"))
    return topics.fold_plurals(counts).groupBy("term").agg(F.count("*").alias("df")).where("df >= 10")


@query(f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-zA-Z]{{2,}}') AS w FROM documents),
    pairs AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS bigram FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w)
      WHERE length(w[i]) > 2 AND length(w[i + 1]) > 2 AND w[i] NOT IN ({quoted(fixed.STOP_WORDS["export"])}) AND w[i + 1] NOT IN ({quoted(fixed.STOP_WORDS["export"])}))
    SELECT bigram, count(*) AS docs FROM pairs GROUP BY bigram HAVING count(*) >= 5 ORDER BY docs DESC, bigram LIMIT 100""")
def bigram_support(spark, sf_dir):
    return topics.bigram_support(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("""WITH w AS (SELECT list_filter(regexp_extract_all(lower(text), '[a-zA-Z]{2,}'), lambda x: length(x) > 3) AS w FROM conversations)
    SELECT w[i] || ' ' || w[i + 1] AS bigram, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM w) GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, bigram LIMIT 20""")
def recurring_bigrams(spark, sf_dir):
    return topics.recurring_bigrams(table(spark, sf_dir, "conversations"))


@query(f"""WITH pairs AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Z]{{2,5}}')) AS acronym FROM documents),
    kept AS (SELECT * FROM pairs WHERE acronym NOT IN ({quoted(fixed.NOT_ACRONYMS)}))
    SELECT acronym, count(*) AS n, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM kept GROUP BY acronym HAVING count(*) >= 3""")
def acronym_support(spark, sf_dir):
    return topics.acronym_support(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(split_part(text, chr(10), 1), '[ \\t\\r\\n\\f\\v]+')) AS w FROM documents),
    bare AS (SELECT DISTINCT doc_id, lower(trim(w, ',:;()[]"''')) AS gerund FROM w)
    SELECT gerund, count(*) AS n, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM bare WHERE gerund LIKE '%ing' AND length(gerund) >= 5 AND gerund NOT IN ({quoted(fixed.NOT_PROCESSES)}) GROUP BY gerund HAVING count(*) >= 3""")
def gerund_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("title", F.element_at(F.split("text", "\n"), 1))
    return topics.supported(docs.select("doc_id", F.explode(T.title_gerunds(F.col("title"))).alias("gerund")), "gerund", "doc_id", 3)


PERSONAS = r"regexp_extract_all(text, '[Aa]s\s+(?:a|an)\s+([A-Za-z][A-Za-z\s/\-]{2,40}?)(?:\s*[,.]|\s+(?:I|i|we|We)\s)', 1)"


@query(f"""WITH p AS (SELECT DISTINCT doc_id, unnest(list_filter(list_transform({PERSONAS}, lambda r: lower(trim(r))), lambda r: length(r) BETWEEN 3 AND 50 AND NOT regexp_matches(r, 'user who|person who|member of'))) AS persona FROM documents)
    SELECT persona, count(*) AS n, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM p GROUP BY persona HAVING count(*) >= 2""")
def persona_support(spark, sf_dir):
    return topics.persona_support(table(spark, sf_dir, "documents"), "doc_id", "text")


# --- profile ----------------------------------------------------------------


def as_stories(docs: DataFrame) -> DataFrame:
    """Documents as parsed stories: the first line described, the whole as criteria, and as solution but of every third."""
    part = lambda c: F.struct(c.alias("content"), T.word_count(c).cast("int").alias("word_count"), F.length(c).alias("char_count"), F.lit(1).alias("line_count"))
    text = F.coalesce("text", F.lit(""))
    n = T.word_count(text)
    solution = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(text)
    sections = F.create_map(F.lit("Description"), part(F.element_at(F.split(text, "\n"), 1)), F.lit("Acceptance Criteria"), part(text), F.lit("Solution"), part(solution))
    metadata = F.create_map(F.lit("Components"), F.col("source"), F.lit("Assignee"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(" "))
    return docs.select(F.col("doc_id").cast("string").alias("story_id"), F.col("source").alias("sprint"), metadata.alias("metadata"), sections.alias("sections"), F.octet_length("text").cast("bigint").alias("file_size"), n.cast("int").alias("total_word_count"), T.estimated_tokens(n).alias("estimated_tokens"))


_W = {"Description": "len(regexp_extract_all(split_part(text, chr(10), 1), '[a-zA-Z]{2,}'))", "Acceptance Criteria": WORDS, "Solution": f"CASE WHEN doc_id % 3 = 0 THEN 0 ELSE {WORDS} END"}
_META = {"Components": "trim(source) <> ''", "Assignee": "doc_id % 2 = 0 AND trim(lang) <> ''"}
_COVERAGE = " UNION ALL ".join(
    [f"SELECT 'section' AS kind, '{name}' AS name, count(*) FILTER ({_W.get(name, 0)} > 3) AS stories, round(count(*) FILTER ({_W.get(name, 0)} > 3) / count(*) * 100, 1) AS pct, round(coalesce(avg({_W.get(name, 0)}) FILTER ({_W.get(name, 0)} > 3), 0), 0) AS avg_words FROM documents" for name in fixed.SECTIONS]
    + [f"SELECT 'metadata', '{name}', count(*) FILTER ({_META.get(name, 'false')}), round(count(*) FILTER ({_META.get(name, 'false')}) / count(*) * 100, 1), NULL::DOUBLE FROM documents" for name in fixed.METADATA_KEYS]
)


@query(_COVERAGE)
def corpus_coverage(spark, sf_dir):
    return profile.coverage(as_stories(table(spark, sf_dir, "documents")))


@query(f"SELECT source AS sprint, count(*) AS stories, round(count(*) FILTER ({_W['Acceptance Criteria']} > 3) / count(*) * 100, 1) AS ac_pct, round(count(*) FILTER ({_W['Solution']} > 3) / count(*) * 100, 1) AS solution_pct FROM documents GROUP BY source")
def coverage_by_source(spark, sf_dir):
    return profile.coverage_by_sprint(as_stories(table(spark, sf_dir, "documents")))


@query(f"""SELECT count(*) AS stories, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, round(sum(octet_length(encode(text))) / 1048576, 2) AS mb, CAST(sum({WORDS}) AS BIGINT) AS words, CAST(sum(CAST(trunc({WORDS} * 1.3::DOUBLE) AS BIGINT)) AS BIGINT) AS tokens,
    round(avg(round(({' + '.join(_W.values())}) / greatest({WORDS}, 1), 2)), 2) AS richness FROM documents""")
def corpus_density(spark, sf_dir):
    return profile.density(as_stories(table(spark, sf_dir, "documents")))


@query(f"""SELECT source, count(*) AS stories, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, round(avg({WORDS}), 0) AS avg_words, round(avg(CAST(trunc({WORDS} * 1.3::DOUBLE) AS BIGINT)), 0) AS avg_tokens FROM documents GROUP BY source""")
def density_by_source(spark, sf_dir):
    w = T.word_count(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("sprint"), F.octet_length("text").alias("file_size"), w.alias("total_word_count"), T.estimated_tokens(w).alias("estimated_tokens"))
    return profile.density_by_sprint(rows).withColumnRenamed("sprint", "source")


@query("SELECT CASE WHEN b < 500 THEN '<500B' WHEN b < 2000 THEN '500B-2KB' WHEN b < 10000 THEN '2KB-10KB' ELSE '>=10KB' END AS bucket, count(*) AS stories FROM (SELECT octet_length(encode(text)) AS b FROM documents) GROUP BY 1")
def size_buckets(spark, sf_dir):
    return profile.size_buckets(table(spark, sf_dir, "documents").select(F.octet_length("text").alias("file_size")))


QUANTILE = """
    sorted AS (SELECT x, row_number() OVER (ORDER BY x) AS k, count(*) OVER () AS n FROM v),
    cuts AS (SELECT q, n, least(greatest(q * (n + 1) // {n}, 1), n - 1) AS j FROM (SELECT DISTINCT n FROM sorted), (SELECT unnest(range(1, {n})) AS q))
    SELECT CAST(q AS INTEGER) AS q, round((max(x) FILTER (k = j) * ({n} - (q * (n + 1) - j * {n})) + max(x) FILTER (k = j + 1) * (q * (n + 1) - j * {n})) / {n}, 4) AS value
    FROM cuts JOIN sorted USING (n) GROUP BY q, j, n"""


@query(f"WITH v AS (SELECT CAST({WORDS} AS DOUBLE) AS x FROM documents), {QUANTILE.format(n=10)}")
def exclusive_deciles(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(T.word_count(F.col("text")).alias("words"))
    return stats.exclusive_quantiles(rows, "words").withColumn("value", F.round("value", 4))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of documents as if they were stories: text for all three sections, source and lang for the fields."""
    w = T.word_count(F.col("text"))
    score = T.quality_score(description=w, criteria=w - 50, solution=w - 100, linked=F.col("quality"), components=F.col("source"), assignee=F.col("lang"))
    return docs.join(labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left").withColumn("score", score)


SCORE = f"""scored AS (SELECT source, doc_id, (CASE WHEN w > 3 THEN 15 ELSE 0 END) + (CASE WHEN w - 50 > 3 THEN 25 ELSE 0 END) + (CASE WHEN w - 100 > 3 THEN 25 ELSE 0 END)
    + (CASE WHEN w - 50 >= 100 THEN 10 ELSE 0 END) + (CASE WHEN w - 100 >= 100 THEN 10 ELSE 0 END) + (CASE WHEN quality > 0 THEN 5 ELSE 0 END)
    + (CASE WHEN trim(source) <> '' THEN 5 ELSE 0 END) + (CASE WHEN trim(lang) <> '' THEN 5 ELSE 0 END) AS score
    FROM (SELECT d.*, {WORDS} AS w, quality FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)))"""


@query(f"WITH {SCORE} SELECT CASE WHEN score <= 20 THEN '0-20' WHEN score <= 40 THEN '21-40' WHEN score <= 60 THEN '41-60' WHEN score <= 80 THEN '61-80' ELSE '81-100' END AS band, count(*) AS stories FROM scored GROUP BY 1")
def quality_score_bands(spark, sf_dir):
    return profile.quality_bands(scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "score")


@query(f"WITH {SCORE} SELECT source, count(*) AS stories, round(avg(score), 1) AS mean_quality FROM scored GROUP BY source")
def quality_by_source(spark, sf_dir):
    return profile.quality_by(scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "source", "score")


@query(f"WITH {SCORE} SELECT round(avg(score), 1) AS mean, CAST(floor(median(score)) AS BIGINT) AS median, round(stddev_samp(score), 1) AS stdev FROM scored")
def quality_stats(spark, sf_dir):
    return profile.quality_stats(scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "score")


@query(f"WITH {SCORE} (SELECT 'best' AS \"end\", doc_id, score FROM scored ORDER BY score DESC, doc_id LIMIT 10) UNION ALL (SELECT 'worst', doc_id, score FROM scored ORDER BY score, doc_id LIMIT 10)")
def quality_extremes(spark, sf_dir):
    return profile.extremes(scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 10, "score", "doc_id")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS in_progress, count(*) FILTER (o_orderstatus NOT IN ('F', 'P')) AS other FROM orders GROUP BY 1""")
def status_summary(spark, sf_dir):
    names = F.when(F.col("o_orderstatus") == "F", "Done").when(F.col("o_orderstatus") == "P", "In Progress").otherwise("Open")
    rows = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), names.alias("status"))
    return profile.status_summary(rows, "month")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


# --- usage ------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(0).cast("bigint"))
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.to_date("ts").alias("day"), F.col("user_id").cast("string").alias("user"), F.lit("api").alias("kind"), F.col("event_type").alias("model"), F.lit("no").alias("max_mode"),
        k.alias("input_with_cache"), (k * 2).alias("input_without_cache"), (k * F.pmod("event_id", F.lit(5))).alias("cache_read"), (k + 1).alias("output_tokens"), (k * 4).alias("total_tokens"),
        F.round("value", 2).alias("cost"), F.lit("events").alias("source_file"), F.col("event_id").alias("line"),
    )


EVENTS = """e AS (SELECT ts, CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS "user", event_type AS model, k AS input_with_cache, k * 2 AS input_without_cache, k * (event_id % 5) AS cache_read, k + 1 AS output_tokens, k * 4 AS total_tokens, round(value, 2) AS cost, event_id AS line
    FROM (SELECT *, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k FROM events))"""
SUMS = ", ".join(["count(*) AS requests", *(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("total_tokens", "cache_read", "input_with_cache", "input_without_cache", "output_tokens")), "round(sum(cost), 4) AS cost"])
RATE = "CASE WHEN cache_read + input_with_cache + input_without_cache > 0 THEN round(cache_read / (cache_read + input_with_cache + input_without_cache) * 100, 1) ELSE 0 END"
RATIOS = f"round(cost / requests, 4) AS cost_per_request, round(total_tokens / requests, 0) AS tokens_per_request, {RATE} AS cache_rate"


@query(f"""WITH {EVENTS}, s AS (SELECT {SUMS}, count(DISTINCT "user") AS users, count(DISTINCT model) AS models, count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day FROM e)
    SELECT *, {RATIOS}, round(cost / days, 4) AS cost_per_day, round(requests / days, 1) AS requests_per_day FROM s""")
def usage_overview(spark, sf_dir):
    return usage.overview(events(spark, sf_dir))


def _per(group: str, others: tuple[str, str]) -> str:
    return f'WITH {EVENTS}, s AS (SELECT "{group}", {SUMS}, count(DISTINCT "{others[0]}") AS {others[0]}s, count(DISTINCT "{others[1]}") AS {others[1]}s FROM e GROUP BY 1) SELECT *, {RATIOS} FROM s'


@query(_per("user", ("model", "day")))
def usage_per_user(spark, sf_dir):
    return usage.per(events(spark, sf_dir), "user")


@query(_per("model", ("user", "day")))
def usage_per_model(spark, sf_dir):
    return usage.per(events(spark, sf_dir), "model")


@query(_per("day", ("user", "model")))
def usage_daily(spark, sf_dir):
    return usage.per(events(spark, sf_dir), "day")


@query(f"""WITH {EVENTS} SELECT "user", model, day, CASE WHEN grouping("user") = 0 THEN 'user' WHEN grouping(model) = 0 THEN 'model' ELSE 'day' END AS kind, {SUMS} FROM e GROUP BY GROUPING SETS (("user"), (model), (day))""")
def usage_rollup(spark, sf_dir):
    return usage.rollup(events(spark, sf_dir))


@query(f"""WITH {EVENTS}, r AS (SELECT *, {RATE} AS rate FROM e)
    SELECT round(sum(cache_read) / sum(cache_read + input_with_cache + input_without_cache) * 100, 1) AS overall_rate, round(avg(rate), 1) AS mean_rate, round(median(rate), 1) AS median_rate, count(*) FILTER (rate >= 70) AS high, count(*) FILTER (rate = 0) AS zero,
    round(count(*) FILTER (rate >= 70) * 100.0::DOUBLE / count(*), 1) AS high_pct, round(sum(cache_read) * 1e-6, 2) AS saving FROM r""")
def cache_rate_stats(spark, sf_dir):
    return usage.cache_efficiency(events(spark, sf_dir))


@query(f"WITH {EVENTS} SELECT line, cost FROM e WHERE cost > 3 * (SELECT avg(cost) FROM e)")
def cost_outliers(spark, sf_dir):
    return usage.outliers(events(spark, sf_dir)).select("line", "cost")


@query(f"WITH {EVENTS} SELECT line, \"user\", cost FROM e ORDER BY cost DESC, line LIMIT 10")
def top_expensive(spark, sf_dir):
    return usage.most_expensive(events(spark, sf_dir)).select("line", "user", "cost")


@query(f"""WITH {EVENTS}, two AS (SELECT *, 'a' AS file FROM e UNION ALL SELECT *, 'b' FROM e WHERE line % 3 = 0) SELECT line, file, cost FROM two QUALIFY row_number() OVER (PARTITION BY ts, "user", model, total_tokens ORDER BY file, line) = 1""")
def usage_dedup_first(spark, sf_dir):
    e = events(spark, sf_dir)
    two = e.withColumn("source_file", F.lit("a")).unionByName(e.where("line % 3 = 0").withColumn("source_file", F.lit("b")))  # two files that overlap are the case at hand
    return usage.deduplicated(two).select("line", F.col("source_file").alias("file"), "cost")


# --- maps -------------------------------------------------------------------


def component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("component"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("story"), "l_partkey", F.year("l_shipdate").alias("span"))
    return items.join(part, items["l_partkey"] == part["p_partkey"])


ROWS = "r AS (SELECT l_orderkey AS story, l_partkey, p_brand AS component, CAST(year(l_shipdate) AS INTEGER) AS span FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query(f"WITH {ROWS} SELECT component, count(DISTINCT story) AS stories, count(DISTINCT span) AS spans FROM r GROUP BY component")
def component_story_map(spark, sf_dir):
    return maps.inverted(component_rows(spark, sf_dir), "component", "story", "span")


@query(f"WITH {ROWS} SELECT DISTINCT component, story, span FROM r")
def component_story_pairs(spark, sf_dir):
    return maps.members(component_rows(spark, sf_dir), "component", "story", "span")


@query(f"WITH {ROWS} SELECT component, count(DISTINCT story) AS stories, list_sort(list(DISTINCT span)) AS spans FROM r GROUP BY component HAVING count(DISTINCT story) >= 2")
def hot_components(spark, sf_dir):
    return maps.hot(component_rows(spark, sf_dir), "component", 2, "story", "span")


@query("SELECT l_partkey FROM (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem) GROUP BY l_partkey HAVING count(*) = 1")
def orphan_components(spark, sf_dir):
    return maps.orphans(table(spark, sf_dir, "lineitem").select("l_partkey"), "l_partkey")


@query(f"WITH {ROWS}, c AS (SELECT span, component, count(*) AS n FROM r GROUP BY ALL) SELECT span, component, n, row_number() OVER (PARTITION BY span ORDER BY n DESC, component) AS rank FROM c QUALIFY rank <= 5")
def top_components_by_year(spark, sf_dir):
    return maps.top_per(component_rows(spark, sf_dir), "span", "component", 5)


@query("SELECT DISTINCT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def missing_docs_anti(spark, sf_dir):
    seen = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return maps.missing(table(spark, sf_dir, "part"), seen, "p_partkey")


@query("""SELECT c_mktsegment AS epic, count(*) AS stories, list_sort(list(DISTINCT CAST(year(o_orderdate) AS INTEGER))) AS spans FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) > 1""")
def epic_span(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = o.join(c.select("c_custkey", F.col("c_mktsegment").alias("epic")), o["o_custkey"] == F.col("c_custkey")).select("epic", F.year("o_orderdate").alias("span"))
    return maps.epic_span(rows, "epic", "span")


TOUCH = """each AS (SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS month, count(DISTINCT l_orderkey) AS own_keys FROM lineitem GROUP BY ALL)
    SELECT l_partkey, month, own_keys, count(*) OVER w AS prior_spans, max(month) OVER w AS latest_prior, CAST(sum(own_keys) OVER w AS BIGINT) AS prior_keys FROM each
    WINDOW w AS (PARTITION BY l_partkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) QUALIFY prior_spans > 0"""


@query(f"WITH {TOUCH}")
def prior_touchpoints(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    return maps.prior_touchpoints(rows, "l_partkey", "month", "l_orderkey")


def referring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as stories that name orders, parts and suppliers by id."""
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    items = table(spark, sf_dir, "lineitem")
    solution = F.concat_ws(" ", F.lit("see"), name("OK-", "l_orderkey"), F.lit("and"), F.concat(F.lit("OK-"), (F.col("l_orderkey") + F.col("l_linenumber") - 3).cast("string")))
    return items.select(name("OK-", "l_orderkey").alias("story_id"), F.col("l_linestatus").alias("sprint"), solution.alias("solution"), name("uses PT-", "l_partkey").alias("acceptance_criteria"), name("from SU-", "l_suppkey").alias("summary"))


EDGES = """o AS (SELECT 'OK-' || l_orderkey AS "from", l_linestatus AS sprint, l_orderkey + l_linenumber - 3 AS other, 'PT-' || l_partkey AS part, 'SU-' || l_suppkey AS supplier FROM lineitem),
    edges AS (SELECT "from", 'OK-' || other AS "to", sprint FROM o WHERE other >= 0 AND 'OK-' || other <> "from" UNION ALL SELECT "from", part, sprint FROM o UNION ALL SELECT "from", supplier, sprint FROM o)"""


@query(f'WITH {EDGES} SELECT "from", "to", sprint FROM edges')
def reference_edges(spark, sf_dir):
    return maps.reference_edges(referring(spark, sf_dir))


@query(f"""WITH {EDGES} SELECT DISTINCT "to" FROM edges WHERE "to" LIKE 'OK-%' AND "to" NOT IN (SELECT 'OK-' || l_orderkey FROM lineitem)""")
def dangling_references(spark, sf_dir):
    stories = referring(spark, sf_dir)
    return maps.dangling(maps.reference_edges(stories, known_only=True), stories)


@query("""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INTEGER) AS link_no, href FROM (SELECT page_id, unnest(l) AS href, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS l FROM pages))""")
def html_links(spark, sf_dir):
    return html.links(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "link_no", "href")


@query("""SELECT 'nation-' || n_nationkey || '.md' AS "Source", n_name AS "Name", CAST(n_regionkey AS VARCHAR) AS "Region", '' AS "Balance" FROM nation UNION ALL SELECT 'region.md', r_name, CAST(r_regionkey AS VARCHAR), '' FROM region
    UNION ALL SELECT 'supplier-' || s_suppkey || '.md', s_name, '', CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) FROM supplier""")
def union_headers(spark, sf_dir):
    """Markdown files with one table each, all parsed and put side by side by their headers."""
    line = lambda *cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    file = lambda head, rows: F.concat_ws("\n", F.lit(f"# {head[0]}\n\n| {' | '.join(head)} |\n|{'---|' * len(head)}"), rows, F.lit("\nend"))
    text = lambda c: F.col(c).cast("string")
    nation, region, supplier = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    n = nation.select(F.concat(F.lit("nation-"), text("n_nationkey"), F.lit(".md")).alias("source"), file(["Name", "Region"], line(text("n_name"), text("n_regionkey"))).alias("text"))
    five = region.agg(F.array_sort(F.collect_list(line(text("r_name"), text("r_regionkey")))).alias("rows"))  # five rows at any scale
    r = five.select(F.lit("region.md").alias("source"), file(["Name", "Region"], F.array_join("rows", "\n")).alias("text"))
    cents = F.round(F.col("s_acctbal") * 100).cast("bigint").cast("string")
    s = supplier.select(F.concat(F.lit("supplier-"), text("s_suppkey"), F.lit(".md")).alias("source"), file(["Name", "Balance"], line(text("s_name"), cents)).alias("text"))
    return tables.header_union(tables.table_rows(n.unionByName(r).unionByName(s)))


# --- retrieval --------------------------------------------------------------

def cosine_sql(questions: str = "benchmark", boost: str = "") -> str:
    """CTEs up to ``top`` and ``best``: the questions' five best documents; ``boost`` is a table (item_id, doc_id, boost)."""
    total = "sims" if not boost else f"(SELECT item_id, doc_id, coalesce(sim, 0) + coalesce(boost, 0) AS sim FROM sims FULL JOIN {boost} USING (item_id, doc_id))"
    return f"""
    dc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tokens_sql("text", "retrieval")}) AS term FROM documents) GROUP BY ALL),
    qc AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest({tokens_sql("text", "retrieval")}) AS term FROM {questions}) GROUP BY ALL),
    i AS (SELECT term, ln((SELECT count(*) FROM documents) / (1 + count(*))) AS idf FROM dc GROUP BY term),
    dw AS (SELECT doc_id, term, tf * idf AS w FROM dc JOIN i USING (term)), qw AS (SELECT item_id, term, tf * idf AS w FROM qc JOIN i USING (term)),
    dn AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM dw GROUP BY 1), qn AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM qw GROUP BY 1),
    dots AS (SELECT item_id, doc_id, sum(qw.w * dw.w) AS dot FROM qw JOIN dw USING (term) GROUP BY ALL),
    sims AS (SELECT item_id, doc_id, CASE WHEN qn.n > 0 AND dn.n > 0 THEN dot / (qn.n * dn.n) ELSE 0 END AS sim FROM dots JOIN qn USING (item_id) JOIN dn USING (doc_id)),
    top AS (SELECT item_id, doc_id, round(sim, 4) AS sim, row_number() OVER (PARTITION BY item_id ORDER BY round(sim, 4) DESC, doc_id) AS rank FROM {total} WHERE sim > 0.01 QUALIFY rank <= 5),
    best AS (SELECT item_id, coalesce(max(sim), 0) AS best FROM benchmark LEFT JOIN top USING (item_id) GROUP BY 1)"""


COSINE = cosine_sql()


def top_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "item_id", "doc_id", "text", "text")


@query(f"WITH {COSINE} SELECT item_id, doc_id, sim, rank FROM top")
def tfidf_cosine_topk(spark, sf_dir):
    return top_matches(spark, sf_dir)


@query(f"WITH {COSINE} SELECT item_id, doc_id, sim, rank FROM top")
def tfidf_cosine_essential(spark, sf_dir):
    """The same rows from the postings of essential terms, as very many postings are read."""
    return retrieval.top_essential(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "item_id", "doc_id", "text", "text")[0]


@query(f"""WITH {COSINE} SELECT count(*) AS queries, round(avg(best), 4) AS mean_best, count(*) FILTER (best >= 0.5) AS excellent, count(*) FILTER (best >= 0.3 AND best < 0.5) AS good,
    count(*) FILTER (best >= 0.1 AND best < 0.3) AS partial, count(*) FILTER (best < 0.1) AS poor, count(*) FILTER (best = 0) AS no_match FROM best""")
def retrieval_bands(spark, sf_dir):
    return retrieval.evaluation(retrieval.best_of(table(spark, sf_dir, "benchmark"), top_matches(spark, sf_dir), "item_id"))


@query(f"WITH {COSINE} SELECT item_id, best FROM best WHERE best < 0.1")
def knowledge_gaps(spark, sf_dir):
    return retrieval.gaps(retrieval.best_of(table(spark, sf_dir, "benchmark"), top_matches(spark, sf_dir), "item_id"), None, "item_id")


@query(f"WITH {COSINE} SELECT source, count(*) FILTER (sim >= 0.3) AS well, count(*) FILTER (sim < 0.3) AS poorly FROM top JOIN documents USING (doc_id) WHERE rank = 1 GROUP BY source")
def retrieval_by_source(spark, sf_dir):
    return retrieval.coverage_by_sprint(top_matches(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id", "source")


#: A taxonomy for the questions at hand: names of nations by their first two letters, regions as objects, a few phrases.
TAXONOMY = """acronyms AS (SELECT n_name[1:2] AS acronym, min(n_name) AS meaning FROM nation GROUP BY 1),
    t AS (SELECT lower(acronym) AS tax, lower(meaning) AS also FROM acronyms UNION SELECT lower(p_brand), NULL FROM part UNION SELECT unnest(['mit license', 'apache license', 'password', 'the other']), NULL),
    q AS (SELECT item_id, tax, also FROM benchmark JOIN t ON contains(lower(text), tax)), d AS (SELECT doc_id, tax, also FROM documents JOIN t ON contains(lower(text), tax) OR contains(lower(text), also)),
    c AS (SELECT item_id, count(*) AS checks FROM q GROUP BY 1),
    boosts AS (SELECT item_id, doc_id, least(0.15, count(*) / any_value(checks) * 0.15) AS boost FROM q JOIN d ON q.tax = d.tax AND q.also IS NOT DISTINCT FROM d.also JOIN c USING (item_id) GROUP BY item_id, doc_id)"""


def taxonomy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Acronyms with meanings, objects, and all terms that boost."""
    acronyms = table(spark, sf_dir, "nation").groupBy(F.left("n_name", F.lit(2)).alias("acronym")).agg(F.min("n_name").alias("meaning"))
    objects = table(spark, sf_dir, "region").select(F.concat(F.replace("r_name", F.lit(" "), F.lit("_")), F.lit("__c")).alias("api_name"), F.initcap("r_name").alias("label"))
    more = table(spark, sf_dir, "part").select(F.col("p_brand").alias("term")).distinct().unionByName(spark.createDataFrame([(x,) for x in ("mit license", "apache license", "password", "the other")], "term string"))
    return acronyms, objects, acronyms.select(F.col("acronym").alias("term"), F.col("meaning").alias("also")).unionByName(more, allowMissingColumns=True)


@query(f"WITH {TAXONOMY} SELECT item_id, doc_id, round(boost, 6) AS boost FROM boosts")
def taxonomy_boost(spark, sf_dir):
    docs, asked = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return retrieval.boost(asked, docs, "item_id", "doc_id", "text", "text", taxonomy(spark, sf_dir)[2]).withColumn("boost", F.round("boost", 6))


EXPANDED = """a AS (SELECT item_id, meaning AS more FROM (SELECT item_id, unnest(regexp_extract_all(text, '[A-Z]{2,5}')) AS acronym FROM benchmark) JOIN acronyms USING (acronym)),
    o AS (SELECT item_id, replace(r_name, ' ', '_') || '__c ' || r_name AS more FROM benchmark JOIN region ON contains(lower(text), lower(r_name))),
    asked AS (SELECT item_id, concat_ws(' ', text, more) AS text FROM benchmark LEFT JOIN (SELECT item_id, string_agg(more, ' ') AS more FROM (SELECT * FROM a UNION ALL SELECT * FROM o) GROUP BY 1) USING (item_id))"""


@query(f"WITH {TAXONOMY}, {EXPANDED}, {cosine_sql('asked', 'boosts')} SELECT item_id, doc_id, sim, rank FROM top")
def retrieval_with_taxonomy(spark, sf_dir):
    """The reference's whole ranking: expanded questions, cosine, boost by the taxonomy."""
    docs, asked = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    acronyms, objects, terms = taxonomy(spark, sf_dir)
    questions = retrieval.expanded(asked, "item_id", "text", acronyms, objects)
    return retrieval.top_documents(docs, questions, "item_id", "doc_id", "text", "text", entries=retrieval.entries_of(asked, "item_id", "text", terms))


@query(f"WITH {COSINE}, gap AS (SELECT item_id FROM best WHERE best < 0.5) SELECT term, count(*) AS n FROM (SELECT unnest({tokens_sql('text', 'retrieval')}) AS term FROM benchmark JOIN gap USING (item_id)) GROUP BY term ORDER BY n DESC, term LIMIT 20")
def gap_terms(spark, sf_dir):
    """The terms of questions whose best match isn't excellent; below 0.1 there are hardly any on these tables."""
    asked = table(spark, sf_dir, "benchmark")
    best = retrieval.best_of(asked, top_matches(spark, sf_dir), "item_id")
    return retrieval.gap_terms(best.where("best < 0.5"), asked, "item_id", "text")


# --- objects ----------------------------------------------------------------


NAMED = f"""w AS (SELECT doc_id, source, text, regexp_extract_all(lower(text), '[a-zA-Z]{{2,}}') AS w FROM documents),
    o AS (SELECT DISTINCT w[1] || '_' || w[2] || '__c' AS api_name, w[1] || ' ' || w[2] AS label, w[1] || w[2] AS glued FROM w WHERE len(w) >= 2),
    said AS (SELECT doc_id, source, api_name FROM w JOIN o ON length(label) >= 8 AND contains(lower(text), label)
      UNION SELECT doc_id, source, api_name FROM (SELECT DISTINCT doc_id, source, unnest(w) AS word FROM w) JOIN o ON word = glued WHERE length(glued) >= 5 AND glued NOT IN ({quoted(fixed.COMMON_OBJECT_WORDS)}))"""


def named_objects(docs: DataFrame) -> DataFrame:
    """An object for each pair of words that some document begins with."""
    low = F.lower("text")
    # the first two words only, without cutting the whole text
    first, second = F.regexp_extract(low, "[a-zA-Z]{2,}", 0), F.regexp_extract(low, "(?s)[a-zA-Z]{2,}+.*?([a-zA-Z]{2,})", 1)
    pairs = docs.select(first.alias("a"), second.alias("b")).where("b <> ''").distinct()
    rows = pairs.select(F.concat("a", F.lit("_"), "b", F.lit("__c")).alias("api_name"), F.concat_ws(" ", "a", "b").alias("label"))
    return rows.withColumn("search_variants", T.search_variants(F.col("api_name"), F.col("label")))


@query(f"WITH {NAMED} SELECT doc_id, source, api_name FROM said")
def object_mentions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return topics.object_mentions(docs, named_objects(docs), "doc_id", "text", "source")


@query(f"WITH {NAMED} SELECT api_name, label, count(DISTINCT doc_id) AS stories, count(DISTINCT source) AS sprints FROM o LEFT JOIN said USING (api_name) GROUP BY ALL")
def object_references(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return topics.object_references(docs, named_objects(docs), "doc_id", "text", "source")


# --- conversations ----------------------------------------------------------


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").where("role = 'user'")
    return rows.select(F.col("conv_id").alias("conversation_id"), F.col("turn").alias("line_no"), F.col("text").alias("query"), T.intents(F.col("text")).alias("intents"), T.word_count(F.col("text")).alias("word_count"), F.col("turn").cast("string").alias("timestamp"))


def _intents_sql() -> str:
    # one pattern looks ahead, which DuckDB can't; there the rest of the match is told apart afterwards
    def found(p: str) -> str:
        if "(?!" in p:
            head = p.split("(?!")[0].removesuffix(r"\s+")
            return f"regexp_matches(text, '(?i){head}\\s(\\s|[^sSpP\\s]|s([^t]|$)|st([^o]|$)|sto([^r]|$)|stor([^y]|$)|p([^r]|$)|pr([^0-9]|$)|$)')"
        return f"regexp_matches(text, '(?i){p}')"

    each = [f"CASE WHEN {' OR '.join(found(p) for p in ps)} THEN '{name}' END" for name, ps in fixed.INTENTS.items()]
    return f"q AS (SELECT conv_id, turn, text, CASE WHEN len(l) > 0 THEN l ELSE ['general'] END AS intents FROM (SELECT *, list_filter([{', '.join(each)}], lambda x: x IS NOT NULL) AS l FROM conversations WHERE role = 'user'))"


@query(f"WITH {_intents_sql()}, u AS (SELECT unnest(intents) AS intent FROM q) SELECT intent, count(*) AS queries, round(count(*) / (SELECT count(*) FROM q) * 100, 1) AS pct FROM u GROUP BY intent")
def intent_distribution(spark, sf_dir):
    return conversations.intent_distribution(questions(spark, sf_dir))


@query(f"WITH {_intents_sql()}, u AS (SELECT conv_id, turn, left(text, 100) AS query, unnest(intents) AS intent FROM q) SELECT intent, conv_id AS conversation_id, turn AS line_no, query, row_number() OVER (PARTITION BY intent ORDER BY conv_id, turn) AS rank FROM u QUALIFY rank <= 3")
def intent_examples(spark, sf_dir):
    return conversations.intent_examples(questions(spark, sf_dir), ["conversation_id", "line_no"])


@query(f"""WITH q AS (SELECT *, {WORDS} AS w FROM conversations WHERE role = 'user') SELECT count(*) AS queries, count(DISTINCT conv_id) AS conversations, round(avg(w), 1) AS mean_words, median(w) AS median_words, max(w) AS max_words, min(w) AS min_words,
    min(CAST(turn AS VARCHAR)) AS first, max(CAST(turn AS VARCHAR)) AS last FROM q""")
def conversation_volume(spark, sf_dir):
    rows = questions(spark, sf_dir).withColumn("word_count", F.col("word_count").cast("bigint"))
    return conversations.volume(rows)


@query("""WITH q AS (SELECT conv_id, count(*) AS questions FROM conversations WHERE role = 'user' GROUP BY 1), a AS (SELECT conv_id, count(*) AS answers FROM conversations WHERE role <> 'user' GROUP BY 1)
    SELECT conv_id AS conversation_id, questions, coalesce(answers, 0) AS answers, questions BETWEEN 1 AND 2 AND coalesce(answers, 0) <= 3 AS abandoned, questions >= 3 AS long FROM q LEFT JOIN a USING (conv_id)""")
def short_conversations(spark, sf_dir):
    answers = table(spark, sf_dir, "conversations").where("role <> 'user'").select(F.col("conv_id").alias("conversation_id"))
    return conversations.by_length(questions(spark, sf_dir), answers)


# --- requests and indexes ---------------------------------------------------


@query("SELECT chunk, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 30 AS chunk FROM documents) GROUP BY chunk")
def chunk_requests(spark, sf_dir):
    rows = extraction.chunked(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 30)
    return rows.groupBy("chunk").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("""WITH s AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS chunk, doc_id, '### ' || doc_id || ': ' || left(text, 60) || chr(10) || 'Type: ' || lang || chr(10) || 'Components: ' || source || chr(10) || 'Description: ' || left(text, 1500) AS t FROM documents)
    SELECT 'glossary-' || lpad(CAST(chunk AS VARCHAR), 3, '0') AS custom_id, CAST(length('Stories:' || chr(10)) + sum(length(t)) + 2 * (count(*) - 1) AS INTEGER) AS prompt_chars, count(*) AS n_stories FROM s GROUP BY chunk""")
def render_prompt_sizes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").cast("string").alias("story_id"), "doc_id", F.left("text", F.lit(60)).alias("summary"), F.col("lang").alias("type"), F.lit("").alias("epic"), F.col("source").alias("components"), F.lit("").alias("labels"), F.col("text").alias("description"), F.lit("").alias("acceptance_criteria"), F.lit("").alias("solution"))
    asked = extraction.requests(rows, "glossary", "Stories:\n{{STORIES}}", ["doc_id"], extraction.ExtractionConfig(batch_size=20))
    return asked.select("custom_id", F.length("prompt").alias("prompt_chars"), "n_stories")


def ordered(docs: DataFrame, **columns: Column | str) -> DataFrame:
    """Documents as rows of an index's responses, in the order of their ids."""
    return docs.select(F.struct("doc_id", F.lit(0).alias("p")).alias("__o"), *((F.lit(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()))


@query("""WITH u AS (SELECT upper(trim(source)) AS k, list_sort(list(DISTINCT lang)) AS found_in, list_sort(list(DISTINCT left(text, 2))) AS synonyms FROM documents GROUP BY 1)
    SELECT source AS term, CAST(doc_id AS VARCHAR) AS definition, found_in, synonyms FROM documents JOIN u ON upper(trim(source)) = k QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1""")
def assemble_glossary(spark, sf_dir):
    rows = ordered(table(spark, sf_dir, "documents"), term=F.col("source"), definition=F.col("doc_id").cast("string"), found_in=F.array("lang"), synonyms=F.array(F.left("text", F.lit(2))))
    return extraction.assemble(rows, "glossary")


@query("SELECT source AS id, CAST(doc_id AS VARCHAR) AS summary, lang AS action_type FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1")
def assemble_summaries(spark, sf_dir):
    return extraction.assemble(ordered(table(spark, sf_dir, "documents"), id=F.col("source"), summary=F.col("doc_id").cast("string"), action_type=F.col("lang")), "story_summaries")


@query("SELECT source AS story_id, source || '-' || lang AS rule_id, CAST(n_chars AS VARCHAR) AS trigger FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1")
def assemble_rules(spark, sf_dir):
    return extraction.assemble(ordered(table(spark, sf_dir, "documents"), story_id=F.col("source"), rule_id=F.concat_ws("-", "source", "lang"), trigger=F.col("n_chars").cast("string")), "business_rules")


@query("SELECT source AS from_story, lang AS to_story, 'r' || doc_id % 3 AS relationship, CAST(doc_id AS VARCHAR) AS reason FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang, doc_id % 3 ORDER BY doc_id) = 1")
def assemble_links(spark, sf_dir):
    kind = F.concat(F.lit("r"), (F.col("doc_id") % 3).cast("string"))
    return extraction.assemble(ordered(table(spark, sf_dir, "documents"), from_story=F.col("source"), to_story=F.col("lang"), relationship=kind, reason=F.col("doc_id").cast("string")), "cross_story_links")


@query("""WITH u AS (SELECT lang, list_sort(list(DISTINCT source)) AS query_variations, list_sort(list(DISTINCT CAST(doc_id % 10 AS VARCHAR))) AS relevant_stories FROM documents GROUP BY 1)
    SELECT lang AS intent_id, CAST(doc_id AS VARCHAR) AS canonical_question, query_variations, relevant_stories FROM documents JOIN u USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) = 1""")
def assemble_intents(spark, sf_dir):
    rows = ordered(table(spark, sf_dir, "documents"), intent_id=F.col("lang"), canonical_question=F.col("doc_id").cast("string"), query_variations=F.array("source"), relevant_stories=F.array((F.col("doc_id") % 10).cast("string")))
    return extraction.assemble(rows, "intent_mapping")


@query("SELECT source, lang, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1")
def keep_first(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], ["doc_id"])


@query("SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1")
def keep_last(spark, sf_dir):
    return dedup.keep_last(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], ["doc_id"])


@query("SELECT source, list_sort(list(DISTINCT lang)) AS langs FROM documents GROUP BY source")
def array_union(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", F.array("lang").alias("langs"))
    return dedup.array_union(rows, ["source"], "langs")


@query("""WITH g AS (SELECT lang AS canonical, doc_id AS o, unnest([lower(left(text, 3)), lower(left(text, 4))]) AS phrase FROM documents),
    p AS (SELECT canonical, phrase, min(o) AS o FROM g GROUP BY ALL) SELECT canonical, count(*) AS variants, min(phrase) AS first_phrase FROM p GROUP BY canonical""")
def assemble_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    phrase = lambda n: F.struct(F.lower(F.left("text", F.lit(n))).alias("phrase"), F.lit("synonym").alias("relationship"), F.lit("high").alias("confidence"))
    rows = docs.select(F.struct("doc_id", F.lit(0).alias("p")).alias("__o"), F.upper("lang").alias("canonical"), F.array(phrase(3), phrase(4)).alias("variants"), F.lit("c").alias("category"), F.array().cast("array<string>").alias("related_stories"))
    out = extraction.assemble(rows, "semantic_similarity")
    return out.select(F.lower("canonical").alias("canonical"), F.size("variants").cast("bigint").alias("variants"), F.array_min(F.transform("variants", lambda v: v["phrase"])).alias("first_phrase"))


@query("""SELECT count(*) AS rows, count(*) FILTER (doc_id % 7 <> 0 AND lang IN ('en', 'fr') AND length(left(text, 40)) >= 10) AS valid FROM documents""")
def validate_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.struct("doc_id").alias("__o"), F.when(F.col("doc_id") % 7 != 0, F.col("doc_id").cast("string")).alias("id"), F.left("text", F.lit(40)).alias("summary"), F.col("lang").alias("action_type"), F.struct(F.lit(1)).alias("entities"), F.col("source").alias("business_domain"))
    return extraction.problems(rows, "story_summaries", {"action_type": ["en", "fr"]}).agg(F.count("*").alias("rows"), F.count_if(F.size("problems") == 0).alias("valid"))


def _cleaned_sql() -> str:
    """Struck text and colours without look-ahead: a dash before a space, a stop or the end is marked first, and marks that struck nothing are dashes again."""
    text = "regexp_replace(trim(text), '(?is)<s\\b[^>]*>.*?</s>|<strike\\b[^>]*>.*?</strike>|<del\\b[^>]*>.*?</del>', '', 'g')"
    text = f"regexp_replace({text}, '(?is)<span[^>]*line-through[^>]*>.*?</span>', '', 'g')"
    text = f"regexp_replace({text}, '-([ \\n.,;:)]|$)', chr(1) || '\\1', 'g')"
    text = f"regexp_replace({text}, '(^|[ \\n(])[-\\x01]([^ \\n\\x01-]|[^ \\n\\x01-][^\\n]*?[^ \\n\\x01-])\\x01', '\\1', 'g')"
    return f"regexp_replace(regexp_replace(replace({text}, chr(1), '-'), '\\{{color(:[^}}]+)?\\}}', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"


@query(f"SELECT doc_id, length(x) AS n, md5(x) AS digest FROM (SELECT doc_id, {_cleaned_sql()} AS x FROM documents)")
def markup_clean(spark, sf_dir):
    cleaned = T.clean_markup(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(cleaned).alias("n"), F.md5(cleaned).alias("digest"))


def written_and_parsed(docs: DataFrame) -> DataFrame:
    """Every document's whole text as a story's section, written as markdown and parsed again."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("story_id"), F.get(F.split(text, "\r\n?|\n"), F.lit(0)).alias("summary"), F.col("source").alias("c"), F.col("lang").alias("t"), text.alias("d"))
    files = rows.select(F.concat(F.lit("/Sprint 1/stories/"), "story_id", F.lit(".md")).alias("file_path"), F.lit(0).cast("bigint").alias("file_size"), F.lit("Sprint 1").alias("sprint"), stories.to_markdown(rows, {"Components": "c", "Type": "t"}, {"Description": "d"}).alias("text"))
    return stories.parse(files, id_pattern=r"^\d+(?=:)")


@query("SELECT CAST(doc_id AS VARCHAR) AS story_id, trim(split_part(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10), 1)) AS summary, trim(source) AS components, trim(lang) AS type FROM documents")
def md_roundtrip(spark, sf_dir):
    """What SQL can say of the round trip: title and fields of every row; ``md_roundtrip_whole`` has the sections."""
    field = lambda k: F.coalesce(F.col("metadata")[k], F.lit(""))
    return written_and_parsed(table(spark, sf_dir, "documents")).select("story_id", "summary", field("Components").alias("components"), field("Type").alias("type"))


@query()
def md_roundtrip_whole(spark, sf_dir):
    """Every document's whole text as its section, there and back: all sections that it is parsed into, by their digest."""
    parsed = written_and_parsed(table(spark, sf_dir, "documents"))
    field = lambda k: F.coalesce(F.col("metadata")[k], F.lit(""))
    whole = F.array_join(F.transform(F.map_entries("sections"), lambda e: F.concat(e["key"], F.lit("\n"), e["value"]["content"])), "\n## ")
    return parsed.select("story_id", "summary", field("Components").alias("components"), field("Type").alias("type"), F.size("sections").alias("sections"), F.length(whole).alias("chars"), F.md5(whole).alias("digest"))


# --- lookups ----------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'license')")
def mentioning_phrase(spark, sf_dir):
    return lookups.mentioning(table(spark, sf_dir, "documents"), "license", "text").select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {WORDS} <= 3")
def missing_sections(spark, sf_dir):
    return lookups.without(table(spark, sf_dir, "documents"), "text").select("doc_id")


@query("""WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS story_id, year(l_shipdate) AS y, p_brand AS component FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) IN (1994, 1995))
    SELECT component, count(DISTINCT story_id) FILTER (y = 1995) AS now, count(DISTINCT story_id) FILTER (y = 1994) AS before FROM r GROUP BY component HAVING now > 0 AND before > 0""")
def shared_components(spark, sf_dir):
    rows = component_rows(spark, sf_dir).select(F.col("story").cast("string").alias("story_id"), F.col("span").alias("sprint_no"), F.col("component").alias("components"))
    return lookups.shared_components(rows, 1995)


@query("""WITH r AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS story_id, CAST(year(l_shipdate) AS INTEGER) AS sprint_no, l_linestatus AS status FROM lineitem), m AS (SELECT story_id FROM r GROUP BY 1 HAVING count(DISTINCT sprint_no) > 1), one AS (SELECT story_id, sprint_no, max(status) AS status FROM r WHERE story_id IN (SELECT story_id FROM m) GROUP BY ALL)
    SELECT story_id, sprint_no, lag(status) OVER (PARTITION BY story_id ORDER BY sprint_no) AS was, status FROM one""")
def story_progression(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("story_id"), F.year("l_shipdate").alias("sprint_no")).agg(F.max("l_linestatus").alias("status"))
    return lookups.progression(rows)

