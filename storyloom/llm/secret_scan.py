"""Secret scans through a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query of trigrams is derived: an
OR of ANDs that every text with a match fulfils.  One pass over the texts makes
the index: for each trigram of these queries the documents that hold it (lower-
cased).  A rule's candidates are found by intersecting postings, and only their
texts are fetched and verified by the rule's expression.  Rules without
mandatory trigrams scan every text, in the pass that makes the index.

Postings name a document by doc_id and a hash of its text.  Texts meet their
candidates in one join; on large inputs Spark's run-time Bloom filter keeps the
texts of all others out of its shuffle.

Null and empty texts have no spans.  Offsets count code points.  Very long texts
are scanned whole, their spans gathered in runs.  Repeated rows and null ids are
scanned like any other row, and other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read, unused

#: Strings that a part of an expression may stand for, at most, before it counts as unknown.
MOST = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    #: Means the same in Python's and Java's dialect, and in DuckDB's but for private keys.
    pattern: str
    #: A match counts if this group has at least so many characters.
    group: int = 0
    least: int = 1


RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{30,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # to the END line if that is the next mark, else the lines of a body without one; possessive, so that Java needs no stack
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]*PRIVATE KEY-----|(?:[ \t\r\n]+[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=]*)*+)"),
)
#: The first three are the base of the query's contract.
BASE = 3


def strings_of(tree, flags: int = 0) -> tuple[frozenset[str] | None, list[frozenset[str]]]:
    """All strings that a parsed expression stands for (None: too many), and what must occur anyway.

    Each item of the second is a set of strings of which one occurs in any match.
    """
    known: frozenset[str] | None = frozenset([""])
    musts: list[frozenset[str]] = []
    whole = True
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            part, inner = frozenset([chr(arg).lower()]), []
        elif name == "SUBPATTERN":
            part, inner = strings_of(arg[3])
        elif name == "BRANCH":
            each = [strings_of(x) for x in arg[1]]
            part = frozenset().union(*(e[0] for e in each)) if all(e[0] is not None for e in each) else None
            inner = []
        elif name == "MAX_REPEAT" and arg[:2] == (0, 1):
            part, inner = strings_of(arg[2])
            part, inner = (part | {""} if part is not None else None), []
        elif name == "MAX_REPEAT" and arg[0] and (got := strings_of(arg[2]))[0] is not None and len(got[0]) == 1 and arg[0] <= 8:
            part, inner = (frozenset([next(iter(got[0])) * arg[0]]), []) if arg[0] == arg[1] else (None, [frozenset([next(iter(got[0])) * arg[0]])])
        elif name == "IN" and not any(str(x[0]) == "NEGATE" for x in arg):
            chars = set()
            for kind, value in arg:
                chars |= {chr(value).lower()} if str(kind) == "LITERAL" else {chr(c).lower() for c in range(value[0], min(value[1], value[0] + MOST) + 1)} if str(kind) == "RANGE" else set(map(str, range(MOST + 1)))
            part, inner = (frozenset(chars), []) if len(chars) <= 5 else (None, [])
        else:
            part, inner = None, []
        if part is not None and len(known) * len(part) <= MOST:
            known = frozenset(a + b for a in known for b in part)
            continue
        musts += [known, *inner]
        whole = False
        known = part if part is not None and len(part) <= MOST else frozenset([""])
    return (known, musts) if whole else (None, [*musts, known])


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """OR of ANDs: sets of trigrams, one of which every lower-cased match has whole; empty: no query."""
    known, musts = strings_of(re._parser.parse(pattern))
    best: list[frozenset[str]] = []
    for strings in [known] if known is not None else musts:
        if strings and all(len(s) >= 3 for s in strings):
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            least = [s for s in sets if not any(t < s for t in sets)]
            if not best or min(map(len, least)) > min(map(len, best)):
                best = sorted(least, key=sorted)
    return best


def trigrams(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for s in trigram_query(r.pattern) for t in s})


def trie(words: list[str]) -> str:
    """An expression for any of the words, which shares their beginnings."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[0], []).append(w[1:])
    parts = [re.escape(c) + (trie(rest) if any(rest) else "") for c, rest in sorted(heads.items())]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def held_trigrams(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Which of the rules' trigrams a text has: the document's entries of the index."""
    words = trigrams(rules)
    if not words:
        return F.array().cast("array<string>")
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?=({trie(words)}))"), F.lit(1)))


SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def named(docs: DataFrame) -> DataFrame:
    """id, key, text: how postings name a document, and its text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def postings(index: DataFrame) -> DataFrame:
    """trigram, id, key: the lists of the index."""
    return index.select(F.explode("held").alias("trigram"), "id", "key")


def candidates(lists: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id, key, wanted: documents in the intersection of the postings of some AND of a rule's query, and those rules."""
    rows = []
    for k, rule in enumerate(rules):
        for c, grams in enumerate(trigram_query(rule.pattern)):
            rows += [(t, k, c, 1 << i, (1 << len(grams)) - 1) for i, t in enumerate(sorted(grams))]
    # one row for each trigram of the rules; a bit for each list, so a document that comes again counts once
    query = F.broadcast(lists.sparkSession.createDataFrame(rows, "trigram string, rule int, conjunct int, bit long, whole long"))
    met = lists.join(query, "trigram").groupBy("id", "key", "rule", "conjunct", "whole").agg(F.bit_or("bit").alias("have"))
    return met.where("have = whole").groupBy("id", "key").agg(F.collect_set("rule").alias("wanted"))  # as many as there are rules


#: Matches that are gathered at a time, so that a text with very many costs little more for each.
RUN = 500


def spans_of(matches: str, pieces: str, rule: Rule, rank: int) -> Column:
    """Spans of a rule: between the matches lie the pieces, so lengths add up to offsets."""
    pattern = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    span = "struct<start:int,rank:int,end:int,kind:string>"
    match = f"element_at({matches}, i)"
    body = f"length({match})" if rule.group == 0 else f"length(regexp_extract({match}, '{pattern}', {rule.group}))"
    start = f"acc.at + length(element_at({pieces}, i))"
    run = f"""
        aggregate(
          sequence(b * {RUN} + 1, least(size({matches}), (b + 1) * {RUN})),
          named_struct('at', all.at, 'out', cast(array() as array<{span}>)),
          (acc, i) -> named_struct(
            'at', {start} + length({match}),
            'out', if({body} >= {rule.least}, array_append(acc.out, named_struct(
              'start', {start}, 'rank', {rank}, 'end', {start} + length({match}), 'kind', '{rule.kind}')), acc.out)))"""
    return F.expr(f"""
        aggregate(
          sequence(0, cast((size({matches}) - 1) div {RUN} as int)),
          named_struct('at', 0, 'out', cast(array() as array<array<{span}>>)),
          (all, b) -> transform(array({run}), r -> named_struct('at', r.at, 'out', array_append(all.out, r.out)))[0],
          all -> flatten(all.out))""")


def with_spans(rows: DataFrame, rules: tuple[Rule, ...], asked: dict[int, Column], out: str) -> DataFrame:
    """``rows`` (id, key, text) with the spans of the rules that are ``asked`` of a row, unordered."""
    none = F.array().cast("array<string>")
    keep = rows.columns
    for k, wanted in asked.items():
        rows = rows.withColumn(f"m{k}", F.when(wanted, F.regexp_extract_all("text", F.lit(rules[k].pattern), F.lit(0))).otherwise(none))
    for k in asked:
        rows = rows.withColumn(f"p{k}", F.when(F.size(f"m{k}") > 0, F.split("text", rules[k].pattern, -1)).otherwise(none))
    each = [F.when(F.size(f"m{k}") > 0, spans_of(f"m{k}", f"p{k}", rules[k], k)).otherwise(F.array().cast(f"array<{SPAN}>")) for k in asked]
    return rows.select(*keep, F.concat(*each, F.array().cast(f"array<{SPAN}>")).alias(out))


def found(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id, key, spans of every row of ``docs``: spans are (start, rank, end, kind) by start, then by the rules' order."""
    scratch = Scratch(docs.sparkSession, "secrets")
    rows = named(docs)
    full = {k: F.lit(True) for k, r in enumerate(rules) if not trigram_query(r.pattern)}
    index = scratch.table(with_spans(rows, rules, full, "scanned").withColumn("held", held_trigrams(F.col("text"), rules)).drop("text"), "index")
    asked = {k: F.array_contains("wanted", k) for k in range(len(rules)) if k not in full}
    if not asked:
        return index.select("id", "key", F.array_sort("scanned").alias("spans"))
    some = scratch.table(candidates(postings(index), rules), "candidates")
    same = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["key"] == b["key"])
    fetched = rows.join(some, same(rows, some)).select(rows["id"], rows["key"], "text", "wanted")
    # written before it is filtered: a filter pushed below would work the spans out anew for every match
    checked = scratch.table(with_spans(fetched, rules, asked, "checked").select("id", "key", "checked"), "checked")
    checked = checked.where(F.size("checked") > 0).groupBy("id", "key").agg(F.first("checked").alias("checked"))  # rows that repeat have the same spans
    every = index.join(checked, same(index, checked), "left").select(index["id"], index["key"], "scanned", "checked")
    return every.select("id", "key", F.array_sort(F.concat("scanned", F.coalesce("checked", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, out: str = "spans") -> DataFrame:
    """``docs`` with its spans as the column ``out``; see ``found``."""
    spans = found(docs, rules).where(F.size("spans") > 0).groupBy("id", "key").agg(F.first("spans").alias("spans"))
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    rows = docs.join(spans, docs["doc_id"].cast("long").eqNullSafe(spans["id"]) & (text == spans["key"]), "left")
    return rows.select(*(docs[c] for c in docs.columns if c != out), F.coalesce(spans["spans"], F.array().cast(f"array<{SPAN}>")).alias(out))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts and digest of the base kinds, and all spans."""
    rows = found(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "spans")
    count = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long").alias(f"n_{RULES[k].kind}")
    base = F.filter("spans", lambda s: s["rank"] < BASE)
    return rows.select("doc_id", *(count(k) for k in range(BASE)), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def key_sql(rank: int) -> str:
    """Private keys without looking ahead: the text is cut at its marks, and a BEGIN looks at what the next mark is."""
    mark = "'-----BEGIN [A-Z ]*PRIVATE KEY-----|-----(?:BEGIN|END) '"
    last, lines = "'^[A-Z ]*PRIVATE KEY-----'", "'^(?:[ \\t\\r\\n]+[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=]*)*'"
    return f"""SELECT row, {rank} AS rank, 'pem' AS kind, "start", "start" + length(m) + CASE WHEN m2 = '-----END ' AND regexp_matches(p3, {last})
            THEN length(p2) + length(m2) + length(regexp_extract(p3, {last})) ELSE length(regexp_extract(p2, {lines})) END AS "end" FROM (
          SELECT row, m, lead(p) OVER w AS p2, lead(m) OVER w AS m2, lead(p, 2) OVER w AS p3, CAST(sum(length(p) + coalesce(length(m), 0)) OVER w - length(m) AS BIGINT) AS "start"
          FROM (SELECT row, unnest(regexp_extract_all(text, {mark})) AS m, unnest(regexp_split_to_array(text, {mark})) AS p, generate_subscripts(regexp_split_to_array(text, {mark}), 1) AS i FROM d) WINDOW w AS (PARTITION BY row ORDER BY i))
          WHERE regexp_matches(m, 'KEY-----$')"""


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same rows in DuckDB's SQL: every rule on every text, offsets from the pieces between the matches."""
    each = []
    for k, r in enumerate(rules):
        if r.kind == "pem":
            each.append(key_sql(k))
            continue
        pattern = "'" + r.pattern.replace("'", "''") + "'"
        body = "m" if not r.group else f"regexp_extract(m, {pattern}, {r.group})"
        each.append(f"""SELECT row, {k} AS rank, '{r.kind}' AS kind, "start", "start" + length(m) AS "end" FROM (
          SELECT row, m, CAST(sum(length(p) + length(m)) OVER (PARTITION BY row ORDER BY i) - length(m) AS BIGINT) AS "start"
          FROM (SELECT row, unnest(regexp_extract_all(text, {pattern})) AS m, unnest(regexp_split_to_array(text, {pattern})) AS p, generate_subscripts(regexp_split_to_array(text, {pattern}), 1) AS i FROM d) WHERE m IS NOT NULL)
          WHERE length({body}) >= {r.least}""")
    said = "string_agg(kind || ':' || \"start\" || ':' || \"end\", ',' ORDER BY \"start\", rank)"
    counts = ", ".join(f"count(rank) FILTER (rank = {k}) AS n_{r.kind}" for k, r in enumerate(rules[:BASE]))
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        s AS ({" UNION ALL ".join(each)})
        SELECT doc_id, {counts}, sha256(coalesce({said} FILTER (rank < {BASE}), '')) AS base_sha256, coalesce({said}, '') AS spans
        FROM d LEFT JOIN s USING (row) GROUP BY row, doc_id"""


def redacted(text: Column, spans: Column) -> Column:
    """The text with every run of overlapping spans replaced by ``[secret:kind]`` of its first."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        gap = F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("[secret:"), s["kind"], F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], gap)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, their secrets replaced and n_chars, where there is one, counted again."""
    out = unused("spans", docs.columns)
    rows = find(docs, out=out)
    some = F.size(out) > 0
    rows = rows.withColumn("text", F.when(some, redacted(F.col("text"), F.col(out))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(some, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
