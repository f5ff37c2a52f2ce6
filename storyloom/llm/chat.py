"""Chat formatting by quotation linking.

Nested quote levels (``>`` at the start of lines, also ``> >`` and ``>>``) are
parsed into passages.  The normalised text (lower-cased words) of a passage and
of each of its sentences is hashed.  A quoted passage links to the latest
earlier message of the conversation that wrote the whole passage itself; if none
did, to the one that wrote sentences with most of its words, the latest of
equals, if that is half of them or more.  So a quotation may leave sentences out
or run over several paragraphs' ends; a part of one sentence links nothing.  What was replied to is
the message that the outermost linked quotation is of.  A quotation that nobody
wrote links nothing, and a message without links answers the one before.
Conversations are returned without quotes, in reply order: each message after
the one it answers, siblings by turn.

Messages with null conv_id or turn can't be ordered and are left out; null texts
are empty messages.  Of repeated rows of one turn, the greatest (role, text)
stands.  Very long messages are parsed whole; other columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read, sliced

QUOTE = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
QUOTED = re.compile(r"^[ \t]*>", re.MULTILINE)
#: "On ..., ... wrote:" before a quotation belongs to it.
INTRO = re.compile(r"\b(?:wrote|schrieb|a écrit|escribió):[ \t\r]*$")
WORDS = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Passage:
    level: int
    text: str


def passages(text: str | None) -> list[Passage]:
    """Runs of lines at one quote level, blank lines dividing them; the markers are gone."""
    out: list[Passage] = []
    level, lines = 0, []

    def close():
        body = "\n".join(lines).strip("\n")
        if body.strip():
            out.append(Passage(level, body))
        lines.clear()

    for line in (text or "").split("\n"):
        mark = QUOTE.match(line)
        here = mark.group(1).count(">") if mark else 0
        body = line[mark.end() :] if mark else line
        if here != level or not body.strip():
            if here > level and lines and INTRO.search(lines[-1]):
                lines.pop()
            close()
            level = here
        if body.strip():
            lines.append(body.rstrip("\r"))
    close()
    return out


def normal_hash(words: list[str]) -> int:
    """Signed 64-bit hash of lower-cased words."""
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)


def keys_of(text: str) -> dict[int, int]:
    """Hashes of a passage and of its sentences, with their numbers of words; the passage's first, none without words."""
    out: dict[int, int] = {}
    for part in (text, *SENTENCE.split(text)):
        words = WORDS.findall(part.lower())
        if words:
            out.setdefault(normal_hash(words), len(words))
    return out


PART = "struct<quote:int,level:int,key:long,words:int,whole:int>"


def parts_of(found: list[Passage]) -> list[dict]:
    """What a message wrote (quote -1, each key once) and what its quoted passages, numbered from 0, are made of."""
    own = {k: n for p in found if not p.level for k, n in keys_of(p.text).items()}
    out = [{"quote": -1, "level": 0, "key": k, "words": n, "whole": n} for k, n in own.items()]
    for p in found:
        keys = keys_of(p.text) if p.level else {}
        quote = out[-1]["quote"] + 1 if out else 0
        whole = next(iter(keys.values()), 0)
        out += [{"quote": quote, "level": p.level, "key": k, "words": n, "whole": whole} for k, n in keys.items()]
    return out


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body (own text), depth, parts: see ``parts_of``."""
    kind = f"conv_id long, turn long, role string, body string, depth int, parts array<{PART}>"

    def run(batches):
        kinds = pa.list_(pa.struct([("quote", pa.int32()), ("level", pa.int32()), ("key", pa.int64()), ("words", pa.int32()), ("whole", pa.int32())]))
        for batch in sliced(batches):
            body, depth, parts = [], [], []
            for text in batch.column("text").to_pylist():
                found = passages(text)
                body.append("\n\n".join(p.text for p in found if not p.level) if QUOTED.search(text or "") else text or "")
                depth.append(max((p.level for p in found), default=0))
                parts.append(parts_of(found))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(body, pa.string()), pa.array(depth, pa.int32()), pa.array(parts, kinds)], names=["conv_id", "turn", "role", "body", "depth", "parts"])

    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text").where("conv_id is not null and turn is not null")
    return rows.mapInArrow(run, kind)


#: Turns of a stretch: a conversation's messages are numbered by stretches, however many it has.
STRETCH = 512


def in_stretches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``before`` and ``after`` (turns next to it) and ``index`` (0, 1, ...) among the rows of equal keys.

    Windows run within stretches of turns, and over one row for each stretch, so
    that a group with very many rows is never in one task.  Turns don't repeat in a group.
    """
    rows = rows.withColumn("__k", F.floor(F.col("turn") / STRETCH))
    near = Window.partitionBy(*keys, "__k").orderBy("turn")
    order = Window.partitionBy(*keys).orderBy("__k")
    ends = rows.groupBy(*keys, "__k").agg(F.count("*").alias("__n"), F.min("turn").alias("__first"), F.max("turn").alias("__last"))
    so_far = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(*keys, "__k", F.coalesce(so_far, F.lit(0)).alias("__base"), F.lag("__last").over(order).alias("__prev"), F.lead("__first").over(order).alias("__next"))
    inner = rows.withColumns({"before": F.lag("turn").over(near), "after": F.lead("turn").over(near), "index": F.row_number().over(near) - 1})
    match = [F.col(f"i.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*keys, "__k"]]
    both = inner.alias("i").join(ends.alias("e"), match)
    return both.select(*(F.col(f"i.{c}").alias(c) for c in rows.columns if c != "__k"), F.coalesce("before", "__prev").alias("before"), F.coalesce("after", "__next").alias("after"), (F.col("__base") + F.col("index")).alias("index"))


def sources(parts: DataFrame) -> DataFrame:
    """conv_id, turn, key, source: the latest earlier turn that wrote what a turn quotes.

    Writers and quoters of a key stand in one order, where each quoter takes the last writer before it: in its
    stretch of turns, else from the stretches before, of which there is one row each.  No pairs are made.
    """
    own = F.col("quote") < 0
    events = parts.groupBy("conv_id", "key", "turn").agg(F.max(own).alias("wrote"), F.max(~own).alias("quotes")).withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    written = F.when(F.col("wrote"), F.col("turn"))
    near = Window.partitionBy("conv_id", "key", "stretch").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv_id", "key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = events.groupBy("conv_id", "key", "stretch").agg(F.max(written).alias("last"), F.max("quotes").alias("any"))
    before = ends.withColumn("far", F.max("last").over(far)).where("any and far is not null").select("conv_id", "key", "stretch", "far")
    found = events.withColumn("near", F.max(written).over(near)).where("quotes").join(before, ["conv_id", "key", "stretch"], "left")
    return found.select("conv_id", "turn", "key", F.coalesce("near", "far").alias("source")).where("source is not null")


def partial(left: DataFrame, own: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, quote, level, source of quotations that nobody wrote whole.

    Messages that wrote the same of the quoted sentences are one class.  A quotation asks the classes that have any of
    its rarest sentences, as many as half of its words can't do without, counts all its words in each, and finds the
    latest earlier message of a class in one order of writers and askers.  So the rows are quotations times those
    classes that could have half of their words, however many messages a class has.
    """
    quoted = ["conv_id", "turn", "quote"]
    asked = left.select("conv_id", "key").distinct()
    held = own.join(asked, ["conv_id", "key"], "left_semi").groupBy("conv_id", "turn").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    held = scratch.table(held.withColumn("class", F.xxhash64("keys")), "held")
    classes = held.groupBy("conv_id", "class").agg(F.first("keys").alias("keys")).select("conv_id", "class", F.explode("keys").alias("key"))
    written = scratch.table(left.join(classes.groupBy("conv_id", "key").agg(F.count("*").alias("held")), ["conv_id", "key"]), "written")
    commoner = Window.partitionBy(*quoted).orderBy(F.desc("held"), "key").rowsBetween(Window.unboundedPreceding, 0)
    rare = written.withColumn("rest", F.sum("words").over(commoner)).where("2 * rest >= whole")
    met = rare.join(classes, ["conv_id", "key"]).select(*quoted, "class").distinct()
    shares = met.join(written, quoted).join(classes, ["conv_id", "class", "key"]).groupBy(*quoted, "level", "whole", "class").agg(F.sum("words").alias("words")).where("2 * words >= whole")
    shares = scratch.table(shares, "shares")
    events = held.select("conv_id", "turn", F.col("class").alias("key"), F.lit(-1).alias("quote")).unionByName(shares.select("conv_id", "turn", F.col("class").alias("key"), "quote"))
    found = shares.join(sources(events).withColumnRenamed("key", "class"), ["conv_id", "turn", "class"])
    return found.groupBy(*quoted, "level").agg(F.max(F.struct("words", "source"))["source"].alias("source"))


def linked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds n_quotes, n_linked, reply_to (turn of the message answered; null at the beginning), before and index."""
    parts = rows.select("conv_id", "turn", F.explode("parts").alias("part")).select("conv_id", "turn", "part.*")
    whole = parts.where("words = whole")  # all that a message wrote, and of a quotation itself
    best = whole.where("quote >= 0").join(sources(whole), ["conv_id", "turn", "key"]).select("conv_id", "turn", "quote", "level", "source")
    best = scratch.table(best, "whole")
    left = scratch.table(parts.where("quote >= 0 and words < whole").join(best, ["conv_id", "turn", "quote"], "left_anti"), "left")
    if not left.isEmpty():
        best = best.unionByName(partial(left, parts.where("quote < 0").select("conv_id", "turn", "key"), scratch))
    # a quotation at level 1 is of what is answered; deeper ones are of what that answered
    found = best.groupBy("conv_id", "turn").agg(F.min_by("source", F.struct("level", -F.col("source"))).alias("quoted_turn"), F.count("*").alias("n_linked"))
    counts = rows.withColumn("n_quotes", F.aggregate("parts", F.lit(-1), lambda a, p: F.greatest(a, p["quote"])).cast("long") + 1)
    out = in_stretches(counts.drop("parts"), ["conv_id"]).join(found, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", "body", "depth", "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.coalesce("quoted_turn", "before").alias("reply_to"), "before", "index")


def reply_order(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds reply_depth and place (0, 1, ... in the conversation), parents before children, siblings by turn.

    Where each message answers the one before, both are its index.  Other
    conversations are walked as an Euler tour: each message has a way down and a
    way up, each way has a next one, and sums along the ways are found by
    doubling, in as many rounds as the log of the longest conversation.
    """
    branching = scratch.table(rows.where(~F.col("reply_to").eqNullSafe(F.col("before"))).select("conv_id").distinct(), "branching")
    plain = rows.join(branching, "conv_id", "left_anti").withColumns({"place": F.col("index"), "reply_depth": F.col("index")})
    if branching.isEmpty():
        return plain
    tree = rows.join(branching, "conv_id", "left_semi").select("conv_id", "turn", "reply_to")
    siblings = in_stretches(tree, ["conv_id", "reply_to"]).select("conv_id", "turn", "reply_to", "after")
    first = tree.where("reply_to is not null").groupBy("conv_id", F.col("reply_to").alias("turn")).agg(F.min("turn").alias("child"))
    nodes = scratch.table(siblings.join(first, ["conv_id", "turn"], "left"), "tree")
    way = lambda turn, down: F.struct(F.col(turn).alias("turn"), F.lit(down).alias("down"))
    downs = nodes.select("conv_id", way("turn", 1).alias("way"), F.when(F.col("child").isNotNull(), way("child", 1)).otherwise(way("turn", 0)).alias("next"), F.lit(1).cast("long").alias("left"), F.lit(1).cast("long").alias("climb"))
    ups = nodes.select("conv_id", way("turn", 0).alias("way"), F.when(F.col("after").isNotNull(), way("after", 1)).when(F.col("reply_to").isNotNull(), way("reply_to", 0)).alias("next"), F.lit(0).cast("long").alias("left"), F.lit(-1).cast("long").alias("climb"))
    tour = downs.unionByName(ups)
    k = 0
    while True:
        tour = scratch.table(tour, f"tour-{k}")
        if k:
            scratch.drop(f"tour-{k - 1}")
        else:
            scratch.drop("tree")
        if tour.where("next is not null").isEmpty():
            break
        on = tour.select("conv_id", F.col("way").alias("next"), F.col("next").alias("further"), F.col("left").alias("more"), F.col("climb").alias("climbs"))
        add = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
        tour = tour.join(on, ["conv_id", "next"], "left").select("conv_id", "way", F.col("further").alias("next"), add("left", "more"), add("climb", "climbs"))
        k += 1
    sizes = tree.groupBy("conv_id").agg(F.count("*").alias("size"))
    placed = tour.where("way.down = 1").join(sizes, "conv_id").select("conv_id", F.col("way.turn").alias("turn"), (F.col("size") - F.col("left")).alias("place"), (-F.col("climb")).alias("reply_depth"))
    return plain.unionByName(rows.join(placed, ["conv_id", "turn"]).select(*plain.columns))


def conversations(messages: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, text (without quotes), reply_to, reply_depth, depth, n_quotes, n_linked."""
    scratch = Scratch(messages.sparkSession, "chat")
    rows = parsed(messages)
    one = rows.groupBy("conv_id", "turn").agg(F.max_by(F.struct("role", "body", "depth", "parts"), F.struct("role", "body", "depth")).alias("m")).select("conv_id", "turn", "m.*")
    rows = scratch.table(linked(scratch.table(one, "messages"), scratch), "linked")
    scratch.drop("messages", "whole", "left", "held", "written", "shares")
    out = reply_order(rows, scratch)
    return out.select("conv_id", "place", "turn", "role", F.col("body").alias("text"), "reply_to", "reply_depth", "depth", "n_quotes", "n_linked")


def op9_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations without quotes, in reply order."""
    return conversations(read(spark, sf_dir, "conversations"))


def oracle() -> str:
    """The same conversations in DuckDB's SQL: lines to passages, passages and sentences by their words, a walk of the replies."""
    return r"""
    WITH RECURSIVE one AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
    lines AS (SELECT conv_id, turn, role, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM one),
    marked AS (SELECT *, regexp_extract(line, '^[ \t]*(?:>[ \t]?)+') AS mark FROM lines),
    bare AS (SELECT conv_id, turn, role, text, i, length(mark) - length(replace(mark, '>', '')) AS level, regexp_replace(line[length(mark) + 1 :], '\r+$', '') AS body FROM marked),
    kept AS (SELECT *, regexp_matches(body, '^\s*$') AS blank, lead(level) OVER w > level AND regexp_matches(body, '\b(?:wrote|schrieb|a écrit|escribió):[ \t\r]*$') AS intro,
      CASE WHEN lag(level) OVER w IS DISTINCT FROM level OR lag(regexp_matches(body, '^\s*$')) OVER w THEN 1 ELSE 0 END AS fresh FROM bare WINDOW w AS (PARTITION BY conv_id, turn, role, text ORDER BY i)),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, role, text ORDER BY i) AS p FROM kept),
    passages AS (SELECT conv_id, turn, role, text, p, min(level) AS level, string_agg(body, chr(10) ORDER BY i) AS body FROM numbered WHERE NOT blank AND NOT coalesce(intro, false) GROUP BY ALL),
    message AS (SELECT conv_id, turn, role, text, max(level) AS depth, string_agg(body, chr(10) || chr(10) ORDER BY p) FILTER (level = 0) AS own FROM passages GROUP BY conv_id, turn, role, text),
    bodies AS (SELECT o.conv_id, o.turn, o.role, CASE WHEN regexp_matches(o.text, '(?m)^[ \t]*>') THEN coalesce(m.own, '') ELSE o.text END AS body, coalesce(depth, 0) AS depth, o.text
      FROM one o LEFT JOIN message m ON o.conv_id = m.conv_id AND o.turn = m.turn AND o.role IS NOT DISTINCT FROM m.role AND o.text = m.text),
    said AS (SELECT * FROM bodies QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role DESC NULLS LAST, body DESC, depth DESC, text DESC) = 1),
    own AS (SELECT p.* FROM passages p JOIN said s ON p.conv_id = s.conv_id AND p.turn = s.turn AND p.text = s.text AND p.role IS NOT DISTINCT FROM s.role),
    cut AS (SELECT conv_id, turn, p, level, body, unnest(list_concat([body], string_split(regexp_replace(body, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)))) AS part FROM own),
    keyed AS (SELECT conv_id, turn, p, level, regexp_extract_all(lower(body), '[\p{L}\p{N}]+') AS whole, regexp_extract_all(lower(part), '[\p{L}\p{N}]+') AS w FROM cut),
    keys AS (SELECT DISTINCT conv_id, turn, p, level, len(whole) AS whole, array_to_string(w, ' ') AS key, len(w) AS n FROM keyed WHERE len(w) > 0),
    meets AS (SELECT DISTINCT q.conv_id, q.turn, q.p, q.level, q.whole, q.key, q.n, s.turn AS source FROM keys q JOIN keys s ON q.conv_id = s.conv_id AND q.key = s.key AND s.level = 0 AND s.turn < q.turn WHERE q.level > 0),
    shares AS (SELECT conv_id, turn, p, level, whole, source, sum(n) + CASE WHEN max(n) = max(whole) THEN 1000000000 ELSE 0 END AS n FROM (SELECT *, max(n) OVER (PARTITION BY conv_id, turn, p, source) AS top FROM meets) WHERE top < whole OR n = whole GROUP BY ALL),
    best AS (SELECT * FROM shares QUALIFY row_number() OVER (PARTITION BY conv_id, turn, p ORDER BY n DESC, source DESC) = 1),
    linked AS (SELECT conv_id, turn, count(*) AS n_linked, arg_min(source, level * 1000000000000 - source) AS quoted FROM best WHERE 2 * n >= whole GROUP BY ALL),
    quotes AS (SELECT conv_id, turn, count(DISTINCT p) AS n_quotes FROM keys WHERE level > 0 GROUP BY ALL),
    replies AS (SELECT s.*, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, coalesce(quoted, lag(s.turn) OVER (PARTITION BY s.conv_id ORDER BY s.turn)) AS reply_to
      FROM said s LEFT JOIN linked USING (conv_id, turn) LEFT JOIN quotes USING (conv_id, turn)),
    walk(conv_id, turn, path) AS (SELECT conv_id, turn, [turn] FROM replies WHERE reply_to IS NULL UNION ALL SELECT r.conv_id, r.turn, list_append(w.path, r.turn) FROM replies r JOIN walk w ON r.conv_id = w.conv_id AND r.reply_to = w.turn)
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY path) - 1 AS BIGINT) AS place, turn, role, body AS text, reply_to, CAST(len(path) - 1 AS BIGINT) AS reply_depth, CAST(depth AS INTEGER) AS depth,
      CAST(n_quotes AS BIGINT) AS n_quotes, CAST(n_linked AS BIGINT) AS n_linked FROM replies JOIN walk USING (conv_id, turn)"""
