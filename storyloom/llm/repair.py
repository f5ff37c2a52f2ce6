"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation's rows are items of a DAG whose nodes are (rows read, state); the
states follow the role initials ``(s?(ua)+)?``.  Arcs are the edits: Keep, Rerole,
Delete and Insert, each with a cost.  Minimum costs from the beginning (forward)
and to the end (backward) tell which arcs are tight, that is on any cheapest way;
then the frontier, the nodes that are reached by the letters so far, moves along
the tight arcs of the least letter.  The result is the ASCII-least of all
cheapest edit strings.

Rows are sorted by conversation and turn into ranges, however many rows one
conversation has.  What lies inside a range is repaired there.  A conversation
that is cut by a range's end, or is longer than a chunk, is made of chunks, each
with a 4 x 4 matrix of least costs; the costs before and behind each chunk come
from running min-plus products over the matrices, chunks find their edits from
any state that a cheapest way enters them with, and a last pass in order picks
these, hashing the text as it comes.

Null roles and texts count as one space.  Null turns come first, null
conversations are one of their own.  Rows of one turn stand in order of role,
then of text.  Rows that repeat are one item with a number.  Other columns
aren't looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read, sliced

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: States: nothing yet, after the system's message, after the user's, after the assistant's.
STATES = range(4)
#: Where the next user's or assistant's message leads.
NEXT = (2, 2, 3, 2)
INF = 1 << 60
BEGIN, END = [0, INF, INF, INF], [0, 2 * INSERT, INSERT, 0]
BLANKS = " \t\n\x0b\x0c\r"
LONGEST = (1 << 63) - 1

#: Rows and characters of a chunk, about.
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20


class Item:
    """``n`` equal rows: the first has ``fault`` (b, d, t or none), and unless it is blank the others are duplicates."""

    __slots__ = ("role", "text", "n", "fault")

    def __init__(self, role: str, text: str, n: int, seen: bool):
        self.role, self.text, self.n = role, text, n
        body = text.rstrip(BLANKS)
        self.fault = "b" if not body else "d" if seen else "" if body[-1] in ".!?" else "t"

    @property
    def forced(self) -> int:
        """How many of the rows must go."""
        return self.n if self.fault in ("b", "d") else self.n - 1


def arcs(item: Item, state: int) -> Iterator[tuple[str, int, int]]:
    """letter, cost and next state of the edits of an item's first row; rows that must go leave the state as it is."""
    if item.fault in ("b", "d"):
        yield "D", 0, state
        return
    cut = CUT if item.fault == "t" else 0
    yield "D", DELETE, state
    first = item.role[:1]
    if first == "s" and state == 0:
        yield "K", KEEP + cut, 1
    if first == "uuau"[state]:
        yield "K", KEEP + cut, NEXT[state]
    yield "R", REROLE + cut, NEXT[state]


def inserted(costs: list[int], backward: bool) -> list[int]:
    """The costs when messages may be inserted: two at most, more would come back to a state."""
    for _ in range(2):
        if backward:
            costs = [min(costs[s], INSERT + costs[NEXT[s]]) for s in STATES]
        else:
            costs = [min([costs[s], *(INSERT + costs[r] for r in STATES if NEXT[r] == s)]) for s in STATES]
    return costs


def forward(items: list[Item], before: list[int]) -> list[list[int]]:
    """Least costs to each state, before each item and after the last, inserts counted but at the end."""
    out = [before]
    for item in items:
        costs, onward = inserted(out[-1], False), [INF] * 4
        for s in STATES:
            for _, w, t in arcs(item, s):
                onward[t] = min(onward[t], costs[s] + w + DELETE * item.forced)
        out.append(onward)
    return out


def backward(items: list[Item], behind: list[int]) -> list[list[int]]:
    """Least costs from each state, before each item and after the last, to the end."""
    out = [behind]
    for item in reversed(items):
        out.append(inserted([min(w + out[-1][t] for _, w, t in arcs(item, s)) + DELETE * item.forced for s in STATES], True))
    return out[::-1]


class Walk:
    """The letters and lines of the cheapest edits of a run of items, and the states that they end in."""

    def __init__(self, items: list[Item], before: list[int], behind: list[int], frontier: set[int], last: bool):
        self.letters: list[str] = []
        self.lines: list[str] = []
        there, back = forward(items, before), backward(items, behind)
        for k, item in enumerate(items):
            frontier = self.inserts(there[k], back[k], frontier, item, back[k + 1])
        self.frontier = self.inserts(there[-1], back[-1], frontier, None, None) if last else frontier

    def inserts(self, there: list[int], back: list[int], frontier: set[int], item: Item | None, onward: list[int] | None) -> set[int]:
        """Moves the frontier past one item, or to the end, by the least letters of tight arcs.

        All nodes of a frontier have the same cost so far, so an arc from one is tight if it keeps the least sum.
        """
        costs = inserted(there, False)
        total = min(costs[s] + back[s] for s in STATES)
        while True:
            tight: dict[str, set[int]] = {}
            for s in frontier:
                if item is not None:
                    for letter, w, t in arcs(item, s):
                        if costs[s] + w + DELETE * item.forced + onward[t] == total:
                            tight.setdefault(letter, set()).add(t)
                elif not back[s]:
                    return frontier
                if costs[s] + INSERT + back[NEXT[s]] == total:
                    tight.setdefault("I", set()).add(NEXT[s])
            letter = min(tight)
            frontier = tight[letter]
            if letter == "I":
                self.letters.append("I")
                self.lines.append(self.writer(frontier) + ":")
                continue
            if item.fault in ("b", "d"):
                self.letters.append("D" * item.n)
            else:
                self.letters.append(letter + "D" * (item.n - 1))
                if letter != "D":
                    self.lines.append(f"{item.role if letter == 'K' else self.writer(frontier)}:{item.text}")
            return frontier

    @staticmethod
    def writer(frontier: set[int]) -> str:
        """Who writes next: letters tell the state, so a frontier has one."""
        return "user" if 2 in frontier else "assistant"


def figures(items: list[Item]) -> dict[str, int]:
    """Rows by first fault, and neighbours whose role initials are out of order."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    before = None
    for item in items:
        out["blank"] += item.n if item.fault == "b" else 0
        out["duplicate"] += item.n if item.fault == "d" else item.n - 1 if item.fault != "b" else 0
        out["truncated"] += item.fault == "t"
        out["illegal"] += item.n - 1 + (before is not None and broken(before, item.role))
        before = item.role
    return out


def broken(a: str, b: str) -> bool:
    return a[:1] + b[:1] not in ("su", "ua", "au")


def repaired(items: list[Item]) -> dict:
    """A whole conversation's figures, least cost, edits and the hash of what they make of it."""
    walk = Walk(items, BEGIN, END, {0}, True)
    return figures(items) | {"cost": backward(items, END)[0][0], "audit": "".join(walk.letters), "repaired_sha256": hashlib.sha256("\n".join(walk.lines).encode()).hexdigest()}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (0: dropped), by the crc32 of the row's name."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"))
    rows = rows.withColumn("fate", F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20)
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("copies"))


def gaps(rows: DataFrame) -> DataFrame:
    """conv_id, gaps of every conversation, with rows left or not."""
    kept = F.when(F.col("n") > 0, F.col("turn"))
    wide = lambda c: c.cast("decimal(38,0)")
    turns = rows.groupBy("conv_id", "turn").agg(F.sum("copies").alias("n"))
    missing = F.least(wide(F.max(kept)) - wide(F.min(kept)) + 1 - F.count(kept), wide(F.lit(LONGEST))).cast("long")
    return turns.groupBy("conv_id").agg(F.when(F.count(kept) > 0, missing).otherwise(0).cast("long").alias("gaps"))


NAME = ["conv_id", "turn", "role", "text"]


def items_of(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n, seen: equal rows as one, and whether an earlier turn has the same role and text."""
    own = rows.where("copies > 0").groupBy(*NAME).agg(F.sum("copies").alias("n"))
    # the first turns meet their rows in one more grouping, so that no join has a hot key
    first = own.groupBy("conv_id", "role", "text").agg(F.min(F.struct("turn"))["turn"].alias("turn"))
    both = own.withColumn("first", F.lit(0)).unionByName(first.withColumns({"n": F.lit(0).cast("long"), "first": F.lit(1)}))
    return both.groupBy(*NAME).agg(F.sum("n").alias("n"), (F.max("first") == 0).alias("seen"))


RESULT = {"blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string()}
RESULT_SQL = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECE = pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64()), ("seen", pa.bool_())])


def in_ranges(items: DataFrame, rows: int, chars: int) -> DataFrame:
    """A row for each conversation inside a range (``whole``, with its result), and for each chunk of others.

    Chunks are named by range and number, and have the least costs from state to state.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("range", pa.int32()), ("chunk", pa.int32()), ("whole", pa.bool_()), *RESULT.items(), ("items", pa.list_(PIECE)), ("matrix", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string())])

    def run(batches):
        from pyspark import TaskContext

        here, made = TaskContext.get().partitionId(), []

        def flush():
            out = pa.RecordBatch.from_pylist(made, schema=schema)
            made.clear()
            return out

        def chunk(conv_id, number, items, whole):
            row = {"conv_id": conv_id, "range": here, "chunk": number, "whole": whole}
            if whole:
                return row | repaired(items)
            matrix = [x for s in STATES for x in forward(items, [0 if s == t else INF for t in STATES])[-1]]
            pieces = [{"role": i.role, "text": i.text, "n": i.n, "seen": i.fault == "d"} for i in items]
            return row | figures(items) | {"items": pieces, "matrix": matrix, "first": items[0].role, "last": items[-1].role}

        conv_id, items, size, number, first = None, [], 0, 0, True
        for batch in sliced(batches):
            for c, role, text, n, seen in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text", "n", "seen"))):
                if items and c != conv_id:
                    made.append(chunk(conv_id, number, items, not first and not number))
                    items, size, number, first = [], 0, 0, False
                elif len(items) >= rows or size >= chars:
                    made.append(chunk(conv_id, number, items, False))
                    items, size, number = [], 0, number + 1
                conv_id = c
                items.append(Item(role, text, n, seen))
                size += len(text)
            if made:
                yield flush()
        if items:
            made.append(chunk(conv_id, number, items, False))
            yield flush()

    order = [F.col(c).asc_nulls_first() for c in NAME]
    ordered = items.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = f"conv_id long, range int, chunk int, whole boolean, {RESULT_SQL.partition(', ')[2]}, items array<struct<role:string,text:string,n:long,seen:boolean>>, matrix array<long>, first string, last string"
    return ordered.mapInArrow(run, kinds)


def carried(rows: DataFrame, descending: bool, schema: pa.Schema, kinds: str, begin: Callable, step: Callable, end: Callable | None = None) -> DataFrame:
    """Each conversation's rows in order of chunks (or backwards), with what ``step(state, row)`` makes of them.

    ``begin()`` gives a conversation's first state and ``end(state)`` a row behind its last; a state is all that is kept.
    """

    def run(batches):
        name, state, some = None, None, False
        for batch in sliced(batches):
            made = []
            for row in batch.to_pylist():
                if not some or row["conv_id"] != name:
                    made += [end(name, state)] if end and some else []
                    name, state, some = row["conv_id"], begin(), True
                state, out = step(state, row)
                made += [out] if out is not None else []
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=schema)
        if end and some:
            yield pa.RecordBatch.from_pylist([end(name, state)], schema=schema)

    order = [F.col(c).desc() if descending else F.col(c).asc() for c in ("range", "chunk")]
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, kinds)


PLACE = [("conv_id", pa.int64()), ("range", pa.int32()), ("chunk", pa.int32())]
MOVE = pa.struct([("state", pa.int32()), ("to", pa.int32()), ("letters", pa.string()), ("body", pa.string())])


def of_chunks(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """The results of conversations that are made of chunks."""
    place = ["conv_id", "range", "chunk"]

    def backwards(behind, row):
        m = row["matrix"]
        before = inserted([min(m[4 * s + t] + behind[t] for t in STATES) for s in STATES], True)
        return before, {c: row[c] for c in place} | {"matrix": m, "behind": behind}

    def forwards(before, row):
        m = row["matrix"]
        return [min(INF, *(before[s] + m[4 * s + t] for s in STATES)) for t in STATES], {c: row[c] for c in place} | {"before": before, "behind": row["behind"]}

    costs = pa.list_(pa.int64())
    back = carried(chunks.select(*place, "matrix"), True, pa.schema([*PLACE, ("matrix", costs), ("behind", costs)]), "conv_id long, range int, chunk int, matrix array<long>, behind array<long>", lambda: END, backwards)
    both = carried(scratch.table(back, "back"), False, pa.schema([*PLACE, ("before", costs), ("behind", costs)]), "conv_id long, range int, chunk int, before array<long>, behind array<long>", lambda: BEGIN, forwards)
    both = scratch.table(both, "both")
    numbers = ["blank", "duplicate", "truncated", "illegal"]
    kinds = "conv_id long, range int, chunk int, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, moves array<struct<state:int,to:int,letters:string,body:string>>"
    schema = pa.schema([*PLACE, *((c, pa.int64()) for c in numbers), ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("moves", pa.list_(MOVE))])

    def edits(batches):
        for batch in sliced(batches, 1):  # a chunk at a time
            for row in batch.to_pylist():
                items = [Item(i["role"], i["text"], i["n"], i["seen"]) for i in row["items"]]
                before, back = row["before"], backward(items, row["behind"])[0]
                total, moves = min(a + b for a, b in zip(before, back)), []
                for s in STATES:
                    if before[s] + back[s] == total:  # on a cheapest way
                        walk = Walk(items, [before[s] if t == s else INF for t in STATES], row["behind"], {s}, False)
                        moves.append({"state": s, "to": min(walk.frontier), "letters": "".join(walk.letters), "body": "\n".join(walk.lines) if walk.lines else None})
                yield pa.RecordBatch.from_pylist([{c: row[c] for c in (*place, *numbers, "first", "last")} | {"cost": total, "moves": moves}], schema=schema)

    same = F.col("c.conv_id").eqNullSafe(F.col("v.conv_id")) & (F.col("c.range") == F.col("v.range")) & (F.col("c.chunk") == F.col("v.chunk"))
    joined = chunks.alias("c").join(both.alias("v"), same).select("c.*", "before", "behind").select(*place, *numbers, "items", "first", "last", "before", "behind")
    moves = scratch.table(joined.mapInArrow(edits, kinds), "moves")

    def pick(state, row):
        move = next(m for m in row["moves"] if m["state"] == state["at"])
        state["at"], state["cost"] = move["to"], row["cost"]
        state["audit"].append(move["letters"])
        add(state, move["body"])
        for c in numbers:
            state[c] += row[c]
        state["illegal"] += state["last"] is not None and broken(state["last"], row["first"])
        state["last"] = row["last"]
        return state, None

    def add(state, body):
        if body is not None:
            state["hash"].update((b"\n" if state["some"] else b"") + body.encode())
            state["some"] = True

    def closed(conv_id, state):
        last = Walk([], [0 if s == state["at"] else INF for s in STATES], END, {state["at"]}, True)
        add(state, "\n".join(last.lines) if last.lines else None)
        return {"conv_id": conv_id, "cost": state["cost"], "audit": "".join([*state["audit"], *last.letters]), "repaired_sha256": state["hash"].hexdigest()} | {c: state[c] for c in numbers}

    begin = lambda: {"at": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "some": False, "last": None} | dict.fromkeys(numbers, 0)
    return carried(moves, False, pa.schema([("conv_id", pa.int64()), *RESULT.items()]), RESULT_SQL, begin, pick, closed)


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of ``rows`` (conv_id, turn, role, text, copies).

    Conversations whose rows have no copies, that is none left, have zeros and nothing repaired.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    ranges = scratch.table(in_ranges(scratch.table(items_of(rows), "items"), chunk_rows, chunk_chars), "ranges")
    scratch.drop("items")
    columns = ["conv_id", *RESULT]
    found = ranges.where("whole").select(*columns).unionByName(of_chunks(ranges.where("not whole"), scratch).select(*columns))
    every = gaps(rows)
    either = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long") if RESULT[c] == pa.int64() else F.lit("" if c == "audit" else hashlib.sha256().hexdigest())).alias(c)
    return every.join(found.withColumnRenamed("conv_id", "found_id"), F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select("conv_id", "gaps", *(either(c) for c in RESULT))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by its rows' names and repaired."""
    return repair(damaged(read(spark, sf_dir, "conversations")))


def oracle() -> str:
    """The same in DuckDB's SQL: for each state the least (cost, edits) so far, row after row."""
    edit = lambda v, w, letter: f"CASE WHEN {v} IS NOT NULL THEN {{'c': {v}.c + {w}, 'a': {v}.a || '{letter}'}} END"
    least = lambda *each: f"list_min(list_filter([{', '.join(each)}], lambda z: z IS NOT NULL))"
    ins = lambda v: edit(v, INSERT, "I")
    kept = lambda v, first: f"CASE WHEN initial = '{first}' AND fault NOT IN ('b', 'd') THEN {edit(v, 'cut', 'K')} END"
    named = lambda v: f"CASE WHEN fault NOT IN ('b', 'd') THEN {edit(v, f'cut + {REROLE}', 'R')} END"
    gone = lambda v: edit(v, DELETE, "D")
    return f"""
    WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    fated AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 20 AS fate FROM keyed, tab),
    hurt AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fated WHERE fate <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed),
    d AS (SELECT *, role[1] AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN seen THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault FROM ranked),
    rows AS (SELECT *, CASE WHEN fault = 't' THEN {CUT} ELSE 0 END AS cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM d),
    walk AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS p0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)) AS p1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)) AS p2, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)) AS p3 FROM (SELECT DISTINCT conv_id FROM rows)
      UNION ALL
      SELECT conv_id, i, {gone('p0')} AS p0, {least(gone('p1'), kept('p0', 's'))} AS p1,
        {least(gone('x2'), *(f(v) for v in ('p0', 'p1', 'x3') for f in (lambda v: kept(v, 'u'), named)))} AS p2, {least(gone('x3'), kept('x2', 'a'), named('x2'))} AS p3
      FROM (SELECT *, {least('p3', ins('x2'))} AS x3 FROM (SELECT w.conv_id, r.i, p0, p1, p3, {least('p2', ins('p0'), ins('p1'), ins('p3'))} AS x2, r.initial, r.fault, r.cut FROM walk w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1))),
    last AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
    best AS (SELECT conv_id, {least('p0', 'p3', ins('x2'))} AS v FROM (SELECT *, {least('p2', ins('p0'), ins('p1'), ins('p3'))} AS x2 FROM last)),
    letters AS (SELECT conv_id, unnest(string_split(v.a, '')) AS letter, generate_subscripts(string_split(v.a, ''), 1) AS k FROM best WHERE v.a <> ''),
    steps AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS i, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS o FROM letters),
    made AS (SELECT s.conv_id, s.k, s.letter, s.o, r.role, CASE WHEN s.letter = 'I' THEN '' ELSE r.text END AS text, max(CASE WHEN s.o = 1 AND s.letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS system
      FROM steps s LEFT JOIN rows r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.letter <> 'I' AND s.i = r.i),
    told AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS body FROM made WHERE letter <> 'D' GROUP BY conv_id),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
      count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
    SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
      CAST(coalesce(v.c, 0) AS BIGINT) AS cost, coalesce(v.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN told t ON c.conv_id IS NOT DISTINCT FROM t.conv_id"""
