"""Near-duplicates by SetSketch registers, banded, then verified on full sets.

1. Each text becomes the set of its hashed word shingles; equal sets are one
   class, stood for by its least doc_id, so copies cost nothing further.
2. Each class gets a SetSketch: per register the truncated log of the least
   exponentially spaced point of any shingle.  Sketches of parts merge by the
   larger register.  Bands of registers are buckets; the number of bands makes
   a pair at the threshold miss all of them less than once in ten million.
3. In each bucket, all classes are held against its hub (the class with most
   company).  What the joint likelihood of the two sketches can't rule out is
   verified on full sets, and components are drawn from the links.
4. Buckets that still hold several components are worked through block against
   block, only for pairs across components, so no link is lost and a bucket
   that is one component costs nothing more.

Shingles are compared by 64-bit hashes of 64-bit hashes of their words.  Very
long texts are whole sets; other columns aren't looked at, and ``keep_one``
returns them as they are.

Empty sets (no words, null texts) are linked with nothing.  Rows without an id
can't stand for a class and are left out of the result.  A repeated row is
returned again, with the class of its text; doc_id is taken as the key of
documents, so rows of one id with different texts each keep their own class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import MASK, Memo, Scratch, mix64, read, sliced, unused


@dataclass(frozen=True)
class NearDupParams:
    #: Words of a shingle.
    words: int = 5
    #: Percent of the union that the intersection has at least.
    percent: int = 80
    #: Registers of a band.
    rows: int = 6
    #: Chance that a pair at the threshold shares no band, at most.
    miss: float = 1e-7
    #: Base of the registers' logarithm.
    base: float = 1.001
    #: Pairs go on to the full sets down to so many standard errors under the threshold.
    errors: float = 6.0
    #: Classes of a block in step 4.
    block: int = 400

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def hash_word(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingles(text: str | None, memo: Memo, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles; of fewer words, of the whole."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(k, len(h))
    if not k:
        return h
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def sketch(sets: list[np.ndarray], registers: int, base: float) -> np.ndarray:
    """SetSketches of sets of hashed items: a row of uint16 registers each, larger for larger sets.

    Every item is a Poisson process whose points go to random registers, so that
    each register holds the least of independent exponentials.  Points beyond the
    set's last register to be reached change nothing, so its processes stop there.
    An empty set's registers are 0.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    item = mix64(np.concatenate([*sets, np.zeros(0, np.uint64)]) ^ np.uint64(0x5E7C3A11D00DFEED))
    least = np.full(len(sets) * registers, np.inf)
    time = np.zeros(len(item))
    drawn, points = 0, 1
    while len(item):
        k = np.arange(drawn + 1, drawn + points + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        u = mix64(item[:, None] + k)
        times = time[:, None] - np.cumsum(np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53), axis=1) / registers
        where = ((u * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) * np.uint64(registers) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(least, (owner[:, None] * registers + where).ravel(), times.ravel())
        time = times[:, -1]
        going = time < least.reshape(len(sets), registers).max(axis=1)[owner]
        item, time, owner = item[going], time[going], owner[going]
        drawn, points = drawn + points, min(2 * points, 32)
    # 32768 stands for a point at 1
    out = np.clip(np.floor(32768 - np.log(least) / math.log(base)), 0, 65535)
    return np.where(np.isinf(least), 0, out).astype(np.uint16).reshape(len(sets), registers)


def joint_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, base: float) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs from their registers (rows) and set sizes.

    The chance of the larger, equal and smaller register follows from the sizes and
    the similarity; the likelihood of the three counts is highest where it is solved by bisection.
    """
    m = a.shape[1]
    more = (a > b).sum(axis=1) / m
    less = (a < b).sum(axis=1) / m
    u, v = na / (na + nb), nb / (na + nb)
    log_b = math.log(base)

    def p(x):
        return -np.log(1 - np.clip(x, 0, 1) * (base - 1) / base) / log_b

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(14):
        j = (low + high) / 2
        x, y = u - v * j, v - u * j
        px, py = np.maximum(p(x), 1e-12), np.maximum(p(y), 1e-12)
        same = np.maximum(1 - px - py, 1e-12)
        dx, dy = -v / np.maximum(base - x * (base - 1), 1e-9), -u / np.maximum(base - y * (base - 1), 1e-9)
        slope = more * dx / px + less * dy / py - (1 - more - less) * (dx + dy) / same
        low, high = np.where(slope > 0, j, low), np.where(slope > 0, high, j)
    return (low + high) / 2


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, params: NearDupParams) -> np.ndarray:
    """Whether each pair's similarity may reach the threshold: sizes first, then the sketches."""
    t = params.percent / 100
    out = np.minimum(na, nb) >= t * np.maximum(na, nb)
    if out.any():
        at = np.flatnonzero(out)
        slack = params.errors * math.sqrt(t * (1 - t) / params.registers)
        same = (a[at] == b[at]).mean(axis=1)
        at = at[same >= t - slack - 0.02]
        out[:] = False
        if len(at):
            out[at] = joint_similarity(a[at], b[at], na[at].astype(float), nb[at].astype(float), params.base) >= t - slack
    return out


def one_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")


def small_set(items: np.ndarray) -> bytes:
    """The set with hashes cut short: never fewer in common than the full sets have."""
    return np.unique(items.astype(np.uint16 if len(items) <= 2000 else np.uint32)).tobytes() if len(items) else b""


def common(a: bytes, na: int, b: bytes, nb: int) -> int:
    """At least the size of the intersection of two full sets, from their short forms."""
    x, y = (np.frombuffer(s, np.uint16 if n <= 2000 else np.uint32) for s, n in ((a, na), (b, nb)))
    if x.dtype != y.dtype:
        x, y = (np.unique(v.astype(np.uint16)) for v in (x, y))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both + max(na - len(x), nb - len(y), 0)


def sketched(docs: DataFrame, params: NearDupParams) -> DataFrame:
    """doc_id, n (set size), lo and hi (digest of the set; null if empty), regs."""

    def run(batches):
        memo = Memo(hash_word)
        for batch in sliced(batches):
            sets = [shingles(text, memo, params.words) for text in batch.column("text").to_pylist()]
            regs = sketch(sets, params.registers, params.base)
            digests = [xxhash.xxh3_128_intdigest(x.tobytes()) if len(x) else None for x in sets]
            half = lambda shift: pa.array([None if d is None else (d >> shift & MASK) - (1 << 63) for d in digests], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), half(0), half(64), pa.array([r.tobytes() if len(x) else None for r, x in zip(regs, sets)], pa.binary())], names=["doc_id", "n", "lo", "hi", "regs"])

    return docs.mapInArrow(run, "doc_id long, n long, lo long, hi long, regs binary")


def short_sets(texts: DataFrame, params: NearDupParams) -> DataFrame:
    """id, short: the short form of each text's set."""

    def run(batches):
        memo = Memo(hash_word)
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([small_set(shingles(t, memo, params.words)) for t in batch.column("text").to_pylist()], pa.binary())], names=["id", "short"])

    return texts.mapInArrow(run, "id long, short binary")


def likely_pairs(pairs: DataFrame, sketches: DataFrame, params: NearDupParams) -> DataFrame:
    """Pairs (a, b) that their sketches don't rule out."""
    side = lambda k: sketches.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("regs").alias(f"r{k}"))

    def run(batches):
        for batch in sliced(batches):
            if batch.num_rows:
                ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("ra", "rb"))
                ok = likely(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), params)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, params: NearDupParams) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    side = lambda k: texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"t{k}"))

    def run(batches):
        memo = Memo(hash_word)
        for batch in sliced(batches):
            ok, last, items = [], None, None
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))):
                if b != last:
                    last, items = b, shingles(tb, memo, params.words)
                other = shingles(ta, memo, params.words)
                both = len(np.intersect1d(items, other, assume_unique=True))
                ok.append(100 * both >= params.percent * (len(items) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """id and component (least id reachable) of all ids in ``links`` (a, b).

    Min-label propagation with pointer jumping; each round is written to the
    shared folder, and the number of rounds is about the log of the widest component.
    """
    edges = scratch.table(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), f"{name}-edges")
    labels = scratch.table(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), f"{name}-0")
    k = 0
    while True:
        heard = edges.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard"))
        step = labels.join(heard, "id").select("id", F.col("component").alias("was"), F.least("component", "heard").alias("up"))
        jump = labels.select(F.col("id").alias("up"), F.col("component").alias("further"))
        new = step.join(jump, "up").select("id", "was", F.least("up", "further").alias("component"))
        k += 1
        new = scratch.table(new, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        labels = new.select("id", "component")
        if new.where("was <> component").isEmpty():
            scratch.drop(f"{name}-edges")
            return labels


def across(members: DataFrame, sketches: DataFrame, texts: DataFrame, params: NearDupParams) -> DataFrame:
    """Pairs of different components within buckets that may be links: blocks against blocks.

    ``members``: bucket, band, id, component.  In each bucket the largest component
    is only held against the others, never against itself, and a pair is looked at
    in the first bucket that it shares.  The sketches rule most pairs out, the sets
    in short form nearly all the rest, so what comes out is hardly more than links.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    totals = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top")).where("parts > 1")
    rows = members.join(totals, "bucket")
    # the others ask all; blocks are by hash of id, so that no bucket is counted off or sorted
    askers = F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("top.n")) / params.block)).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("all") / params.block)).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    asks = F.col("component") != F.col("top.component")
    ask = rows.where(asks).select("bucket", "band", spot(askers).alias("left"), each(blocks).alias("right"), "id", "component", F.lit(True).alias("asks"), F.lit(True).alias("other"))
    tell = rows.select("bucket", "band", each(askers).alias("left"), spot(blocks).alias("right"), "id", "component", F.lit(False).alias("asks"), asks.alias("other"))
    concerned = rows.select("id").distinct()
    known = sketches.select(F.col("doc_id").alias("id"), "n", "regs").join(short_sets(texts.join(concerned.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), params), "id")
    both = ask.unionByName(tell).join(known, "id")

    def run(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy()
        ids, comp, n, other = (group[c].to_numpy() for c in ("id", "component", "n", "other"))
        q, t = np.flatnonzero(asks), np.flatnonzero(~asks)
        found = []
        if len(q) and len(t):
            band = group["band"][0].as_py()
            shorts = group["short"].to_pylist()
            regs = np.frombuffer(b"".join(group["regs"].to_pylist()), np.uint16).reshape(len(ids), params.bands, params.rows)
            flat = regs.reshape(len(ids), -1)
            for i in q:
                # of two that both ask, the lesser id does
                at = t[(comp[t] != comp[i]) & (~other[t] | (ids[i] < ids[t])) & (100 * np.minimum(n[t], n[i]) >= params.percent * np.maximum(n[t], n[i]))]
                if len(at):
                    at = at[likely(np.broadcast_to(flat[i], (len(at), flat.shape[1])), flat[at], np.full(len(at), n[i]), n[at], params)]
                if len(at):
                    at = at[(regs[at] == regs[i]).all(axis=2).argmax(axis=1) == band]
                for j in at:
                    both = common(shorts[i], n[i], shorts[j], n[j])
                    if 100 * both >= params.percent * (n[i] + n[j] - both):
                        found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return both.groupBy("bucket", "left", "right").applyInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """Per id: n_shingles, component_id (least id reachable by links, itself included)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    texts = one_text(docs)
    rows = sketched(texts, params)
    rows = scratch.table(rows, "rows")
    sets = rows.where("lo is not null").groupBy("lo", "hi").agg(F.min("doc_id").alias("rep"))
    sets = scratch.table(sets, "sets")
    sketches = scratch.table(rows.select("doc_id", "n", "lo", "hi", "regs").join(sets.select("lo", "hi", F.col("rep").alias("doc_id")), ["doc_id", "lo", "hi"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "n", "regs"), "sketches")
    width = 2 * params.rows
    keys = F.expr(f"transform(sequence(0, {params.bands - 1}), i -> xxhash64(i, substring(regs, i * {width} + 1, {width})))")
    banded = sketches.select("doc_id", F.posexplode(keys).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = scratch.table(banded.join(shared, "bucket").select("bucket", "band", F.col("doc_id").alias("id"), "size"), "members")
    # the text of every class that has company at all, moved once
    company = members.groupBy("id").agg(F.sum("size").alias("company"))
    company = scratch.table(company, "company")
    near = scratch.table(texts.join(company.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "near")

    weighed = members.join(company, "id")
    hubs = weighed.groupBy("bucket").agg(F.max(F.struct("company", "id")).alias("hub")).select("bucket", F.col("hub.id").alias("hub"))
    stars = members.join(hubs, "bucket").where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = scratch.table(verified(likely_pairs(stars, sketches, params), near, params), "links-1")
    first = components(links, scratch, "first")
    labelled = members.join(first, "id", "left").select("bucket", "band", "id", F.coalesce("component", "id").alias("component"))
    more = scratch.table(across(labelled, sketches, near, params), "pairs-2")
    found = scratch.table(verified(more, near, params), "links-2")
    final = components(links.unionByName(found), scratch, "last")

    of_set = sets.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left").select("lo", "hi", F.coalesce("component", "rep").alias("component_id"))
    scratch.drop("members", "company", "near", "links-1", "links-2", "pairs-2", "sketches")
    # empty sets don't take part, however many there are; copies of one set are what AQE splits a skewed join for
    each = rows.where("lo is not null").select("doc_id", "n", "lo", "hi").join(of_set, ["lo", "hi"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return each.unionByName(rows.where("lo is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, 85 percent."""
    out = classes(read(spark, sf_dir, "documents"), NearDupParams(words=3, percent=85))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def oracle(words: int = 3, percent: int = 85) -> str:
    """The same rows in DuckDB's SQL: all pairs with a shingle in common, and all that is reachable by links."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH RECURSIVE cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
    items AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - {words - 1}, least(len(w), 1)) + 1), lambda i: array_to_string(w[i : i + {words - 1}], ' '))) AS s FROM cut),
    sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM items),
    each AS (SELECT DISTINCT doc_id, len(s) AS n, unnest(s) AS shingle FROM items),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n + y.n AS n, count(*) AS c FROM each x JOIN each y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
      AND 100 * x.n >= {percent} * y.n AND 100 * y.n >= {percent} * x.n GROUP BY ALL),
    one_way AS (SELECT a, b FROM pairs WHERE 100 * c >= {percent} * (n - c)),
    links AS (SELECT a, b FROM one_way UNION ALL SELECT b, a FROM one_way),
    reach(doc_id, far) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT reach.doc_id, b FROM reach JOIN links ON far = a),
    least_id AS (SELECT doc_id, min(far) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least_id USING (doc_id)"""


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates the least id stays; rows without an id stay.

    doc_id is the key: repeated rows of an id that stays all stay, and an id of which any row goes goes whole.
    """
    gone = unused("gone", docs.columns)
    found = classes(docs).where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(found, docs["doc_id"].cast("long") == F.col(gone), "left_anti")
