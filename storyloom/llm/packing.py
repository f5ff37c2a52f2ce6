"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised and only those longer than a sequence are cut.  The plan
is made from the number of pieces of each length, of which there are at most as
many as a sequence has tokens: fill a bin greedily, the longest piece that fits
first, then replace its smallest piece by two unpacked ones that fit the widened
gap more tightly, and use that filling as often as bin after bin would get it.  Pieces of
one length are then numbered, in groups of about the root of their count so
that a very frequent length is spread out, and number and length give the place.

Null and empty texts are one piece with the end id alone.  Repeated rows and
null ids are packed like any others.  Very long texts are tokenised whole and cut
into full pieces and a rest.  Other columns aren't looked at.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read, sliced
from storyloom.llm.tokens import CACHE, encoded


@dataclass(frozen=True)
class PackingParams:
    tokenizer: str = "word_bpe_49k.json"
    end: int = 1
    capacity: int = 4096
    #: Words that a worker keeps the ids of.
    cache: int = CACHE


@dataclass
class Plan:
    """For each length the runs (first number, pieces, pieces a bin, first bin, offset)."""

    runs: dict[int, np.ndarray]
    bins: int


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) of each filling; ``counts[n]`` pieces have length n."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    fillings: list[tuple[int, dict[int, int]]] = []
    top = capacity
    down = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))
    dirty = False
    while True:
        if dirty:
            down = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))
        top = int(down[capacity])
        if not top:
            return fillings
        used: dict[int, int] = {}
        most: dict[int, int] = {}  # that the filling had of a length at any time

        def take(n: int, copies: int) -> None:
            used[n] = used.get(n, 0) + copies
            most[n] = max(most.get(n, 0), used[n])

        def largest(room: int) -> int:
            n = int(down[room]) if room > 0 else 0
            while n and used.get(n, 0) >= left[n]:
                n = int(down[n - 1])
            return n

        gap = capacity
        while gap and (n := largest(gap)):
            copies = int(min(gap // n, left[n] - used.get(n, 0)))
            take(n, copies)
            gap -= n * copies
        while gap and sum(used.values()) > 1:
            small = min(used)
            pair = tightest_pair(left, used, small, gap + small)
            if pair is None or sum(pair) <= small:
                break
            used[small] -= 1
            if not used[small]:
                del used[small]
            for n in pair:
                take(n, 1)
            gap += small - sum(pair)
        # as often as the same pieces would be taken and put back again
        times = int(min((left[n] - most[n]) // c for n, c in used.items())) + 1
        for n, c in used.items():
            left[n] -= times * c
        dirty = any(not left[n] for n in used)
        fillings.append((times, used))


def tightest_pair(left: np.ndarray, used: dict[int, int], small: int, room: int) -> tuple[int, int] | None:
    """Two unpacked pieces with the largest sum up to ``room``."""
    free = left[: room + 1].copy()
    for n, c in used.items():
        if n <= room:
            free[n] -= c
    here = np.flatnonzero(free > 0)
    here = here[here > 0]
    if not len(here):
        return None
    at = np.searchsorted(here, room - here, side="right") - 1
    ok = at >= 0
    first, second = here[ok], here[at[ok]]
    lone = (first == second) & (free[first] < 2)
    if lone.any():  # the next shorter one instead
        lower = at[ok] - 1
        second = np.where(lone, np.where(lower >= 0, here[np.maximum(lower, 0)], -capacity_of(left)), second)
    sums = first + second
    if not len(sums) or sums.max() <= 0:
        return None
    k = int(sums.argmax())
    return int(first[k]), int(second[k])


def capacity_of(left: np.ndarray) -> int:
    return 2 * len(left)


def plan(counts: np.ndarray, capacity: int) -> Plan:
    runs: dict[int, list] = {}
    numbered = np.zeros(capacity + 1, dtype=np.int64)
    bins = 0
    for times, filling in best_two_fit(counts, capacity):
        at = 0
        for n in sorted(filling, reverse=True):
            c = filling[n]
            runs.setdefault(n, []).append((numbered[n], times * c, c, bins, at))
            numbered[n] += times * c
            at += n * c
        bins += times
    return Plan({n: np.array(r, dtype=np.int64) for n, r in runs.items()}, bins)


def pieces(docs: DataFrame, params: PackingParams) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces."""
    width = 4 * params.capacity

    def run(batches):
        for batch in sliced(batches, keeps=True):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text").to_pylist(), params.tokenizer, params.end, params.cache)):
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for name, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.table(pieces(docs, params), "pieces")
    counts = np.zeros(params.capacity + 1, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():  # one row for each length
        counts[row["length"]] = row["count"]
    shared = spark.sparkContext.broadcast(plan(counts, params.capacity).runs)

    parts = [(n, math.isqrt(int(c)) + 1) for n, c in enumerate(counts.tolist()) if c]
    groups = F.broadcast(spark.createDataFrame(parts, "length long, groups int"))
    key = cut.join(groups, "length").withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("groups")).cast("int"))
    sizes = key.groupBy("length", "group").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("length", "group", F.coalesce(before, F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32"))
    rows = key.withColumn("number", number).join(bases, ["length", "group"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("number") - 1).alias("number"))

    def place(batches):
        runs = shared.value
        for batch in sliced(batches, 10_000, keeps=True):
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            bins, at = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                here = np.flatnonzero(length == n)
                run = runs[int(n)][np.searchsorted(runs[int(n)][:, 0], number[here], side="right") - 1]
                k = number[here] - run[:, 0]
                bins[here] = run[:, 3] + k // run[:, 2]
                at[here] = run[:, 4] + n * (k % run[:, 2])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(bins), pa.array(at)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 4096 tokens."""
    return pack(read(spark, sf_dir, "documents"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all that is left, packed; workers that did other stages before keep fewer words."""
    return pack(docs, PackingParams(cache=CACHE // 4))
