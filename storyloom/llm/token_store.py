"""Token ids in blocks of a static range asymmetric numeral system (rANS).

One frequency table, made from all documents, is shared by all blocks.  A block
holds whole documents, in ascending doc_id order, and is decodable alone:

    "SRNS" | version u16 | lanes u16 | documents u32 | tokens u64 | table crc32 u32
    | tokens of a segment u32 | segments u32
    | per document: tokens u32
    | per segment: crc32 of its ids u32, its first word u32, lane states lanes * u64
    | words u32 ...                                          (all little-endian)

Token i of a segment belongs to lane i mod lanes.  The lane states at the start
of each segment are its checkpoint: a reader may begin at any of them, so that
segments are decoded in parallel, and each is checked against its crc32.  Blocks
are rows of a Parquet table in the shared folder (shard, block, at, tokens,
doc_ids, body), which gives them an atomic commit on any store; the table of
frequencies lies beside them.

Null and empty texts are the end id alone.  Rows without an id come first.
Repeated rows are stored again.  Rows of one id stand by how their ids begin, and
are dealt to several shards if they are very many.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read, sliced
from storyloom.llm.tokens import encoded

HEAD = struct.Struct("<4sHHIQIII")
MAGIC = b"SRNS"
#: log2 of the slots that the frequencies sum to; more than any vocabulary here has ids.
SLOTS = 20
LOW = np.uint64(1 << 31)
#: Bytes of a text's ids by which rows of one id are dealt.
HEAD_BYTES = 64


@dataclass(frozen=True)
class StoreParams:
    tokenizer: str = "byte_bpe_50k.json"
    end: int = 2
    #: Tokens of a segment, and of a block at least before it is closed.
    segment: int = 1 << 18
    block: int = 1 << 19
    #: Tokens of a shard, about.
    shard: int = 1 << 24
    lanes: int = 2048


@dataclass
class Table:
    freq: np.ndarray
    start: np.ndarray
    symbol: np.ndarray
    crc: int

    @classmethod
    def of(cls, freq: np.ndarray) -> Table:
        start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        return cls(freq.astype(np.uint64), start, symbol, zlib.crc32(freq.astype("<u4").tobytes()))


def normalised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SLOTS, at least 1 for every id that occurs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), dtype=np.uint32)
    freq = np.where(counts > 0, np.maximum(counts * float(1 << SLOTS) / total, 1), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << SLOTS)
    for k in np.argsort(-freq, kind="stable"):  # the largest bear what rounding left
        if not over:
            break
        step = min(over, int(freq[k]) // 2) if over > 0 else over
        freq[k] -= step
        over -= step
    return freq.astype(np.uint32)


def encode_segment(ids: np.ndarray, lanes: int, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Lane states that a reader starts with, and the words that it takes in turn."""
    state = np.full(lanes, LOW, dtype=np.uint64)
    words = []
    for at in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
        part = ids[at : at + lanes]
        f, c, x = table.freq[part], table.start[part], state[: len(part)]
        full = x >= f << np.uint64(63 - SLOTS)
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(part)] = (q << np.uint64(SLOTS)) + (x - q * f) + c
    return state, np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")


def decode_segment(n: int, state: np.ndarray, words: np.ndarray, table: Table) -> np.ndarray:
    out = np.empty(n, dtype="<u4")
    lanes, state, at = len(state), state.copy(), 0
    mask = np.uint64((1 << SLOTS) - 1)
    for i in range(0, n, lanes):
        x = state[: min(lanes, n - i)]
        slot = x & mask
        ids = table.symbol[slot]
        out[i : i + len(x)] = ids
        x = table.freq[ids] * (x >> np.uint64(SLOTS)) + slot - table.start[ids]
        low = x < LOW
        k = int(low.sum())
        if k:
            x[low] = (x[low] << np.uint64(32)) | words[at : at + k].astype(np.uint64)
            at += k
        state[: len(x)] = x
    return out


def write_block(docs: list[bytes], table: Table, params: StoreParams) -> bytes:
    """A block of the documents' ids (little-endian unsigned 32-bit)."""
    ids = np.frombuffer(b"".join(docs), "<u4")
    lanes = min(params.lanes, 1 << max(0, (len(ids) // 64).bit_length() - 1))
    heads, words, first = [], [], 0
    for at in range(0, len(ids), params.segment):
        part = ids[at : at + params.segment]
        state, own = encode_segment(part, lanes, table)
        heads.append(struct.pack("<II", zlib.crc32(part.tobytes()), first) + state.astype("<u8").tobytes())
        words.append(own.tobytes())
        first += len(own)
    sizes = np.array([len(d) // 4 for d in docs], dtype="<u4").tobytes()
    return HEAD.pack(MAGIC, 1, lanes, len(docs), len(ids), table.crc, params.segment, len(heads)) + sizes + b"".join(heads) + b"".join(words)


def read_block(body: bytes, table: Table, segments: range | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each document, and the ids of the asked segments (all by default); raises on damage."""
    magic, version, lanes, docs, tokens, crc, size, count = HEAD.unpack_from(body)
    if magic != MAGIC or version != 1 or crc != table.crc:
        raise ValueError("not a block of this table")
    at = HEAD.size
    sizes = np.frombuffer(body, "<u4", docs, at)
    at += 4 * docs
    width = 8 + 8 * lanes
    words = np.frombuffer(body, "<u4", offset=at + width * count)
    out = []
    for k in segments if segments is not None else range(count):
        here = at + width * k
        want, first = struct.unpack_from("<II", body, here)
        ids = decode_segment(min(size, tokens - k * size), np.frombuffer(body, "<u8", lanes, here + 8), words[first:], table)
        if zlib.crc32(ids.tobytes()) != want:
            raise ValueError(f"segment {k} is damaged")
        out.append(ids)
    return sizes, np.concatenate([*out, np.zeros(0, "<u4")])


def tokenised(docs: DataFrame, params: StoreParams) -> DataFrame:
    """doc_id, ids (unsigned 16-bit where they fit, else 32-bit, as ``wide`` says) of every row, alike within a batch.

    Each task ends with a row of its own: ``counts`` has how often each id occurred in it.
    """
    kind = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("wide", pa.bool_()), ("counts", pa.binary())])

    def run(batches):
        total = np.zeros(1, dtype=np.int64)
        for batch in sliced(batches, keeps=True):
            got = list(encoded(batch.column("text").to_pylist(), params.tokenizer, params.end))
            flat = np.frombuffer(b"".join(got), "<u4")
            seen = np.bincount(flat, minlength=len(total))
            seen[: len(total)] += total
            total = seen
            big = len(flat) > 0 and int(flat.max()) > 0xFFFF
            wide, ids = [big] * len(got), got
            if not big:
                raw, ends = flat.astype("<u2").tobytes(), np.cumsum([len(x) // 2 for x in got]).tolist()
                ids = [raw[a:b] for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(wide, pa.bool_()), pa.nulls(len(ids), pa.binary())], schema=kind)
        yield pa.RecordBatch.from_pydict({"doc_id": [None], "ids": [None], "wide": [None], "counts": [total.astype("<i8").tobytes()]}, schema=kind)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary, wide boolean, counts binary")


def widened(ids: bytes, wide: bool) -> bytes:
    return ids if wide else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def counted(rows: DataFrame) -> np.ndarray:
    """How often each id occurs; as many numbers as the vocabulary has ids."""

    def run(batches):
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                n = np.frombuffer(counts, "<i8")
                here = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"id": here, "n": n[here]})

    got = rows.where("counts is not null").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(int(max(got["id"].to_numpy(), default=-1)) + 1, dtype=np.int64)
    counts[got["id"].to_numpy()] = got["n"].to_numpy()
    return counts


def write(docs: DataFrame, scratch: Scratch, params: StoreParams = StoreParams()) -> DataFrame:
    """Writes the store under ``scratch`` and returns its blocks; ``frequencies`` holds the table."""
    spark = docs.sparkSession
    rows = scratch.table(tokenised(docs, params), "ids")
    counts = counted(rows)
    freq = normalised(counts)
    scratch.table(spark.createDataFrame([(bytearray(freq.astype("<u4").tobytes()), int(Table.of(freq).crc))], "freq binary, crc long"), "frequencies")
    shared = spark.sparkContext.broadcast(freq)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // params.shard))

    def run(batches):
        from pyspark import TaskContext

        table, shard = Table.of(shared.value), TaskContext.get().partitionId()
        kind = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("at", pa.int64()), ("tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("body", pa.binary())])
        block = at = size = 0
        names, docs = [], []

        def close():
            body = write_block(docs, table, params)
            return pa.RecordBatch.from_pydict({"shard": [shard], "block": [block], "at": [at], "tokens": [size], "doc_ids": [list(names)], "body": [body]}, schema=kind)

        for batch in batches:
            for doc_id, ids, wide in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "wide"))):
                names.append(doc_id)
                docs.append(widened(ids, wide))
                size += len(docs[-1]) // 4
                if size >= params.block:
                    yield close()
                    block, at, size, names, docs = block + 1, at + size, 0, [], []
        if docs:
            yield close()

    # one id may have very many rows, as null has: they are dealt by how their ids begin, and equal ones by where they stand
    placed = rows.where("counts is null").select("doc_id", "ids", "wide", F.substring("ids", 1, HEAD_BYTES).alias("head"), F.monotonically_increasing_id().alias("place"))
    ordered = placed.repartitionByRange(shards, "doc_id", "head", "place").select("doc_id", "ids", "wide").sortWithinPartitions("doc_id", "ids")
    out = ordered.mapInArrow(run, "shard int, block int, at long, tokens long, doc_ids array<long>, body binary")
    blocks = scratch.table(out, "blocks")
    scratch.drop("ids")
    return blocks


def frequencies(spark: SparkSession, scratch: Scratch) -> np.ndarray:
    row = spark.read.parquet(scratch.path("frequencies")).head()
    freq = np.frombuffer(bytes(row["freq"]), "<u4")
    if zlib.crc32(freq.tobytes()) != row["crc"]:
        raise ValueError("the table of frequencies is damaged")
    return freq


def read_store(blocks: DataFrame, freq: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all decoded from the blocks."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(freq)

    def run(batches):
        table = Table.of(shared.value)
        for batch in batches:
            for shard, at, doc_ids, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "at", "doc_ids", "body"))):
                sizes, ids = read_block(body, table)
                ends = np.cumsum(sizes, dtype=np.int64)
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array([shard] * len(sizes), pa.int32()), pa.array(at + ends - sizes, pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())], names=["doc_id", "shard", "start", "n_tokens", "ids_crc32"])

    got = blocks.select("shard", "at", "doc_ids", "body").mapInArrow(run, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")
    # one row for each shard, and there are few
    before = F.sum("all").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = blocks.groupBy("shard").agg(F.sum("tokens").alias("all")).select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return got.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to the store and read back from it."""
    scratch = Scratch(spark, "tokens")
    blocks = write(read(spark, sf_dir, "documents"), scratch)
    return read_store(blocks, frequencies(spark, scratch))
