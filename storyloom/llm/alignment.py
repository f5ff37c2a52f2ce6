"""Cross-tokenizer alignment: how the tokens of two tokenizers overlap, byte by byte.

Both tokenizers cut the same bytes (a space and the text), so their tokens are
two tables of intervals.  Each Arrow slice of documents is a block.  Both kinds
of model never join what lies on both sides of a single space between two
characters that aren't white space, so a block's documents are cut there into
units, and each different unit is encoded and aligned once: DuckDB, in the task,
finds the token of B that holds each start of a token of A by an ASOF join, the
tokens of B that start inside one of A by a range join, and numbers groups by a
window sum over the places where both start.  A block is one row of a Parquet
table: its documents as runs of units, its units as runs of links, and how often
its documents link each pair of ids.

These partial counts are merged in Spark; each block then gets the counts of its
own pairs back, one row for a pair and block however often it occurs, and sums
them over units and documents.  Rows of blocks are megabytes, so they are written
in row groups of few and come to Python one block at a time.

Texts that are null or empty, or that one of the tokenizers doesn't give back
byte for byte, have no tokens.  Rows without an id and rows that repeat are rows
like others.  A text longer than a block is a block; other columns aren't looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, give_back, kept, read, sliced
from storyloom.llm.tokens import byte_letters

META = "▁"
#: Where a text is cut into units: white space here is all that any of the tokenizers takes for it.
CUT = re.compile(r"(?<=\S)(?= \S)")
#: Characters of a block, and units that are encoded at a time, about.
BLOCK, SLICE = 4 << 20, 20_000
#: Cuts as the expression of the byte-level family's own pre-tokenizer does; others are refused.
FAMILY = [("ByteLevel", False, True)]

ALIGN = """
    SELECT *, CAST(sum(CASE WHEN of_a AND of_b THEN 1 ELSE 0 END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS grp FROM (
      SELECT a.unit, a.s AS pos, a.id AS a, b.id AS b, true AS of_a, a.s = b.s AS of_b FROM a ASOF JOIN b ON a.s >= b.s
      UNION ALL
      SELECT b.unit, b.s AS pos, a.id AS a, b.id AS b, false AS of_a, true AS of_b FROM b JOIN a ON a.s < b.s AND b.s < a.e
    ) ORDER BY pos"""


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def place(name: str) -> str:
    return name if os.sep in name else public_tokenizers.path(name)


class ByteLevel:
    """A byte-level BPE tokenizer whose words never cross a single space."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        with open(place(name), encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        steps = [(p.get("type"), p.get("add_prefix_space", False), p.get("use_regex", True)) for p in pre.get("pretokenizers", [pre])]
        if spec["model"].get("type") != "BPE" or spec.get("normalizer") is not None or steps != FAMILY:
            raise ValueError("only byte-level BPE without a normaliser")
        vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"].get("merges", [])]
        letters = {chr(c): b for b, c in byte_letters().items()}
        self.bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for piece, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else b""
        ordered = [vocab.get(a + b) for a, b in merges]
        if ordered == list(range(256, 256 + len(merges))) and all(len(self.bytes[i]) == 1 for i in range(256)):
            # ids are the ranks of the merges, so the faster library gives the same ones
            ranks = {self.bytes[i]: i for i in range(256 + len(merges))}
            self.one = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            library = Tokenizer.from_file(place(name))
            library.encode_special_tokens = True
            self.one = lambda unit: library.encode(unit, add_special_tokens=False).ids

    def encode(self, units: list[str]) -> list[list[int]]:
        return [*map(self.one, units)]


class Pieces:
    """A SentencePiece BPE model that adds the space in front and has no piece across a space."""

    def __init__(self, name: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(place(name), "rb") as f:
            model.ParseFromString(f.read())
        norm, kind = model.normalizer_spec, pb.ModelProto.SentencePiece
        crosses = re.compile(f"[^{META}]{META}")
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or norm.precompiled_charsmap:
            raise ValueError("only BPE models that keep characters as they are and add a space in front")
        if any(p.type == kind.USER_DEFINED or crosses.search(p.piece) for p in model.pieces):
            raise ValueError("only models without pieces across a space, or of a user")
        self.library = sentencepiece.SentencePieceProcessor(model_file=place(name))
        self.bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else p.piece.replace(META, " ").encode() for p in model.pieces]

    def encode(self, units: list[str]) -> list[list[int]]:
        """Units begin with the space that the model adds."""
        return self.library.encode([u[1:] for u in units], num_threads=1)


class Aligner:
    """Both tokenizers, and DuckDB for the tables of a block."""

    def __init__(self, a: str, b: str):
        import duckdb

        self.a, self.b = ByteLevel(a), Pieces(b)
        self.length = [np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b)]
        self.said = [pa.array([str(i) for i in range(len(t.bytes))]) for t in (self.a, self.b)]
        self.con = duckdb.connect(config={"threads": "1", "memory_limit": "256MB"})

    def units(self, texts: list[str]) -> dict:
        """The alignment of each unit: figures, groups as text, and the links of all units in order as pairs of ids.

        ``whole`` says whether a unit's bytes are its tokens'; one that isn't has no tokens.
        """
        parts = [self.aligned(texts[at : at + SLICE]) for at in range(0, len(texts), SLICE)] or [self.aligned([])]
        out = {c: np.concatenate([p[c] for p in parts]) for c in ("whole", *FIGURES, "a", "b")}
        return out | {"said": [x for p in parts for x in p["said"]]}

    def aligned(self, texts: list[str]) -> dict:
        """The same for a slice of units, which lie one after another on one line of bytes."""
        raw, ids, whole = [t.encode() for t in texts], [], np.ones(len(texts), bool)
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        for t, length in zip((self.a, self.b), self.length):
            own = t.encode(texts)
            n, flat = np.fromiter(map(len, own), dtype=np.int64, count=len(own)), np.array([*chain.from_iterable(own)], dtype=np.int64)
            if b"".join(map(t.bytes.__getitem__, flat.tolist())) != b"".join(raw) or not np.array_equal(sums(length[flat], n), sizes):
                whole &= np.array([b"".join(map(t.bytes.__getitem__, x)) == r for x, r in zip(own, raw)], dtype=bool)
            ids.append((n, flat))
        counts, tables = [], []
        for (n, flat), length in zip(ids, self.length):
            flat, n = flat[np.repeat(whole, n)], np.where(whole, n, 0)
            end = np.cumsum(length[flat])
            counts.append(n)
            tables.append(pa.table({"unit": np.repeat(np.arange(len(n)), n), "s": end - length[flat], "e": end, "id": flat.astype(np.int32)}))
        for name, table in zip("ab", tables):
            self.con.register(name, table)
        links = self.con.sql(ALIGN).fetch_arrow_table()
        for name in "ab":
            self.con.unregister(name)
        unit, grp, of_a, of_b = (links[c].to_numpy() for c in ("unit", "grp", "of_a", "of_b"))
        groups = int(grp[-1]) + 1 if len(grp) else 0
        # ids of each group, joined: both tables are in order of bytes, as groups are
        sides = []
        for table, starts, said in zip(tables, (of_a, of_b), self.said):
            ends = np.concatenate(([0], np.cumsum(np.bincount(grp[starts], minlength=groups))))
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), said.take(table["id"].combine_chunks())), ","))
        each = pc.binary_join_element_wise(*sides, "|")
        n_groups = np.bincount(unit[of_a & of_b], minlength=len(texts))
        said = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_groups))), pa.int32()), each), ";")
        return {"whole": whole, "n_a": counts[0], "n_b": counts[1], "n_groups": n_groups, "n_links": np.bincount(unit, minlength=len(texts)), "said": said.to_pylist(), "a": links["a"].to_numpy(), "b": links["b"].to_numpy()}


BLOCK_KIND = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sha", pa.list_(pa.string())), *((c, pa.list_(pa.int64())) for c in FIGURES), ("n_units", pa.list_(pa.int32())),
    ("units", pa.binary()), ("links", pa.binary()), ("unit_links", pa.binary()), ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))),
])
BLOCK_SQL = (
    "block long, doc_ids array<long>, sha array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, n_units array<int>, "
    "units binary, links binary, unit_links binary, pairs array<struct<a:int,b:int,n:long>>"
)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the given sizes, none of them lost where a size is 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(sizes, dtype=np.int64)
    return total[ends] - total[ends - sizes]


def block_of(number: int, doc_ids: list, texts: list, aligner: Aligner) -> pa.RecordBatch:
    """The documents of a block, aligned."""
    index: dict[str, int] = {}
    runs: list[list[int]] = []
    for text in texts:
        runs.append([index.setdefault(unit, len(index)) for unit in CUT.split(" " + text)] if text else [])
    got = aligner.units(list(index))
    whole = got["whole"].tolist()
    runs = [x if all(map(whole.__getitem__, x)) else [] for x in runs]
    sizes = np.array([len(x) for x in runs], dtype=np.int64)
    flat = np.fromiter((u for x in runs for u in x), dtype=np.int64, count=int(sizes.sum()))
    sha = [hashlib.sha256(";".join(map(got["said"].__getitem__, x)).encode()).hexdigest() if x else "" for x in runs]
    # pairs of ids as numbers, each with how often the block's documents link it
    key = got["a"].astype(np.int64) << 32 | got["b"].astype(np.int64)
    pairs, link = np.unique(key, return_inverse=True)
    times = np.bincount(flat, minlength=len(index))
    often = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(often, link, np.repeat(times, got["n_links"]))
    used = often > 0  # units of texts that have no tokens after all
    number_of = np.cumsum(used) - 1
    row = {
        "block": number, "doc_ids": doc_ids, "sha": sha, **{c: sums(got[c][flat], sizes) for c in FIGURES}, "n_units": sizes, "units": flat.astype("<u4").tobytes(),
        "links": np.where(used, number_of, 0)[link].astype("<u4").tobytes(), "unit_links": got["n_links"].astype("<u4").tobytes(),
    }
    kind = BLOCK_KIND.field("pairs").type.value_type
    structs = pa.StructArray.from_arrays([pa.array((pairs[used] >> 32).astype(np.int32)), pa.array((pairs[used] & 0xFFFFFFFF).astype(np.int32)), pa.array(often[used])], fields=list(kind))
    arrays = [pa.ListArray.from_arrays([0, len(structs)], structs) if f.name == "pairs" else pa.array([row[f.name]], f.type) for f in BLOCK_KIND]
    return pa.RecordBatch.from_arrays(arrays, schema=BLOCK_KIND)


def blocks_of(docs: DataFrame, a: str, b: str, size: int) -> DataFrame:
    """Blocks of at least ``size`` characters, or what a task has left."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        aligner, names, texts, chars = kept((a, b), lambda: Aligner(a, b)), [], [], 0
        for batch in sliced(batches, 100, keeps=True):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                names.append(doc_id)
                texts.append(text)
                chars += len(text or "")
                if chars >= size:
                    yield block_of(number, names, texts, aligner)
                    number, names, texts, chars = number + 1, [], [], 0
                    give_back()
        if names:
            yield block_of(number, names, texts, aligner)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCK_SQL)


def counted(pairs: DataFrame) -> DataFrame:
    """a, b, count, best: how many links hold a pair corpus-wide, and whether no other pair of its b has more."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # a pair for each id of A at most, so these groups are bounded by its vocabulary
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", size: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "alignment")
    blocks = scratch.table(blocks_of(docs, a, b, size), "blocks", heavy=True)
    pairs = blocks.select("block", F.posexplode("pairs").alias("k", "pair")).select("block", "k", "pair.*")
    counts = scratch.table(counted(pairs), "counts")
    met = pairs.join(counts, ["a", "b"]).select(F.col("block").alias("of"), "k", "count", "best")

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        """A block and the counts of its pairs: one block at a time is in memory, on either side of the pipe."""
        value = {c: own.column(c).combine_chunks()[0] for c in own.column_names}
        flat, links, per = (np.frombuffer(value[c].as_py(), "<u4").astype(np.int64) for c in ("units", "links", "unit_links"))
        sizes = np.array(value["n_units"].values, dtype=np.int64)
        count, best = np.zeros((2, met.num_rows), np.int64)
        if met.num_rows:
            place = met.column("k").to_numpy()
            count[place], best[place] = met.column("count").to_numpy(), met.column("best").to_numpy()
        per_doc = lambda x: sums(sums(x[links], per)[flat], sizes) if len(x) and len(links) else np.zeros(len(sizes), np.int64)
        return pa.Table.from_arrays([value["doc_ids"].values, *(value[c].values for c in FIGURES), pa.array(per_doc(best)), pa.array(per_doc(count)), value["sha"].values], names=["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"])

    columns = ["block", "doc_ids", "sha", *FIGURES, "n_units", "units", "links", "unit_links"]
    both = blocks.select(*columns).groupBy("block").cogroup(met.groupBy("of"))
    return both.applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of both tokenizers, aligned."""
    return align(read(spark, sf_dir, "documents"))
