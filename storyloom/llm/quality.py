"""Quality rules: a hashed n-gram logistic regression behind a few fixed base rules.

Features are shares of hashed character 3-grams and of hashed words and word
pairs; the regression is trained on a bounded sample of labelled rows, its
probabilities are calibrated on rows that it wasn't trained on, and documents
are scored in Arrow batches against fixed thresholds.

Null and empty texts have no words, so they fail the base rules; repeated rows
and null ids are judged like any other row.  Very long texts are judged whole,
one at a time.  Windows are counted by 64-bit hashes of their words, whose words
aren't compared: two different windows of one text count as one in fewer than
one in 1e10 texts of 20,000 words.  Other columns aren't looked at, and
``keep_good`` returns them as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import SPACES, Memo, Scratch, labelled_sample, logistic, mix64, newton_logistic, read, sliced

SYMBOLS = "#*$%&|<>"
#: Words of a window that counts as repeated text.
WINDOW = 8


@dataclass(frozen=True)
class QualityParams:
    #: Labelled rows that the model is fitted on, at most.
    max_rows: int = 6_000
    #: Features of them that the driver takes, at most, of eight bytes each; a row that goes beyond is left out.
    max_features: int = 16_000_000
    #: log2 of the buckets of characters, and of words.
    bits: int = 17
    #: Passes over the rows, rows of a step, and the step's size.
    epochs: int = 8
    batch: int = 256
    rate: float = 0.3
    ridge: float = 1e-6
    #: A document is kept at this calibrated probability of good quality.
    keep_at: float = 0.5
    min_words: int = 20
    #: Percent of words in repeated windows, at most.
    max_repeat: int = 30


@dataclass
class QualityModel:
    weights: np.ndarray | None = None
    bias: float = 0.0
    scale: tuple = (0.0, 1.0)
    params: QualityParams = field(default_factory=QualityParams)

    def probability(self, buckets: tuple[np.ndarray, np.ndarray]) -> float:
        if self.weights is None:
            return float(logistic(self.scale[0]))
        z = self.bias + sum(float(self.weights[b].mean()) for b in buckets if len(b))
        return float(logistic(self.scale[0] + self.scale[1] * z))


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower())


def text_buckets(text: str, words: list[str], memo: Memo, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's character 3-grams, and of its words and word pairs."""
    shift = np.uint32(32 - bits)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    chars = points[:0]
    if len(points) >= 3:
        chars = (points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> shift
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    pairs = mix64(h[:-1] + h[1:] * np.uint64(3)) if len(h) > 1 else h[:0]
    both = (np.concatenate((h, pairs)) >> np.uint64(64 - bits)).astype(np.uint32) + np.uint32(1 << bits)
    return chars, both


@dataclass(frozen=True)
class BaseStats:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    def failed(self, params: QualityParams) -> bool:
        return self.n_words < params.min_words or 100 * self.n_repeat_words > params.max_repeat * self.n_words


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = mix64(np.array([seen.setdefault(w, len(seen) + 1) for w in words], dtype=np.uint64))
    h = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    starts = np.unique(np.concatenate((order[1:][same], order[:-1][same])))
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def base_stats(text: str, raw: bytes, words: list[bytes]) -> BaseStats:
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return BaseStats(
        n_words=len(words),
        word_chars=len(text) - sum(map(text.count, SPACES)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeated_words(words),
    )


def judge(text: str | None, memo: Memo, model: QualityModel) -> tuple[BaseStats, bool, float]:
    """A text's base figures, whether it fails them, and its probability of good quality."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    stats = base_stats(text, raw, words)
    return stats, stats.failed(model.params), model.probability(text_buckets(text, [w.decode("utf-8", "surrogatepass") for w in words], memo, model.params.bits))


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Trains on four fifths of the bounded sample and calibrates on scores out of fold of all five.

    Without labels of both kinds the model says the share of good labels for every text.
    """
    ids = labelled_sample(labels, "quality", params.max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "label", F.xxhash64("doc_id", F.lit(17)).alias("place"), F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(5)).cast("int").alias("part"))

    def extract(batches):
        memo = Memo(word_hash)
        for batch in sliced(batches):
            index, share = [], []
            for text in batch.column("text").to_pylist():
                words = [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]
                parts = [np.unique(b, return_counts=True) for b in text_buckets(text or "", words, memo, params.bits)]
                index.append(np.concatenate([p[0] for p in parts]).astype(np.int32))
                share.append(np.concatenate([p[1] / max(p[1].sum(), 1) for p in parts]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), batch.column("part"), pa.array(index, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))], names=["label", "place", "part", "index", "share"])

    scratch = Scratch(docs.sparkSession, "quality")
    every = scratch.table(rows.mapInArrow(extract, "label int, place long, part int, index array<int>, share array<float>"), "features")
    # what the driver takes is bounded by bytes, too: rows in the sample's order, none that goes beyond
    sizes = every.select("place", F.size("index").alias("n")).toArrow().sort_by([("place", "ascending"), ("n", "ascending")])
    taken, total = [], 0
    for place, n in zip(sizes["place"].to_pylist(), sizes["n"].to_pylist()):
        if total + n <= params.max_features:
            taken.append((place, n))
            total += n
    if len(taken) < len(sizes):
        chosen = docs.sparkSession.createDataFrame(sorted(set(taken)), "place long, n int")
        every = every.join(F.broadcast(chosen), (every["place"] == chosen["place"]) & (F.size("index") == chosen["n"]), "left_semi")
    got = every.orderBy("place", F.xxhash64("index")).toArrow()
    scratch.drop("features")
    y, part = got["label"].to_numpy().astype(float), got["part"].to_numpy()
    model = QualityModel(params=params)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 1.0
        model.scale = (float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0)
        return model
    index, share = got["index"].combine_chunks(), got["share"].combine_chunks()
    ends = index.offsets.to_numpy()
    flat, value = index.values.to_numpy(), share.values.to_numpy()
    z = np.zeros(len(y))
    for k in range(4, -1, -1):  # each part by a model of the others; the last of them is the one that stays
        model.weights, model.bias = train(flat, value, ends, y, np.flatnonzero(part != k), params)
        for i in np.flatnonzero(part == k):
            here = slice(ends[i], ends[i + 1])
            z[i] = model.bias + float(model.weights[flat[here]] @ value[here])
    base, slope = (float(v) for v in newton_logistic(np.column_stack((np.ones(len(y)), z)), y))
    if slope <= 0:  # scores that say nothing about rows not trained on: the share of good ones
        base, slope = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), 0.0
    model.scale = base, slope
    return model


def train(flat: np.ndarray, value: np.ndarray, ends: np.ndarray, y: np.ndarray, rows: np.ndarray, params: QualityParams) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows by Adam in small batches, both labels with the same weight.

    Row i is ``flat`` and ``value`` from ``ends[i]`` to ``ends[i + 1]``; only ``rows`` are trained on.  The order is the
    same at each run, steps shrink to nothing, and what is held at a time besides the rows is one batch.
    """
    size = 2 << params.bits
    good = y[rows].sum()
    weight = np.where(y > 0, 0.5 * len(rows) / max(good, 1), 0.5 * len(rows) / max(len(rows) - good, 1))
    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    order = np.random.default_rng(29)
    batches = -(-len(rows) // params.batch)
    t, last = 0, params.epochs * batches
    for _ in range(params.epochs):
        mixed = order.permutation(rows)
        for k in range(batches):
            part = mixed[k * params.batch : (k + 1) * params.batch]
            counts = ends[part + 1] - ends[part]
            starts = np.cumsum(counts) - counts
            at = np.repeat(ends[part] - starts, counts) + np.arange(counts.sum())
            index, x = flat[at], value[at]
            own = np.repeat(np.arange(len(part)), counts)
            z = bias + np.bincount(own, weights=w[index] * x, minlength=len(part))
            error = (logistic(z) - y[part]) * weight[part] / len(part)
            grad = np.bincount(index, weights=x * error[own], minlength=size) + params.ridge * w
            gb = error.sum()
            t += 1
            m, v, mb, vb = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
            fix, fix2, rate = 1 - 0.9**t, 1 - 0.99**t, params.rate * (1 - t / last)
            w -= rate * (m / fix) / (np.sqrt(v / fix2) + 1e-7)
            bias -= rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-7)
    return w.astype(np.float32), float(bias)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Per row: doc_id, the base figures, base_failed, the probability and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def scan(batches):
        model = shared.value
        memo = Memo(word_hash)
        for batch in sliced(batches):
            got = [judge(t, memo, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([getattr(x[0], n) for x in got], pa.int64()) for n in names), pa.array([x[1] for x in got], pa.bool_()), pa.array([x[2] for x in got], pa.float64())],
                names=["doc_id", *names, "base_failed", "probability"],
            )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, probability double"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= model.params.keep_at))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base figures and verdict."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that pass, with their columns."""
    shared = spark.sparkContext.broadcast(fit(docs, read(spark, sf_dir, "labels")))

    def scan(batches):
        model = shared.value
        memo = Memo(word_hash)
        for batch in sliced(batches):
            got = (judge(t, memo, model) for t in batch.column("text").to_pylist())
            yield batch.filter(pa.array([not failed and p >= model.params.keep_at for _, failed, p in got], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
