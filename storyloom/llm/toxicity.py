"""Toxic passages by maximum-scoring segment search.

Each word gets a log-odds score from a lexicon with Dirichlet priors: a word's
toxic share is smoothed towards that of its longest shorter prefix, and so on
down to the share of all words, so words never seen take what their stem says.
A linear scan then finds all maximal scoring segments of a text, and
Karlin-Altschul statistics turn each one's score and the text's length into the
number of segments as good that chance alone would bring.  A document's score
adds up its significant segments and is calibrated as a probability.

Null and empty texts have no segment and get the score of a text without one.
Rows repeated stay repeated; a null id is scored like any other.  Very long
texts are scanned whole, in time that grows with their length.  Other columns
aren't looked at, and ``keep_clean`` returns them as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import Memo, id_crc, labelled_sample, logistic, newton_logistic, read, sliced

LETTERS = re.compile(r"[^\W\d_]+")
#: Lengths of the prefixes that a word's score backs off through.
STEMS = (3, 4, 5, 6, 7, 8)


@dataclass(frozen=True)
class ToxicityParams:
    #: Labelled rows that the model is fitted on, at most.
    max_rows: int = 12_000
    #: Weight of the prior, in documents.
    prior: float = 8.0
    #: Nodes of the lexicon in fewer documents aren't kept.
    min_docs: int = 3
    #: Nor are those that differ from what their stem says by fewer standard errors.
    least_z: float = 2.5
    #: Nor are stems of whose toxic documents one longer node has this share: they are that node's, not a family's.
    one_child: float = 0.8
    #: Scores nearer to 0 than this count as 0, then each word costs the drift.
    floor: float = 0.8
    drift: float = 0.25
    #: A segment is significant if chance brings fewer than this many as good.
    significance: float = 0.05


@dataclass
class ToxicityModel:
    """Small and bounded by ``max_rows``; goes to the executors in the closure's broadcast."""

    weights: dict = field(default_factory=dict)
    root: float = 0.5
    decay: float = 1.0
    scale: float = 0.1
    fit: tuple = (0.0, 0.0, 0.0)
    params: ToxicityParams = ToxicityParams()

    def word_score(self, word: str) -> float:
        p = self.root
        for node in nodes(word):
            p = self.weights.get(node, p)
        lift = math.log(p / (1 - p)) - math.log(self.root / (1 - self.root))
        return (lift if abs(lift) >= self.params.floor else 0.0) - self.params.drift


def nodes(word: str) -> list[str]:
    """Prefixes of a word from short to long, then the word itself."""
    return [word[:k] for k in STEMS if k < len(word)] + [word + "$"]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by the linear scan of Ruzzo and Tompa.

    Each candidate knows the nearest one before it with a smaller sum to its left,
    so what a search has passed over once is never looked at again.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        j = len(found) - 1
        while j >= 0 and found[j][2] >= left:
            j = found[j][4]
        while j >= 0 and found[j][3] < right:
            start, _, left, _, further = found[j]
            del found[j:]
            j = further
        found.append((start, end, left, right, j))
    return [(a, b, right - left) for a, b, left, right, _ in found]


def passages(words: list[str], memo: Memo) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """Scores of a text's words and its maximal segments.

    Segments are found on whole scores.  Inside one, a word that counts for toxic counts a half, a third and so on when
    it comes again, and the segment's score is that of its best part; what stands in other segments doesn't matter.
    """
    scores = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
    found = maximal_segments(scores)
    for k, (a, b, _) in enumerate(found):
        here = [i for i in range(a, b) if scores[i] > 0] if b - a > 1 else []
        if len({words[i] for i in here}) < len(here):
            times: Counter = Counter()
            for i in here:
                times[words[i]] += 1
                scores[i] /= times[words[i]]
            found[k] = a, b, max(s for _, _, s in maximal_segments(scores[a:b]))
    return scores, found


def evidence(segments: list[tuple[int, int, float]], n: int, model: ToxicityModel) -> list[tuple[int, int, float]]:
    """Segments with -ln of the number as good by chance in a text of ``n`` words, if significant."""
    least = -math.log(model.params.significance)
    out = [(a, b, model.decay * s - math.log(model.scale * max(n, 1))) for a, b, s in segments]
    return [x for x in out if x[2] >= least]


def features(found: list[tuple[int, int, float]]) -> tuple[float, float]:
    """The best segment's evidence and that of all, both on a log scale."""
    each = [x[2] for x in found]
    return math.log1p(max(each, default=0.0)), math.log1p(sum(each))


def score_text(text: str | None, memo: Memo, model: ToxicityModel) -> tuple[float, list[tuple[int, int, float]]]:
    words = LETTERS.findall((text or "").lower())
    found = evidence(passages(words, memo)[1], len(words), model)
    best, total = features(found)
    return float(logistic(model.fit[0] + model.fit[1] * best + model.fit[2] * total)), found


def training_rows(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """Texts of the bounded sample, of ids whose crc32 modulo 5 isn't 0; ``part`` 0 is for calibration."""
    ids = labelled_sample(labels, "toxic", params.max_rows, id_crc(F.col("doc_id")) % 5 != 0)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.select("text", "label", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4))).cast("int").alias("part"))


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Counts word stems on three quarters of the sample, calibrates on the last.

    Without labels of both kinds every score is the share of toxic labels (0 if there are none).
    """
    rows = training_rows(docs, labels, params)

    def count(batches):
        seen, toxic, n = Counter(), Counter(), [0, 0]
        for batch in sliced(batches):
            for text, label, part in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "part"))):
                if part:
                    here = {x for w in set(LETTERS.findall((text or "").lower())) for x in nodes(w)}
                    seen.update(here)
                    n[0] += 1
                    if label:
                        toxic.update(here)
                        n[1] += 1
        yield pa.RecordBatch.from_pydict({"node": ["", *seen], "n": [n[0], *seen.values()], "toxic": [n[1], *(toxic[k] for k in seen)]})

    counts = rows.mapInArrow(count, "node string, n long, toxic long").groupBy("node").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    table = counts.where((F.col("n") >= params.min_docs) | (F.col("node") == "")).toArrow().to_pydict()
    known = dict(zip(table["node"], zip(table["n"], table["toxic"])))
    n, toxic = known.pop("", (0, 0))
    model = ToxicityModel(params=params, root=(toxic + 0.5) / (n + 1) if n else 0.5)
    # what each node backs off to, and the most toxic documents that one of the nodes above a stem has
    shorter = {node: nodes(node[:-1])[:-1] if node.endswith("$") else [node[:k] for k in STEMS if k < len(node)] for node in known}
    child: Counter = Counter()
    for node, stems in shorter.items():
        if stems:
            child[stems[-1]] = max(child[stems[-1]], known[node][1])
    for node in sorted(known, key=lambda x: (x.endswith("$"), len(x))):
        n, toxic = known[node]
        if not node.endswith("$") and toxic and child[node] >= params.one_child * toxic:
            continue
        up = model.root
        for stem in shorter[node]:
            up = model.weights.get(stem, up)
        good, bad = n - toxic + params.prior * (1 - up), toxic + params.prior * up
        if abs(math.log(bad / good) - math.log(up / (1 - up))) >= params.least_z * math.sqrt(1 / bad + 1 / good):
            model.weights[node] = bad / (n + params.prior)
    calibrate(rows, model)
    return model


def calibrate(rows: DataFrame, model: ToxicityModel) -> None:
    """Sets decay and scale from clean texts, then the weights of the last logistic step."""

    def scan(batches):
        memo = Memo(model.word_score)
        for batch in sliced(batches):
            out = {"label": [], "n": [], "segments": [], "bins": []}
            for text, label, part in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "part"))):
                if part == 0:
                    words = LETTERS.findall((text or "").lower())
                    scores, found = passages(words, memo)
                    out["label"].append(int(label))
                    out["n"].append(len(words))
                    out["segments"].append([s for _, _, s in found])
                    out["bins"].append(np.bincount(np.clip(np.round(scores * 4), -40, 40).astype(np.int64) + 40, minlength=81).tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("label", pa.int32()), ("n", pa.int64()), ("segments", pa.list_(pa.float64())), ("bins", pa.list_(pa.int64()))]))

    got = rows.mapInArrow(scan, "label int, n long, segments array<double>, bins array<long>").toArrow().to_pydict()
    label = np.array(got["label"], dtype=float)
    if not len(label) or label.min() == label.max():
        share = float(label.mean()) if len(label) else 0.0
        model.fit = (math.log((share + 1e-3) / (1 - share + 1e-3)), 0.0, 0.0)
        return
    clean = [i for i, y in enumerate(label) if not y]
    bins = np.sum([got["bins"][i] for i in clean], axis=0).astype(float)
    model.decay = karlin_decay(np.arange(-40, 41) / 4, bins / max(bins.sum(), 1))
    chance = [(got["n"][i], s) for i in clean for s in got["segments"][i] if s >= 1.0]
    words = sum(got["n"][i] for i in clean)
    model.scale = max(1e-6, float(np.median([math.exp(min(model.decay * s, 50.0)) * rank / max(words, 1) for rank, s in enumerate(sorted((s for _, s in chance), reverse=True), 1)])) if chance else 1e-4)
    x = np.array([[1.0, *features(evidence([(0, 0, s) for s in seg], n, model))] for seg, n in zip(got["segments"], got["n"])])
    model.fit = tuple(float(v) for v in newton_logistic(x, label))


def karlin_decay(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(decay * value)) = 1; 1.0 where chance has no gain."""
    if not shares[values > 0].sum() or (values * shares).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    excess = lambda d: float((shares * np.exp(np.clip(d * values, -60, 60))).sum()) - 1
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return min(max(low, 0.05), 5.0)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted, and the significant segments (word offsets and evidence)."""
    schema = "doc_id long, score double, segments array<struct<start:int,end:int,evidence:double>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        model = shared.value
        memo = Memo(model.word_score)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))
        for batch in sliced(batches):
            got = [score_text(text, memo, model) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in got], pa.float64()), pa.array([[dict(zip(("start", "end", "evidence"), s)) for s in x[1]] for x in got], kind)], names=["doc_id", "score", "segments"]
            )

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; see the module. ``n_passages`` counts its significant passages."""
    docs = read(spark, sf_dir, "documents")
    found = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "predicted", F.size("segments").alias("n_passages"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that aren't predicted toxic, with their columns.

    A row is judged where it lies, without a join, so repeated rows and null ids stay as they are.
    """
    shared = spark.sparkContext.broadcast(fit(docs, read(spark, sf_dir, "labels")))

    def scan(batches):
        model = shared.value
        memo = Memo(model.word_score)
        for batch in sliced(batches):
            yield batch.filter(pa.array([score_text(t, memo, model)[0] < 0.5 for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
