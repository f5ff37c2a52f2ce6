"""Scores of the two classifiers and the choice among near-duplicates, worked out in plain Python beside them."""

import math
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from storyloom.llm import neardup, quality, toxicity

WORDS = "the river stone walks over green quiet hills and then idiotic moronic scumlord vile vileness trash trashy scum mild don't über".split()


def texts(seed, n=60):
    rng = random.Random(seed)
    out = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(18))) for _ in range(n)]
    return out + [None, "", "...", "idiotic", "IDIOTIC, moronic! Scum-trash", "scum scum scum scum the the the the the the the scum", "vile " * 12]


# --- toxicity ---------------------------------------------------------------

MODEL = toxicity.ToxicityModel(weights={"idiotic$": 0.93, "moron": 0.9, "scum": 0.8, "scumlord$": 0.97, "vile": 0.85, "vilen": 0.4, "trash$": 0.77, "river$": 0.02, "the$": 0.09, "mild$": 0.14}, root=0.13, decay=0.9, scale=0.02, fit=(-3.0, 1.7, 0.9))


def plain_toxicity(text, m):
    """By the definitions: back-off to the longest known beginning, all maximal stretches, repeats damped, evidence, logistic."""
    words = toxicity.LETTERS.findall((text or "").lower())
    scores = []
    for w in words:
        p = m.root
        for k in [*toxicity.STEMS, None]:
            if k is None or k < len(w):
                p = m.weights.get(w + "$" if k is None else w[:k], p)
        lift = math.log(p / (1 - p)) - math.log(m.root / (1 - m.root))
        scores.append((lift if abs(lift) >= m.params.floor else 0.0) - m.params.drift)
    n, found = len(words), []
    s = lambda x, i, j: math.fsum(x[i:j])
    better = lambda x, i, j: all(s(x, a, b) < s(x, i, j) - 1e-12 for a in range(i, j) for b in range(a + 1, j + 1) if (a, b) != (i, j))
    good = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if s(scores, i, j) > 0 and better(scores, i, j)]
    for i, j in good:
        if any((a, b) != (i, j) and a <= i and j <= b for a, b in good):
            continue
        seen: dict = {}
        own = []
        for k in range(i, j):
            seen[words[k]] = seen.get(words[k], 0) + (scores[k] > 0)
            own.append(scores[k] / seen[words[k]] if scores[k] > 0 else scores[k])
        best = max(s(own, a, b) for a in range(len(own)) for b in range(a + 1, len(own) + 1))
        e = m.decay * best - math.log(m.scale * max(n, 1))
        if e >= -math.log(m.params.significance):
            found.append((i, j, e))
    each = [e for *_, e in found]
    z = m.fit[0] + m.fit[1] * math.log1p(max(each, default=0.0)) + m.fit[2] * math.log1p(sum(each))
    return 1 / (1 + math.exp(-z)), found


def test_toxicity_scores_by_definition(spark):
    rows = list(enumerate(texts(1)))
    got = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), MODEL).collect()}
    passages = 0
    for d, t in rows:
        score, found = plain_toxicity(t, MODEL)
        assert math.isclose(got[d]["score"], score, rel_tol=1e-9) and got[d]["predicted"] == int(score >= 0.5), t
        assert [(x["start"], x["end"], round(x["evidence"], 9)) for x in got[d]["segments"]] == [(i, j, round(e, 9)) for i, j, e in found], t
        passages += len(found)
    assert passages > 20 and len({r["predicted"] for r in got.values()}) == 2


# --- quality ----------------------------------------------------------------

M64 = (1 << 64) - 1


def plain_quality(text, model):
    """By the definitions, in whole numbers: means of the weights of character 3-grams and of words and pairs, calibrated; and the base rules."""
    text, bits = text or "", model.params.bits
    words = re.findall("[^\x20\x09-\x0d]+", text)
    chars = [((ord(a) * 0x9E3779B1 + ord(b) * 0x85EBCA77 + ord(c) * 0xC2B2AE3D) % 2**32 * 0x27D4EB2F) % 2**32 >> (32 - bits) for a, b, c in zip(text, text[1:], text[2:])]
    hashes = [xxhash.xxh3_64_intdigest(w.lower()) for w in words]

    def mixed(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & M64
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & M64
        return x ^ x >> 31

    both = hashes + [mixed((a + 3 * b) & M64) for a, b in zip(hashes, hashes[1:])]
    both = [(1 << bits) + (h >> (64 - bits)) for h in both]
    z = model.bias + sum(math.fsum(float(model.weights[i]) for i in part) / len(part) for part in (chars, both) if part)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    p = 1 / (1 + math.exp(-(model.scale[0] + model.scale[1] * z)))
    return failed, p


def test_quality_scores_by_definition(spark):
    rng = np.random.default_rng(5)
    params = quality.QualityParams(bits=10)
    model = quality.QualityModel(weights=rng.normal(0, 3, 2 << 10).astype(np.float32), bias=0.2, scale=(0.1, 1.3), params=params)
    some = texts(2) + [" ".join(texts(k, 1)[0] or "x" for k in range(i, i + 9)) for i in range(40)] + ["a b c d e f g h i j " * 9, "🙂é " * 30]
    rows = list(enumerate(some))
    got = {r["doc_id"]: r for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for d, t in rows:
        failed, p = plain_quality(t, model)
        assert got[d]["base_failed"] == failed and math.isclose(got[d]["probability"], p, rel_tol=1e-5), t
        assert abs(p - 0.5) < 1e-4 or got[d]["kept"] == (not failed and p >= 0.5)
    assert len({r["kept"] for r in got.values() if not r["base_failed"]}) == 2


# --- near-duplicates --------------------------------------------------------


def test_keep_one_by_definition(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(60)) for _ in range(12)]
    near = [" ".join(w if k != 30 else "changed" for k, w in enumerate(t.split())) for t in base[:6]]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t) for i, t in enumerate(near)] + [(3, base[3]), (3, base[3]), (101, near[1]), (None, base[0]), (None, None), (200, None), (201, ""), (202, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("gone", "gone_", "component_id", "n_shingles", "lo", "hi", "regs", "band", "bucket", "Rep")}).repartition(4)
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(len(w) - 4)} or ({tuple((t or "").lower().split())} - {()})
    ids = sorted({(d, t) for d, t in rows if d is not None}, key=repr)
    alike = lambda a, b: bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b)
    sets = {d: shingles(t) for d, t in ids}
    group = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if alike(sets[a], sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    want = sorted(((d, t) for d, t in rows if d is None or group[d] == d), key=repr)
    out = neardup.keep_one(spark, docs, "")
    assert out.columns == docs.columns and sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == want
    assert len(want) == len(rows) - 7
    # an id whose rows have different texts goes whole or stays whole
    twice = [(1, base[0]), (1, base[1]), (2, base[0]), (2, base[1]), (3, base[2])]
    kept = [r["doc_id"] for r in neardup.keep_one(spark, spark.createDataFrame(twice, "doc_id long, text string"), "").collect()]
    assert sorted(kept) in ([1, 1, 3], [1, 1, 2, 2, 3]) and kept.count(1) == 2
