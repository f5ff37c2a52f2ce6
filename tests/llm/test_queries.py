"""The registered queries themselves, on small tables with every oddity, against brute force, the libraries or SQL."""

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from storyloom.llm import chat, fingerprint, license_scan, neardup, packing, quality, queries, secret_scan, token_store, toxicity, wfst
from storyloom.llm.common import Memo

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
WORDS = "the claim river stone walks over green quiet hills and then some more plain words of every day".split()
BAD = ["scumlord", "idiotic", "moronic", "trashy", "loserish", "vileness", "wretchy"]
LONG = " ".join(WORDS[i * 7 % len(WORDS)] + str(i % 997) for i in range(20_000))
#: Names that operators use inside, as columns of the table.
CLASHING = ["gone", "__gone", "spans", "key", "id", "label", "part", "n", "lo", "hi", "regs", "length", "number", "hash", "next", "form", "segments", "score", "probability", "w", "band", "window"]


def make(spark, folder, rows, labels=(), extra=True):
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS)
    if extra:
        docs = docs.withColumns({c: F.lit("own") for c in CLASHING})
    docs.repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return folder


def corpus(seed=4, n=160):
    """Texts with copies, near copies, secrets, poor and toxic ones, odd and long ones; and their labels."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "", str(rng.randrange(50))]) for _ in range(rng.randrange(25, 90))]
        good, toxic = i % 4 != 0, i % 5 == 1
        if toxic:
            for at, w in zip(rng.sample(range(len(words)), 5), rng.sample(BAD, 5)):
                words[at] = w
        text = " ".join(words) + "."
        if not good:
            text = " ".join(w.upper() + "$$%!!" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    for i in range(10):  # exact and near copies
        rows.append((1000 + i, rows[i][1]))
        words = rows[20 + i][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((1100 + i, " ".join(words)))
    odd = [None, "", " \n", "a", "a b", "A B", "same text here", "same text here", "é 🙂 ﬁ", "Licensed under the MIT License. password=hunter22", "word " * 300, LONG, LONG + " end"]
    rows += [(2000 + i, t) for i, t in enumerate(odd)]
    rows += [(2003, "a"), (2006, "same text here"), (2006, "same text here")]  # rows that repeat
    labels += [(None, 1, 0), (5, None, None), (3, 1, 1), (3, 1, 0), (99999, 1, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return make(spark, str(tmp_path_factory.mktemp("queries")), *corpus())


def sql(folder, query, table="documents"):
    c = duckdb.connect()
    c.sql(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    return c.sql(query)


@pytest.mark.parametrize("name", ["op1_license_scan", "op3_near_duplicates", "op7_secret_spans"])
def test_like_sql(spark, folder, name):
    got, want = queries.QUERIES[name](spark, folder), sql(folder, queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda rows, names: sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in rows)
    assert plain(map(tuple, got.collect()), got.columns) == plain(want.fetchall(), want.columns)


def test_near_duplicates_query(spark, folder):
    rows, _ = corpus()
    got = neardup.op3_near_duplicates(spark, folder).collect()
    assert len(got) == len(rows) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[1000 + i]["component_id"] == by[i]["component_id"] for i in range(10)) and by[2000]["n_shingles"] == 0


def base_figures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen: dict = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    repeat = len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)})
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), repeat


def test_quality_query(spark, folder):
    rows, labels = corpus()
    got = quality.op4_quality_rules(spark, folder).collect()
    figures = lambda r: (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
    assert sorted(map(figures, got)) == sorted((d, *base_figures(t)) for d, t in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["probability"] >= 0.5)
    truth = {d: q for d, q, _ in labels if d is not None and d < 160 and q is not None}
    assert sum(r["kept"] != bool(truth[r["doc_id"]]) for r in got if r["doc_id"] in truth and not r["base_failed"]) <= 3


@pytest.mark.parametrize(("name", "end", "query"), [("byte_bpe_50k.json", 2, token_store.op5_token_store), ("word_bpe_49k.json", 1, packing.op8_best_two_fit)])
def test_token_queries(spark, folder, name, end, query):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(name))
    want: dict = {}
    for d, t in corpus()[0]:
        want.setdefault(d, []).append(np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4").tobytes())
    got = query(spark, folder).collect()
    if query is token_store.op5_token_store:
        at = 0
        for r, (d, ids) in zip(sorted(got, key=lambda r: r["start"]), ((d, x) for d in sorted(want) for x in sorted(want[d])), strict=True):
            assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, at, len(ids) // 4, zlib.crc32(ids))
            at += len(ids) // 4
        return
    pieces = sorted((d, k, at // 4, len(ids[at : at + 16384]) // 4, zlib.crc32(ids[at : at + 16384])) for d, each in want.items() for ids in each for k, at in enumerate(range(0, len(ids), 16384)))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces
    bins: dict = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert sorted(sorted(x[1] for x in b) for b in bins.values()) == sorted(map(sorted, packed_one_by_one([p[3] for p in pieces], 4096)))


def packed_one_by_one(lengths, capacity):
    """Best-two-fit as it is told: bin after bin, piece after piece."""
    left, bins = sorted(lengths), []
    while left:
        own, gap = [], capacity
        while any(n <= gap for n in left):
            n = max(x for x in left if x <= gap)
            left.remove(n)
            own.append(n)
            gap -= n
        while gap and len(own) > 1:
            small = min(own)
            sums = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if small < a + b <= gap + small]
            if not sums:
                break
            best, a, b = max(sums)
            for x in (a, b):
                left.remove(x)
            own = [*own, a, b]
            own.remove(small)
            left = sorted([*left, small])
            gap += small - best
        bins.append(own)
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_fillings_are_those_of_bin_after_bin(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 40])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(60))] + [3] * rng.randrange(40)
    counts = np.bincount(lengths, minlength=capacity + 1)
    got = [sorted(n for n, c in f.items() for _ in range(c)) for times, f in packing.best_two_fit(counts, capacity) for _ in range(times)]
    assert sorted(got) == sorted(map(sorted, packed_one_by_one(lengths, capacity)))


def test_toxicity_query(spark, folder):
    rows, labels = corpus()
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, marks)
    got = toxicity.op10_toxic_segments(spark, folder).collect()
    memo = Memo(model.word_score)
    want = []
    for d, t in rows:
        score, found = toxicity.score_text(t, memo, model)
        want.append((d, zlib.crc32(str(d).encode()) % 5 == 0, round(score, 9), int(score >= 0.5), len(found)))
    assert sorted((r["doc_id"], r["held_out"], round(r["score"], 9), r["predicted"], r["n_passages"]) for r in got) == sorted(want)
    truth = {d: t for d, _, t in labels if d is not None and d < 160 and t is not None and d != 3}
    assert sum(r["predicted"] != truth[r["doc_id"]] for r in got if r["doc_id"] in truth and r["held_out"]) <= 2
    # neither the held-out labels nor the ids say anything about a score
    flipped = marks.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped).fit == model.fit


def brute_segments(scores):
    """All stretches whose own stretches all have less, and that no such stretch holds."""
    n = len(scores)
    total = [0]
    for x in scores:
        total.append(total[-1] + x)
    alone = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if all(total[b] - total[a] < total[j] - total[i] for a in range(i, j) for b in range(a + 1, j + 1) if (a, b) != (i, j)) and total[j] > total[i]]
    return sorted((i, j) for i, j in alone if not any((a, b) != (i, j) and a <= i and j <= b for a, b in alone))


@pytest.mark.parametrize("seed", range(60))
def test_segments_like_brute_force(seed):
    rng = random.Random(seed)
    scores = [rng.randrange(-4, 5) for _ in range(rng.randrange(13))]
    assert [(a, b) for a, b, _ in toxicity.maximal_segments(np.array(scores, dtype=float))] == brute_segments(scores)


def test_segments_are_found_in_linear_time():
    import time

    for scores in (np.tile([1.0, -2.0], 50_000), np.tile([3.0, -1.0], 50_000), np.concatenate((np.tile([2.0, -1.0], 30_000), np.tile([1.0, -2.0], 30_000)))):
        began = time.process_time()
        assert toxicity.maximal_segments(scores)
        assert time.process_time() - began < 2


QUERIES = {
    "license": license_scan.op1_license_scan, "pieces": wfst.op2_sentencepiece, "near": neardup.op3_near_duplicates, "quality": quality.op4_quality_rules, "store": token_store.op5_token_store,
    "prints": fingerprint.op6_fingerprints, "secrets": secret_scan.op7_secret_spans, "packing": packing.op8_best_two_fit, "toxicity": toxicity.op10_toxic_segments,
}


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_null_ids_and_repeated_rows(spark, tmp_path, name):
    empty = make(spark, str(tmp_path / "empty"), [])
    assert QUERIES[name](spark, empty).count() == 0
    rows = [(None, "x y z"), (None, None), (1, "one"), (1, "one"), (2, ""), (2, "two texts of one id")]
    got = [r["doc_id"] for r in QUERIES[name](spark, make(spark, str(tmp_path / "odd"), rows)).collect()]
    want = [] if name == "license" else [d for d, _ in rows if d is not None or name != "near"]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pipeline_of_odd_tables(spark, tmp_path):
    import corpus_pipeline

    rows, labels = corpus()
    folder = make(spark, str(tmp_path / "all"), [*rows, (None, None), (None, "")], labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, kept, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / f"stage{k}"))
        kept = spark.read.parquet(str(tmp_path / f"stage{k}"))
        assert kept.where(" or ".join(f"`{c}` <> 'own'" for c in CLASHING)).count() == 0
    left = {r["doc_id"] for r in kept.collect()}
    assert not left & {2000, 2001, 2002, 2003} and not left & {1000 + i for i in range(10)}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()} == left
    empty = make(spark, str(tmp_path / "empty"), [])
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_quotation_query(spark, tmp_path):
    rows = [(1, 0, "u", "a b c"), (1, 1, "a", "> a b c\nd"), (1, 1, "a", "> a b c\nd"), (None, 1, "u", "x"), (2, None, "u", "x"), (3, 0, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({c: F.lit("own") for c in ("key", "quote", "stretch", "body", "place", "index", "level")})
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    got = chat.op9_quotation_links(spark, str(tmp_path))
    want = sql(str(tmp_path), queries.ORACLES["op9_quotation_links"], "conversations")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall())) and got.columns == want.columns
