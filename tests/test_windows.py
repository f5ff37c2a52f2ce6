"""Terms found by hashes of windows against plain search."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storyloom.operators import phrases, topics, windows


@pytest.mark.parametrize("seed", range(40))
def test_windows_like_plain_search(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(windows, "CHARS", rng.choice([4, 20, 1000]))
    some = lambda least, most: "".join(rng.choice("ab é🙂") for _ in range(rng.randint(least, most)))
    terms = sorted({some(1, 14) for _ in range(60)})
    texts = [some(0, 120) for _ in range(9)]
    table = windows.Dictionary(pa.array(terms))
    for words in (False, True):
        got = set()
        for numbers, pieces, more in table.slices(texts):
            text, term = table.found(pieces, more if words else None)
            got |= {(numbers[i], terms[j]) for i, j in zip(text.tolist(), term.tolist())}
        whole = lambda t, x: re.search(f"(?<![a-zA-Z]){re.escape(t)}(?![a-zA-Z])", x) if words else t in x
        assert got == {(i, t) for i, x in enumerate(texts) for t in terms if whole(t, x)}


def test_large_dictionaries_keep_only_what_stands_in_texts(spark):
    """Terms that share their grams with every text don't meet it: a part of the dictionary gives pairs of the result only."""
    terms = spark.range(3000).select(F.concat(F.lit("the word w"), F.col("id").cast("string"), F.lit(" x")).alias("term"))
    texts = spark.range(200).select("id", F.concat(F.lit("The word w"), F.col("id").cast("string"), F.lit(" x the word of")).alias("text"))
    found = phrases.occurrences(texts, "id", "text", terms, bound=2000)
    assert found.count() == 200 and "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_one_word_variants_stand_alone(spark):
    docs = spark.createDataFrame([("S1", "one", "the claimline is"), ("S2", "one", "claimlines"), ("S3", "two", "xclaimline claimline2 é")], "story_id string, sprint string, text string")
    objects = spark.createDataFrame([("A__c", "Claim Line", ["claimline"]), ("B__c", "B", ["claimline2"])], "api_name string, label string, search_variants array<string>")
    assert sorted(map(tuple, topics.object_mentions(docs, objects).collect())) == [("S1", "one", "A__c"), ("S3", "two", "A__c")]
