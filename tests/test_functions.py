"""Column functions, one case at a time."""

import statistics

import pytest
from pyspark.sql import functions as F

from storyloom.functions import stats
from storyloom.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize(
    ("function", "given", "wanted"),
    [
        (T.clean_markup, "keep end-to-end, drop -old text- now", "keep end-to-end, drop  now"),
        (lambda c: T.clean_markup(c, compat=True), "a -old- b", "a old b"),
        (T.clean_markup, "{color:#f00}x{color} <s>gone</s>\n\n\n\ny", "x \n\ny"),
        (T.wiki_to_markdown, "h2. T\n* a *b* {{c}}\n# n", "## T\n- a **b** `c`\n1. n"),
        (lambda c: T.truncated(c, 5), "ab|c\nde", "ab\\|…"),
        (T.split_camel, "MyHTTPThing_x", ["My", "HTTP", "Thing", "x"]),
        (T.object_category, "a__b__c", "managed_package"),
        (T.object_category, "X__mdt", "custom_metadata"),
        (T.intents, "which component is impacted", ["component_search", "impact_analysis"]),
        (T.intents, "hello", ["general"]),
        (T.label_bucket, "UAT-Provider", "environment"),
        (T.personas, "As a Claims Clerk, I pay. As an user who is X, no.", ["claims clerk"]),
        (T.acronyms, "The PHI and AND NPIX", ["PHI", "NPIX"]),
        (T.title_gerunds, "Tracking (posting) during sing", ["tracking", "posting"]),
        (T.epic_of, "Feature: pay all; rest", "pay all"),
        (T.lenient_int, " 1,234 ", 1234),
        (T.lenient_int, "3.0", 0),
        (T.lenient_float, "1,000.5", 1000.5),
        (T.story_ids, "AB-1 B2-33 AB-1 A-9 x-1", ["AB-1", "B2-33"]),
        (T.document_bigrams, "the claim system pays provider claims of provider claims", ["pays provider", "provider claims"]),
        (T.estimated_tokens, None, None),
    ],
)
def test_text(spark, function, given, wanted):
    assert one(spark, function(F.lit(given).cast("string") if given is not None else F.lit(None).cast("int"))) == wanted


def test_expansions(spark):
    got = one(spark, T.expansions(F.lit("PHI (Protected Health Information) and Explanation Of Benefits (EOB)")))
    assert [tuple(x) for x in got] == [("PHI", "Protected Health Information"), ("EOB", "Explanation Of Benefits")]


@pytest.mark.parametrize("n", [4, 10])
@pytest.mark.parametrize("size", [2, 3, 5, 19, 40])
def test_exclusive_quantiles(spark, n, size):
    values = [(x * 7919 % 97) // 3 for x in range(size)]
    got = stats.exclusive_quantiles(spark.createDataFrame([(float(v),) for v in values], "x double"), "x", n).orderBy("q").collect()
    assert [r["value"] for r in got] == pytest.approx(statistics.quantiles(values, n=n))


def test_exclusive_quantiles_by_group(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 3.0), (None, 4.0)], "g string, x double")
    got = stats.exclusive_quantiles(rows, "x", 4, ["g"]).collect()
    assert {r["g"] for r in got} == {"a", None} and len(got) == 6
