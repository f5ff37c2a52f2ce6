"""Which terms of a dictionary stand in which texts, in one pass over each text."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from storyloom.tables import written

#: Characters of a dictionary whose hashes each worker holds, at most: some 10 bytes a character for terms of ten.
BOUND = 16_000_000
#: Texts that are looked through at a time.
TEXTS = 500
#: Characters of a part of a dictionary, at least.
LEAST = 1_000
#: Characters of a gram, and terms of a hot gram that are looked for together, about.
GRAM, PART = 3, 64
#: Grams that are sent to all workers, so that texts name these only, at most.
GRAMS = 500_000

#: The tables that a worker used last, by the name of their dictionary.
_built: dict[str, object] = {}


def dictionary(name: str, terms):
    """The hashed terms; made once in a worker."""
    from storyloom.operators.windows import Dictionary

    if name not in _built:
        _built.clear()
        _built[name] = Dictionary(terms)
    return _built[name]


def by_windows(low: DataFrame, key: str, terms: DataFrame, keep: list[str] = [], words: bool = False) -> DataFrame:
    """key, ``keep``, term of the lower-cased texts ``__low``, by hashes of their windows; the terms are held by each worker."""
    import pyarrow as pa

    listed = terms.select("term").toArrow().column("term").combine_chunks()
    shared, name = low.sparkSession.sparkContext.broadcast(listed), uuid.uuid4().hex

    def run(batches):
        table = dictionary(name, shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                for numbers, pieces, more in table.slices(part.column(0).to_pylist()):
                    text, term = table.found(pieces, more if words else None)
                    rows = pa.array(numbers, pa.int64()).take(pa.array(text, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*(part.column(i).take(rows) for i in range(1, part.num_columns)), table.terms.take(pa.array(term, pa.int64()))], names=[key, *keep, "term"])

    return low.select("__low", key, *keep).mapInArrow(run, StructType([*(low.schema[c] for c in (key, *keep)), StructField("term", StringType())]))


def grams(low: DataFrame, key: str, sizes: list[int], only: list[str] | None = None) -> DataFrame:
    """key, gram: the different grams of each text of the given sizes, or those of them in ``only``."""
    import pyarrow as pa

    shared = low.sparkSession.sparkContext.broadcast(frozenset(only)) if only is not None else None

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                here = {text[k : k + n] for n in sizes for k in range(len(text) - n + 1)}
                here = here & shared.value if shared else here
                rows += [i] * len(here)
                found += here
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], names=[key, "gram"])

    return low.select(key, "__low").mapInArrow(run, StructType([low.schema[key], StructField("gram", StringType())]))


def by_rarest_gram(low: DataFrame, key: str, terms: DataFrame, part: int = PART, most: int = GRAMS) -> DataFrame:
    """key, term for a dictionary that is an index of its own; beside hashes for short texts only, as each text meets all terms of its grams.

    Each term is looked for in the texts that have its rarest gram, by the numbers of texts that have each; a term
    shorter than a gram is one.  A gram that very many terms chose is split into parts, each a key of the join.
    """
    cuts = F.when(F.length("term") < GRAM, F.array("term")).otherwise(F.transform(F.sequence(F.lit(1), F.length("term") - GRAM + 1), lambda i: F.substring("term", i, F.lit(GRAM))))
    asked = written(terms.select("term", F.explode(F.array_distinct(cuts)).alias("gram")))
    sizes = [r["n"] for r in asked.select(F.length("gram").alias("n")).distinct().collect()]  # three at most
    counts = grams(low, key, sizes).groupBy("gram").agg(F.count("*").alias("texts"))
    held = asked.join(counts, "gram", "left")
    # a term with a gram that no text has is in none
    rarest = held.groupBy("term").agg(F.min_by("gram", F.struct(F.coalesce("texts", F.lit(0)), F.col("gram"))).alias("gram"), (F.count("*") == F.count("texts")).alias("all")).where("all")
    chosen = written(rarest.select("term", "gram"))
    parts = written(chosen.groupBy("gram").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")))
    few = parts.select("gram").limit(most + 1).collect() if parts.limit(most + 1).count() <= most else None
    named = grams(low, key, sizes, [r["gram"] for r in few] if few is not None else None)
    spread = named.join(parts, "gram").select(key, "gram", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    lists = chosen.join(parts, "gram").withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int")).groupBy("gram", "part").agg(F.collect_list("term").alias("terms"))
    met = spread.join(lists, ["gram", "part"]).select(F.col(key).alias("__key"), F.explode("terms").alias("term"))
    return low.join(met, F.col(key).eqNullSafe(F.col("__key"))).where(F.contains("__low", F.col("term"))).select(key, "term")


def occurrences(texts: DataFrame, key: str, text: str, terms: DataFrame, bound: int = BOUND, keep: list[str] = [], words: bool = False) -> DataFrame:
    """``mentions`` with further columns ``keep`` of the texts, for each row of them; ``words``: no ASCII letter stands before or after the term."""
    terms = terms.select(F.lower("term").alias("term")).where("term <> ''").distinct()
    low = texts.select(key, *keep, F.lower(F.coalesce(text, F.lit(""))).alias("__low"))
    size = terms.agg(F.coalesce(F.sum(F.length("term").cast(LongType())), F.lit(0)).alias("n")).head()["n"]
    if not size:
        return low.select(key, *keep, F.lit("").alias("term")).limit(0)
    passes = -(-size // max(bound, LEAST))
    if passes == 1:
        return by_windows(low, key, terms, keep, words)
    terms = written(terms.withColumn("__pass", F.pmod(F.xxhash64("term"), F.lit(passes))))
    return reduce(DataFrame.unionByName, (by_windows(low, key, terms.where(F.col("__pass") == i), keep, words) for i in range(passes)))


def mentions(texts: DataFrame, key: str, text: str, terms: DataFrame, bound: int = BOUND) -> DataFrame:
    """key, term: the lower-cased ``terms`` that stand anywhere in a text, case aside.

    All windows of a text that are as long as some term are hashed at once and looked up, and what is found is compared;
    only pairs that are in the result leave the task.  A dictionary of more than ``bound`` characters, which are counted
    first, is split, and the texts are read once for each part.  Null texts are empty, null and empty terms stand nowhere.
    """
    return occurrences(texts, key, text, terms, bound).distinct()
