"""Canonical exact fingerprints of documents, in DataFrame functions only.

A text's canonical form is its Unicode compatibility composition, case-folded,
with every run of white space one space and none at the ends.  Its bucket is a
wide hash (two differently keyed 64-bit xxhashes) of that form; inside a bucket
the bytes are compared, and forms that differ there get numbered fingerprints.
So two fingerprints are equal if and only if the canonical forms are.

The bytes of a form are only kept for buckets with company, as far as hashes of
the originals tell; forms that come into a shared bucket otherwise are made
again for the comparison.  In the usual case texts are moved once, and up to
half of each once more to the neighbour that it lends its beginning.

Null texts count as empty.  In the order of documents rows without an id come
last, and rows of one id with different texts by a hash of the text.  Repeated
rows count once in that order and are returned again.  Very long texts are
taken whole, each in one row; other columns aren't looked at.

Very many copies of one form are one key of a join: its other side has one row
for each form and is written before, so that Spark splits the skewed one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read

#: White space of Unicode that compatibility composition leaves, after the ASCII kinds.
BLANK = r"\s\x1C-\x1F\x85   "
#: Rows of a range of ids, and bytes of a partition of texts, about.
RANGE = 500_000
PART = 128 << 20


def canonical(text: Column) -> Column:
    """The canonical form; the Unicode tables are those of the ICU library inside Spark."""
    compose = lambda c: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    folded = compose(F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True)))
    # single plain spaces stay as they are, which most are
    return F.trim(F.regexp_replace(folded, f"[{BLANK}&&[^ ]][{BLANK}]*| [{BLANK}]+", " "))


def wide_hash(form: Column) -> Column:
    half = lambda key: F.lpad(F.hex(F.xxhash64(F.lit(key), form)), 16, "0")
    return F.lower(F.concat(half(1), half(2)))


#: What names a text in a join, without nulls: those that have no id are told apart by the second.
NAME = ["id", "no_id", "text_key"]


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def in_order(keys: DataFrame, scratch: Scratch, rows: int) -> DataFrame:
    """Adds next (id, no_id, text_key, hash): the following row by descending id, round at the end."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_key").desc()]
    ranges = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE))
    dealt = scratch.table(keys.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "dealt")
    me = F.struct(*NAME, "hash")
    within = dealt.withColumn("next", F.lead(me).over(Window.partitionBy("part").orderBy(*order)))
    # one row for each range
    firsts = dealt.groupBy("part").agg(F.min_by(me, F.struct("no_id", F.bitwise_not("id"), F.bitwise_not("text_key"))).alias("first"))
    over = Window.orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("first").over(over), F.first("first").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("wrap"))
    out = within.join(F.broadcast(after), "part").withColumn("next", F.coalesce("next", "wrap"))
    return out.select("doc_id", *NAME, "n_chars", "hash", "next")


def with_edited(docs: DataFrame, chain: DataFrame, repeated: bool, parts: int) -> DataFrame:
    """``chain`` with each document's text and edited text; ``own`` and ``twin``, if there, come along.

    Texts are dealt to ``parts`` partitions, as many as their bytes need.
    """
    more = [c for c in ("own", "twin") if c in chain.columns]
    to = [f"to_{c}" for c in NAME]
    need = F.floor(F.col("n_chars") / 2).cast("int")
    asked = chain.select(*(F.col(c).alias(t) for c, t in zip(NAME, to)), *(F.col(f"next.{c}").alias(c) for c in NAME), need.alias("need"), *more)
    texts = docs.select(*NAME, "text").repartition(parts, *NAME)  # the same for both joins, so shuffled once
    lent = texts.join(asked.repartition(parts, *NAME), NAME).select(*to, F.left("text", F.col("need")).alias("lent"), *more)
    if repeated:
        lent = lent.dropDuplicates(to)
    rows = texts.join(lent.select(*(F.col(t).alias(c) for c, t in zip(NAME, to)), "lent", *more).repartition(parts, *NAME), NAME)
    n = F.char_length("text")
    edited = F.concat(F.left("text", n - F.floor(n / 2).cast("int")), "lent")
    return rows.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), *NAME, "text", edited.alias("edited"), *more)


def numbered(forms: DataFrame) -> DataFrame | None:
    """hash, form, number of forms that share a bucket with another form; None if there are none."""
    mixed = forms.groupBy("hash").agg(F.min("form").alias("a"), F.max("form").alias("z")).where("a <> z").select("hash")
    if mixed.isEmpty():
        return None
    own = forms.join(mixed, "hash", "left_semi").distinct()
    return own.withColumn("number", F.dense_rank().over(Window.partitionBy("hash").orderBy("form")) - 1)


def fingerprints(docs: DataFrame, hashed: Callable[[Column], Column] = wide_hash) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "fingerprints")
    docs = keyed(docs)
    first = docs.select("doc_id", *NAME, F.char_length("text").cast("long").alias("n_chars"), F.octet_length("text").cast("long").alias("bytes"), canonical(F.col("text")).alias("form"))
    rows = scratch.table(first.select("doc_id", *NAME, "n_chars", "bytes", hashed(F.col("form")).alias("hash")), "first")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).head()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total["bytes"] // PART))
    chain = scratch.table(in_order(rows.dropDuplicates(NAME), scratch, total["n"]), "chain")
    repeated = chain.count() < total["n"]
    scratch.drop("first", "dealt")
    # forms with company, and pairs of neighbours that come again; most don't, and these tables are small
    company = scratch.table(chain.groupBy("hash").count().where("count > 1").select("hash", F.lit(True).alias("own")), "company")
    twins = scratch.table(chain.groupBy("hash", F.col("next.hash").alias("next_hash")).count().where("count > 1").select("hash", "next_hash", F.lit(True).alias("twin")), "twins")
    owned = scratch.table(chain.withColumn("next_hash", F.col("next.hash")).join(company, "hash", "left"), "owned")
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    marked = scratch.table(owned.join(twins, ["hash", "next_hash"], "left").select("doc_id", *NAME, "n_chars", "hash", "next", flag("own"), flag("twin")), "marked")
    scratch.drop("company", "twins", "owned")

    forms = with_edited(docs, marked, repeated, parts).select("doc_id", *NAME, "own", "twin", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), canonical(F.col("text")).alias("form"), canonical(F.col("edited")).alias("edited_form"))
    forms = forms.withColumns({"hash": hashed(F.col("form")), "edited_hash": hashed(F.col("edited_form")), "unchanged": F.col("form") == F.col("edited_form")})
    kept = forms.select("doc_id", *NAME, "edited_sha256", "hash", "edited_hash", "unchanged", F.when(F.col("own"), F.col("form")).alias("form"), F.when(F.col("twin") & ~F.col("unchanged"), F.col("edited_form")).alias("edited_form"))
    table = scratch.table(kept, "forms")
    scratch.drop("marked")

    # every form but an edited one that is the same as its own original
    each = table.select(*NAME, "hash", "form", F.lit(False).alias("is_edited")).unionByName(table.where("not unchanged").select(*NAME, F.col("edited_hash").alias("hash"), F.col("edited_form").alias("form"), F.lit(True).alias("is_edited")))
    shared = each.select("hash", *NAME, "is_edited").distinct().groupBy("hash").count().where("count > 1").select("hash")
    shared = scratch.table(shared, "shared")
    seen = each.where("form is not null").select("hash", "form")
    unseen = scratch.table(each.where("form is null").join(shared, "hash", "left_semi").select(*NAME, "is_edited").distinct(), "unseen")
    if not unseen.isEmpty():
        again = chain.join(unseen.select(*NAME).distinct(), NAME, "left_semi")
        made = with_edited(docs, again, repeated, parts).select(F.explode(F.array("text", "edited")).alias("text")).select(canonical(F.col("text")).alias("form"))
        seen = seen.unionByName(made.select(hashed(F.col("form")).alias("hash"), "form"))
    number = numbered(seen)
    if number is None:
        marks = table.select("doc_id", *NAME, "edited_sha256", F.col("hash").alias("fingerprint"), F.when(F.col("unchanged"), F.col("hash")).otherwise(F.col("edited_hash")).alias("edited_fingerprint"))
    else:
        tail = lambda h, n: F.concat(F.col(h), F.when(F.col(n) > 0, F.concat(F.lit("-"), F.col(n).cast("string"))).otherwise(""))
        by_form = lambda f: number.select(F.sha2(F.col("form").cast("binary"), 256).alias(f"k_{f}"), F.col("hash").alias(f"h_{f}"), F.col("number").alias(f))
        full = with_edited(docs, chain, repeated, parts).select("doc_id", *NAME, F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), canonical(F.col("text")).alias("form"), canonical(F.col("edited")).alias("edited_form"))
        full = full.withColumns({"hash": hashed(F.col("form")), "edited_hash": hashed(F.col("edited_form")), "k1": F.sha2(F.col("form").cast("binary"), 256), "k2": F.sha2(F.col("edited_form").cast("binary"), 256)})
        full = full.join(by_form("a"), (F.col("k1") == F.col("k_a")) & (F.col("hash") == F.col("h_a")), "left").join(by_form("b"), (F.col("k2") == F.col("k_b")) & (F.col("edited_hash") == F.col("h_b")), "left")
        marks = full.select("doc_id", *NAME, "edited_sha256", tail("hash", "a").alias("fingerprint"), tail("edited_hash", "b").alias("edited_fingerprint"))
    marks = scratch.table(marks, "marks")
    scratch.drop("forms", "shared", "unseen")
    next_name = [F.col(f"next.{c}").alias(f"next_{c}") for c in NAME]
    one = marks.select(*(F.col(c).alias(f"next_{c}") for c in NAME), F.col("fingerprint").alias("next_fingerprint")).dropDuplicates([f"next_{c}" for c in NAME])
    of_next = chain.select(*NAME, "n_chars", *next_name).join(one, [f"next_{c}" for c in NAME]).select(*NAME, "n_chars", "next_fingerprint")
    out = marks.join(of_next, NAME)
    near = lambda a, b: (F.col(a) == F.col(b)).cast("double")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("fingerprint", "edited_fingerprint").alias("near_edited"), near("fingerprint", "next_fingerprint").alias("near_next"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and whether they are alike."""
    return fingerprints(read(spark, sf_dir, "documents"))
