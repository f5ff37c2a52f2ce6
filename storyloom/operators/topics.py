"""Topics and vocabulary mined from texts: TF-IDF, n-grams, acronyms, personas, processes, integrations, objects."""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from storyloom.functions import fixed, stats
from storyloom.functions import text as T
from storyloom.operators.phrases import dictionary, mentions, occurrences
from storyloom.tables import written

#: Plurals that are broadcast, at most.
PLURALS = 500_000
#: Words of lower-cased texts.
WORDS = re.compile("[a-zA-Z]{2,}")


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", stop: list[str] = fixed.STOP_WORDS["base"], keep: list[str] | None = None) -> DataFrame:
    """key, term, tf of each row of ``docs``, of which ``key`` is the key; ``keep`` are further columns of the document.

    A document's terms are counted where it lies, so nothing is shuffled by document.
    """
    return docs.select(key, *(keep or []), F.explode(T.frequencies(T.terms(F.col(text), stop))).alias("t")).select(key, *(keep or []), "t.term", "t.tf")


def term_rows(docs: DataFrame, key: str, text: str, stop: list[str], named: list[str] | None = None) -> DataFrame:
    """key, terms (term, tf) of each row of ``docs``: the counts of ``term_counts`` as one array, found in Arrow batches.

    With ``named``, lower-cased terms that workers can hold, also found: the numbers of those that stand in the text.
    """
    import pyarrow as pa

    kind = pa.struct([("term", pa.string()), ("tf", pa.int64())])
    left_out = frozenset(stop)
    shared, name = docs.sparkSession.sparkContext.broadcast(pa.array(named, pa.string())) if named is not None else None, uuid.uuid4().hex

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, ends, terms, tfs = batch.slice(at, 500), [0], [], []
                texts = part.column(1).to_pylist()
                for low in texts:
                    for term, tf in Counter(WORDS.findall(low or "")).items():
                        if len(term) > 2 and term not in left_out:
                            terms.append(term)
                            tfs.append(tf)
                    ends.append(len(terms))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(tfs, pa.int64())], fields=list(kind)))
                if shared:
                    rows, numbers = dictionary(name, shared.value).each([low or "" for low in texts])
                    found = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(len(texts) + 1)), pa.int32()), pa.array(numbers, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, *([found] if shared else [])], names=names)

    schema = StructType([docs.schema[key], StructField("terms", ArrayType(StructType([StructField("term", StringType()), StructField("tf", LongType())])))])
    if shared:
        schema.add("found", ArrayType(IntegerType()))
    names = schema.names
    return docs.select(key, F.lower(text).alias("__low")).mapInArrow(run, schema)


def idf_table(counts: DataFrame, n: DataFrame, noise: float | None = 0.8) -> DataFrame:
    """term, df, idf = ln(N / (1 + df)); terms in more than ``noise`` of the documents are left out."""
    return with_idf(counts.groupBy("term").agg(F.count("*").alias("df")), n, noise).select("term", "df", "idf")


#: Terms that are broadcast as the common ones of a larger vocabulary, at most; they have all but some hundredths of the postings.
COMMON = 400_000


def common_terms(idf: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The ``most`` terms or fewer in most documents, and the others, parted by df.

    Different numbers of documents are few: their sum is at most that of the postings, so they grow with its root.
    """
    n, least = 0, None
    for r in idf.groupBy("df").agg(F.count("*").alias("n")).orderBy(F.desc("df")).collect():
        n += r["n"]
        if n > (COMMON if most is None else most):
            break
        least = r["df"]
    common = F.col("df") >= least if least is not None else F.lit(False)
    return idf.where(common), idf.where(~common)


def joined_idf(counts: DataFrame, idf: DataFrame, most: int | None = None) -> DataFrame:
    """``counts`` with their idf: common terms meet it where the documents lie, only the postings of the others are shuffled."""
    common, rare = common_terms(idf.select("term", "df", "idf"), most)
    here = counts.join(F.broadcast(common.select("term", "idf")), "term")
    if rare.isEmpty():
        return here
    return here.unionByName(counts.join(F.broadcast(common.select("term")), "term", "left_anti").join(rare.select("term", "idf"), "term"))


def with_idf(terms: DataFrame, n: DataFrame, noise: float | None = 0.8) -> DataFrame:
    """``terms`` (term, df, ...) with their idf, those in more than ``noise`` of the documents left out."""
    out = terms.crossJoin(F.broadcast(n)).withColumn("idf", F.log(F.col("n_docs") / (1 + F.col("df"))))
    return (out.where(F.col("df") <= noise * F.col("n_docs")) if noise is not None else out).drop("n_docs")


def corpus_size(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n_docs"))


def fold_plurals(counts: DataFrame) -> DataFrame:
    """Terms in -s, of four letters or more, whose singular occurs go under the singular."""
    # which terms fold is found on the vocabulary, so that rows of terms that don't never meet on one key
    vocabulary = written(counts.select("term").distinct())
    plurals = vocabulary.where(F.endswith("term", F.lit("s")) & (F.length("term") > 3)).select(F.col("term").alias("__plural"), F.left("term", F.length("term") - 1).alias("singular"))
    plurals = written(plurals.join(vocabulary.select(F.col("term").alias("singular")), "singular"))
    small = plurals.limit(PLURALS + 1).count() <= PLURALS
    joined = counts.join(F.broadcast(plurals) if small else plurals, F.col("term") == F.col("__plural"), "left")
    folded = joined.withColumn("term", F.coalesce("singular", "term")).drop("singular", "__plural")
    return folded.groupBy(*(c for c in counts.columns if c != "tf")).agg(F.sum("tf").alias("tf"))


def top_terms(counts: DataFrame, n: DataFrame, k: int = 30, noise: float | None = 0.8) -> DataFrame:
    """Terms by their sum of tf * idf over the corpus; df and tf come from one aggregate of one scan."""
    sums = counts.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    return with_idf(sums, n, noise).select("term", "df", "tf", F.round(F.col("tf") * F.col("idf"), 4).alias("score")).orderBy(F.desc("score"), "term").limit(k)


def top_terms_by(counts: DataFrame, n: DataFrame, group: str, k: int = 5, noise: float | None = 0.8) -> DataFrame:
    """The best terms of each group, with the corpus's idf, which is summed up from the groups'."""
    own = counts.groupBy(group, "term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    idf = with_idf(own.groupBy("term").agg(F.sum("df").alias("df")), n, noise).select("term", "idf")
    sums = own.join(idf, "term")
    return stats.top_per_group(sums.select(group, "term", F.round(F.col("tf") * F.col("idf"), 4).alias("score")), [group], [F.desc("score"), F.col("term")], k)


def clusters(counts: DataFrame, idf: DataFrame, key: str = "doc_id", least: int = 3, k: int = 15, examples: int = 5) -> DataFrame:
    """Documents by their best term (positive scores only, ties by term); terms of ``least`` documents or more."""
    scored = joined_idf(counts, idf).withColumn("score", F.round(F.col("tf") * F.col("idf"), 6)).where("score > 0")
    best = scored.groupBy(key).agg(F.min_by("term", F.struct(-F.col("score"), F.col("term"))).alias("term"))
    sizes = best.groupBy("term").agg(F.count("*").alias("docs")).where(F.col("docs") >= least).orderBy(F.desc("docs"), "term").limit(k)
    first = stats.top_per_group(best.join(F.broadcast(sizes), "term"), ["term"], [F.col(key)], examples)
    return first.groupBy("term", "docs").agg(F.array_sort(F.collect_list(key)).alias("examples"))


def supported(pairs: DataFrame, value: str, key: str, least: int, k: int | None = None, examples: int = 5, ordinal: str | None = None) -> DataFrame:
    """Values found in ``least`` keys or more, with how many and the first keys.

    Pairs are made distinct first; the examples are ranked, not gathered.  Of equal numbers the ``k`` first by value are
    taken, or, with an ``ordinal``, those that come first in the corpus.
    """
    each = pairs.select(value, key).distinct()
    counts = each.groupBy(value).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    if k and ordinal:
        place = pairs.groupBy(value).agg(F.min(ordinal).alias("__first"))
        counts = counts.join(place, value).orderBy(F.desc("n"), "__first", value).limit(k).drop("__first")
    elif k:
        counts = counts.orderBy(F.desc("n"), value).limit(k)
    first = stats.top_per_group(each.join(counts, value), [value], [F.col(key)], examples)
    return first.groupBy(value, "n").agg(F.array_sort(F.collect_list(key)).alias("examples"))


#: Different bigrams that a task holds before it hands them on, about, and bytes of texts for each part of the sums.
BIGRAMS, PER_PART = 200_000, 8 << 20


def bigram_counts(docs: DataFrame, text: str, stop: list[str] = fixed.STOP_WORDS["export"]) -> DataFrame:
    """bigram, n: in how many rows of a stretch it stands; the pairs of ``T.document_bigrams``, counted in Arrow batches."""
    import pyarrow as pa

    left_out = frozenset(stop)

    def run(batches):
        counts: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["bigram", "n"])
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                for low in batch.slice(at, 100).column(0).to_pylist():
                    words = [w if len(w) > 2 and w not in left_out else None for w in WORDS.findall(low or "")]
                    counts.update({f"{a} {b}" for a, b in zip(words, words[1:]) if a and b})
                    if len(counts) >= BIGRAMS:
                        yield out()
                        counts.clear()
        yield out()

    return docs.select(F.lower(text).alias("__low")).mapInArrow(run, "bigram string, n long")


def bigram_support(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 5, k: int = 100) -> DataFrame:
    """Bigrams by the documents (rows) that have them; parts of the sums grow in number with the texts, not in size."""
    size = docs.agg(F.sum(F.octet_length(text).cast("long")).alias("n")).head()["n"] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PER_PART))
    counts = bigram_counts(docs, text).repartition(parts, "bigram")
    return counts.groupBy("bigram").agg(F.sum("n").alias("docs")).where(F.col("docs") >= least).orderBy(F.desc("docs"), "bigram").limit(k)


def recurring_bigrams(rows: DataFrame, text: str = "text", least: int = 2, k: int = 20) -> DataFrame:
    """Neighbouring words of four letters or more, by occurrences."""
    low = F.filter(T.words(F.lower(text)), lambda w: F.length(w) > 3)
    return rows.select(F.explode(T.pairs(low)).alias("bigram")).groupBy("bigram").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "bigram").limit(k)


def acronym_support(docs: DataFrame, key: str, text: str, least: int = 3, k: int | None = None) -> DataFrame:
    return supported(docs.select(F.col(key), F.explode(T.acronyms(F.col(text))).alias("acronym")), "acronym", key, least, k)


def acronym_meanings(docs: DataFrame, text: str, order: str, objects: DataFrame | None = None) -> DataFrame:
    """acronym, meaning, source: an object's label by its initials, else the last expansion in the texts."""
    found = docs.select(F.col(order), F.posexplode(T.expansions(F.col(text))).alias("at", "e"))
    inline = found.groupBy(F.col("e.acronym").alias("acronym")).agg(F.max_by("e.expansion", F.struct(order, "at")).alias("inline"))
    if objects is None:
        return inline.select("acronym", F.col("inline").alias("meaning"), F.lit("inline").alias("source"))
    named = objects.where("initials is not null").groupBy(F.col("initials").alias("acronym")).agg(F.min_by("label", "api_name").alias("label"))
    both = named.join(inline, "acronym", "full")
    return both.select("acronym", F.coalesce("label", "inline").alias("meaning"), F.when(F.col("label").isNotNull(), "object").otherwise("inline").alias("source"))


def persona_support(docs: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    return supported(docs.select(F.col(key), F.explode(T.personas(F.col(text))).alias("persona")), "persona", key, least)


def process_support(stories: DataFrame, least: int = 3, order: str = "story_id") -> DataFrame:
    """Processes named by epics, labels of several words and gerunds of titles; the source is the first to name one."""
    epic = F.filter(F.array(F.lower(F.trim(F.coalesce("epic", F.lit(""))))), lambda e: e != "")
    spaced = F.transform(T.split_values(F.coalesce("labels", F.lit(""))), lambda x: F.filter(F.split(F.regexp_replace(x, r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " "), r"\s+"), lambda w: w != ""))
    labels = F.transform(F.filter(spaced, lambda w: F.size(w) >= 2), lambda w: F.lower(F.array_join(w, " ")))
    steps = F.array(F.struct(F.lit("epic").alias("source"), epic.alias("names")), F.struct(F.lit("label").alias("source"), labels.alias("names")), F.struct(F.lit("title_gerund").alias("source"), T.title_gerunds(F.col("summary")).alias("names")))
    rows = stories.select("story_id", F.col(order).alias("__o"), F.posexplode(steps).alias("step", "s")).select("story_id", "__o", "step", "s.source", F.explode("s.names").alias("process"))
    source = rows.groupBy("process").agg(F.min_by("source", F.struct("__o", "step")).alias("source"))
    return supported(rows, "process", "story_id", least).join(source, "process")


def integration_support(docs: DataFrame, key: str, text: str, objects: DataFrame | None = None, least: int = 2, near: int = 5) -> DataFrame:
    """Platform terms within five words of a word about integrations, and namespaces of objects in the text."""
    trim = lambda w: F.regexp_replace(w, r"^[.,;:()\[\]\"']+|[.,;:()\[\]\"']+$", "")
    names = F.create_map(*(F.lit(x) for t in fixed.ECOSYSTEM_TERMS for x in (t.lower(), t)))

    def terms_near(low: Column) -> Column:
        contexts = F.filter(F.sequence(F.lit(1), F.size(low)), lambda i: F.element_at(low, i).isin(*fixed.INTEGRATION_WORDS))
        around = F.flatten(F.transform(contexts, lambda i: F.slice(low, F.greatest(i - near, F.lit(1)), F.least(i, F.lit(near + 1)) + near)))
        return F.array_distinct(F.filter(F.transform(around, lambda w: F.try_element_at(names, trim(w))), lambda n: n.isNotNull()))

    found = T.let(F.split(F.lower(F.col(text)), r"\s+"), terms_near)
    pairs = docs.where(F.rlike(F.lower(text), F.lit("|".join(t.lower() for t in fixed.ECOSYSTEM_TERMS)))).select(F.col(key), F.explode(found).alias("integration"))
    if objects is not None:
        spaces = objects.where("namespace is not null").select(F.col("namespace").alias("integration")).distinct()
        named = mentions(docs, key, text, spaces.withColumnRenamed("integration", "term"))
        pairs = pairs.unionByName(named.join(spaces.withColumn("term", F.lower("integration")), "term").select(key, "integration"))
    return supported(pairs, "integration", key, least)


def object_mentions(docs: DataFrame, objects: DataFrame, key: str = "story_id", text: str = "text", span: str = "sprint") -> DataFrame:
    """key, span, api_name of every object that a text names.

    One-word variants (five letters, no filler) are looked for as whole words, longer
    ones (eight letters) as phrases; see ``phrases.mentions``.
    """
    variants = written(objects.select("api_name", F.explode("search_variants").alias("variant")))
    # words of a text are letters only, and lower-cased ones here
    single = variants.where(F.rlike("variant", F.lit("^[a-z]+$")) & (F.length("variant") >= 5) & ~F.col("variant").isin(*fixed.COMMON_OBJECT_WORDS))
    phrase = variants.where(F.contains("variant", F.lit(" ")) & (F.length("variant") >= 8))
    each = None
    for own, words in ((single, True), (phrase, False)):
        own = own.withColumn("term", F.lower("variant"))
        found = occurrences(docs, key, text, own, keep=[span], words=words).join(own, "term").select(key, span, "api_name")
        each = found if each is None else each.unionByName(found)
    return each.distinct()


def object_references(docs: DataFrame, objects: DataFrame, key: str = "story_id", text: str = "text", span: str = "sprint") -> DataFrame:
    """api_name, label, stories and sprints that name it; objects that nobody names have 0."""
    counts = object_mentions(docs, objects, key, text, span).groupBy("api_name").agg(F.count_distinct(key).alias("stories"), F.count_distinct(span).alias("sprints"))
    return objects.select("api_name", "label").join(counts, "api_name", "left").fillna(0, ["stories", "sprints"])


def object_story_index(docs: DataFrame, objects: DataFrame, key: str = "story_id", text: str = "text", span: str = "sprint") -> tuple[DataFrame, DataFrame]:
    """The cross-lookup of objects and stories, in two tables.

    First label, api_name, stories, sprints: one object for each label, see ``by_label``; then label, api_name and a
    row for each story that names the object, however many.
    """
    one = by_label(object_references(docs, objects, key, text, span))
    pairs = object_mentions(docs, objects, key, text, span).select("api_name", key, span).join(one.select("api_name", "label"), "api_name")
    return one, pairs.select("label", "api_name", key, span)


def by_label(references: DataFrame) -> DataFrame:
    """One object for each label: the most named, ties by name."""
    return references.groupBy("label").agg(F.min_by(F.struct("api_name", "stories", "sprints"), F.struct(-F.col("stories"), F.col("api_name"))).alias("o")).select("label", "o.*")


def classified(terms: DataFrame, acronyms: DataFrame, objects: DataFrame, processes: DataFrame, personas: DataFrame, integrations: DataFrame) -> DataFrame:
    """term and category: the first of acronym, object, process, persona, integration that knows it, else generic."""
    low = F.lower("term")
    known = (
        acronyms.select(F.lower("acronym").alias("low"), F.lit(0).alias("rank"), F.lit("acronym").alias("category"))
        .unionByName(objects.select(F.explode("search_variants").alias("low"), F.lit(1).alias("rank"), F.lit("object").alias("category")))
        .unionByName(processes.select(F.lower("process").alias("low"), F.lit(2).alias("rank"), F.lit("process").alias("category")))
        .unionByName(personas.select(F.lower("persona").alias("low"), F.lit(3).alias("rank"), F.lit("persona").alias("category")))
        .unionByName(integrations.select(F.lower("integration").alias("low"), F.lit(4).alias("rank"), F.lit("integration").alias("category")))
    )
    best = known.groupBy("low").agg(F.min_by("category", "rank").alias("category"))
    return terms.withColumn("low", low).join(best, "low", "left").select("term", F.coalesce("category", F.lit("generic")).alias("category"))
