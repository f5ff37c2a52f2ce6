"""Retrieval: TF-IDF cosine with query expansion and taxonomy boost, its evaluation, and gaps."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from storyloom.functions import fixed, stats
from storyloom.functions import text as T
from storyloom.operators import scoring, topics
from storyloom.operators.phrases import BOUND, dictionary, mentions
from storyloom.tables import spread, written


#: The scorer that a worker used last.
_scorers: dict[str, scoring.Scorer] = {}


def rows_of(key: str, text: str, stop: list[str]) -> list[Column]:
    return [F.col(key), T.frequencies(T.terms(F.col(text), stop)).alias("terms")]


def weights(docs: DataFrame, key: str, text: str, idf: DataFrame | None = None, stop: list[str] = fixed.STOP_WORDS["retrieval"]) -> tuple[DataFrame, DataFrame]:
    """Postings (key, term, w = tf * idf) and the idf table; terms without an idf are left out.

    Texts that an idf table is made of are cut into terms once, and kept as rows of counts in the shared folder.  The
    idf of common terms is broadcast, so that most of a document's postings stay where it lies and its
    norm is added up there; that of rare ones is joined by term.
    """
    if idf is None:
        return row_weights(written(topics.term_rows(spread(docs.select(key, text)), key, text, stop)), key)
    return row_weights(docs.select(*rows_of(key, text, stop)), key, idf)


def row_weights(rows: DataFrame, key: str, idf: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The same from rows of a text each (key, terms of term and tf)."""
    counts = rows.select(key, F.explode("terms").alias("t")).select(key, "t.term", "t.tf")
    if idf is None:
        idf = written(topics.idf_table(counts, topics.corpus_size(rows), None))
    return topics.joined_idf(counts, idf).select(key, "term", (F.col("tf") * F.col("idf")).alias("w")), idf


def norms(postings: DataFrame, key: str) -> DataFrame:
    return postings.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def cosine(queries: DataFrame, docs: DataFrame, q: str, d: str) -> DataFrame:
    """(q, d, sim) of pairs with a term in common; ``queries`` and ``docs`` are postings.

    An equi-join on the term; sums of products are partly added up before they
    are shuffled.  Norms are made once.
    """
    dots = queries.select(q, "term", F.col("w").alias("wq")).join(docs.select(d, "term", "w"), "term").groupBy(q, d).agg(F.sum(F.col("wq") * F.col("w")).alias("dot"))
    nq, nd = norms(queries, q).withColumnRenamed("norm", "nq"), norms(docs, d).withColumnRenamed("norm", "nd")
    both = dots.join(nq, q).join(nd, d)
    return both.select(q, d, F.when((F.col("nq") > 0) & (F.col("nd") > 0), F.col("dot") / (F.col("nq") * F.col("nd"))).otherwise(0.0).alias("sim"))


#: What rounding to four places may lift a document by, and then some.
ROUNDING = 1e-4


def bounded(y: DataFrame, tops: DataFrame, q: str) -> DataFrame:
    """The queries' terms with what each can bring a document at most, alone and with all lesser ones, and their place from the greatest."""
    by_bound = Window.partitionBy(q).orderBy("bound", "term")  # a query's own terms
    terms = y.join(tops, "term").withColumn("bound", F.col("y") * F.col("top"))
    return terms.withColumns({"so_far": F.sum("bound").over(by_bound), "place": F.row_number().over(Window.partitionBy(q).orderBy(F.desc("bound"), "term"))})


def essential(terms: DataFrame, sure: DataFrame, q: str, d: str, k: int, least: float) -> DataFrame:
    """``terms`` with the query's floor by the scores ``sure`` (q, d, s) of some documents, and whether a document needs one of them to reach it."""
    floor = stats.top_per_group(sure, [q], [F.desc("s"), F.col(d)], k).groupBy(q).agg(F.min("s").alias("s"), F.count("*").alias("n")).where(F.col("n") >= k)
    marked = terms.join(floor.select(q, F.col("s").alias("floor")), q, "left").withColumn("floor", F.greatest(F.coalesce(F.col("floor"), F.lit(0.0)) - ROUNDING, F.lit(least - ROUNDING)))
    return marked.withColumn("essential", F.col("so_far") >= F.col("floor"))


def postings_read(marked: DataFrame) -> DataFrame:
    return marked.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("postings"), F.coalesce(F.sum(F.when(F.col("essential"), F.col("df"))), F.lit(0)).alias("read"))


def top_cosine(queries: DataFrame, docs: DataFrame, q: str, d: str, k: int = 5, least: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """The rows of ``matches(cosine(...), None, ...)`` without scoring all documents that share a term, and the postings read for it.

    A posting's impact is its share of the document's norm.  The documents of greatest impact for a query's weightiest
    terms are scored first, and the ``k``-th of them is a bound that the result can't be below.  Terms whose greatest
    impacts together stay below it can't bring a document in by themselves: only the postings of the other, essential
    terms are read, and the few documents that could still pass the bound get the rest of their terms.  Exact, and
    bounds leave room for ties after rounding.

    The second table has one row: postings (of the queries' terms, as often as queries have them) and read, of the essential ones.
    """
    nq, nd = norms(queries, q).where("norm > 0"), norms(docs, d).where("norm > 0")
    y = queries.join(nq, q).select(q, "term", F.abs(F.col("w") / F.col("norm")).alias("y")).where("y > 0")
    x = docs.join(queries.select("term").distinct(), "term", "left_semi").join(nd, d).select("term", d, F.abs(F.col("w") / F.col("norm")).alias("x"))
    x = written(x)  # postings of the queries' terms only
    tops = x.groupBy("term").agg(F.max("x").alias("top"), F.count("*").alias("df"))
    terms = bounded(y, tops, q)
    heads = stats.top_per_group(x, ["term"], [F.desc("x"), F.col(d)], k, "head")
    first = terms.where("place <= 3").select(q, "term").join(heads.select("term", d), "term").select(q, d).distinct()
    sure = first.join(x, d).join(y, [q, "term"]).groupBy(q, d).agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    marked = written(essential(terms, sure, q, d, k, least))
    rest = marked.where("not essential").groupBy(q).agg(F.max("so_far").alias("rest"))
    part = marked.where("essential").select(q, "term", "y", "floor").join(x, "term").groupBy(q, d).agg(F.sum(F.col("x") * F.col("y")).alias("s"), F.first("floor").alias("floor"))
    open_ = part.join(rest, q, "left").where(F.col("s") + F.coalesce("rest", F.lit(0.0)) >= F.col("floor")).select(q, d, "s")
    more = open_.select(q, d).join(marked.where("not essential").select(q, "term", "y"), q).join(x, ["term", d]).select(q, d, (F.col("x") * F.col("y")).alias("s"))
    sims = open_.unionByName(more).groupBy(q, d).agg(F.sum("s").alias("sim"))
    return matches(sims, None, q, d, k, least), postings_read(marked)


#: Postings of the queries' terms, as often as queries have them, up to which scoring all of them costs least.
PLAIN = 50_000_000


def best(queries: DataFrame, docs: DataFrame, idf: DataFrame, q: str, d: str, k: int = 5, least: float = 0.01) -> DataFrame:
    """The ``k`` best documents of each query by cosine: of few postings all are scored, of more the essential ones; the rows are the same."""
    size = queries.join(idf.select("term", "df"), "term").agg(F.sum("df").alias("n")).head()["n"]
    if (size or 0) <= PLAIN:
        return matches(cosine(queries, docs, q, d), None, q, d, k, least)
    return top_cosine(queries, docs, q, d, k, least)[0]


#: Postings of queries and queries that every worker may hold, so that documents are scored where they lie, at most.
HELD, QUERIES = 1_000_000, 20_000


def few(df: DataFrame, most: int) -> bool:
    return df.limit(most + 1).count() <= most


def keyed(rows: DataFrame, key: str) -> bool:
    """Whether every row has a key of its own."""
    n = rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.count_if(F.col(key).isNull()).alias("none")).head()
    return (n["most"] or 0) <= 1 and not n["none"]


def best_where_they_lie(rows: DataFrame, idf: DataFrame, queries: DataFrame, q: str, d: str, k: int, least: float, places: int, mean: float | None = None, k1: float = 1.2, b: float = 0.75, boosts: Entries | None = None) -> DataFrame:
    """(q, d, sim): each task's ``k`` best documents of each query by the rounded score, which hold the ``k`` best of all.

    ``rows`` are a document each (d, terms of term and tf), ``idf`` has the terms, ``queries`` (q, term, y) the weights by which
    scores are summed up; terms without an idf have no query, and with a column ``rest`` rows say what they add to the square of
    the norm.  With ``boosts``, whose terms' numbers a row has as ``found``, these are added.  Nothing but a task's
    best is shuffled.
    """
    sc = rows.sparkSession.sparkContext
    vocabulary, asked = idf.select("term", "idf").toArrow(), queries.select(q, "term", "y").toArrow()
    names = asked.column(q).combine_chunks().unique() if boosts is None else pa.concat_arrays([asked.column(q).combine_chunks(), boosts.q]).unique()
    known = vocabulary.column("term").combine_chunks()
    held = pc.is_in(asked.column("term").combine_chunks(), known).to_numpy(zero_copy_only=False)
    place = lambda column, among: pc.index_in(column.combine_chunks(), among).to_numpy(zero_copy_only=False)[held].astype(np.int64)
    table = (known, vocabulary.column("idf").to_numpy(), place(asked.column(q), names), place(asked.column("term"), known), asked.column("y").to_numpy()[held])
    shared, name = sc.broadcast((table, names, boosts.scorer(names) if boosts else None)), uuid.uuid4().hex

    def run(batches):
        (terms, *numbers), names, more = shared.value
        if name not in _scorers:
            _scorers.clear()
            _scorers[name] = scoring.Scorer(terms.to_pylist(), *numbers, len(names), mean, k1, b)
        scorer, best = _scorers[name], None
        step = max(1, min(200, scoring.CELLS // max(len(names), 1)))
        for batch in batches:
            best = best or scoring.Best(batch.column(0).type, len(names), k, least, places)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                scores = scorer.scores(part.column(1), part.column("rest").to_numpy(zero_copy_only=False) if rest else None)
                best.add(part.column(0), scores + more.scores(part.column("found")) if more else scores)
        if best:
            best.prune()
            yield pa.RecordBatch.from_arrays([names.take(pa.array(best.q)), best.d, pa.array(best.sim, pa.float64())], names=[q, d, "sim"])

    rest = "rest" in rows.columns
    return rows.select(d, "terms", *(["found"] if boosts else []), *(["rest"] if rest else [])).mapInArrow(run, StructType([queries.schema[q], rows.schema[d], StructField("sim", DoubleType())]))


def held_terms(rows: DataFrame, idf: DataFrame, asked: DataFrame, d: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` and the part of ``idf`` that workers hold: common terms and the queries'; rows get what the others add to the square of their norm.

    A vocabulary grows with the documents, but rare terms have few postings: only these are shuffled, and what they add up to
    is joined to the rows.
    """
    if few(idf, topics.COMMON):
        return rows, idf
    common, rare = topics.common_terms(idf)
    own = asked.select("term").distinct()
    known = written(common.unionByName(rare.join(own, "term", "left_semi")))
    postings = rows.select(d, F.explode("terms").alias("t")).select(d, "t.term", "t.tf").join(F.broadcast(known.select("term")), "term", "left_anti")
    square = F.pow(F.col("tf") * F.col("idf"), F.lit(2.0))
    rest = postings.join(rare.select("term", "idf"), "term").groupBy(d).agg(F.sum(square).alias("rest"))
    return rows.join(rest, d, "left").withColumn("rest", F.coalesce("rest", F.lit(0.0))), known


def top_documents(docs: DataFrame, questions: DataFrame, q: str, d: str, q_text: str, d_text: str, k: int = 5, least: float = 0.01, entries: DataFrame | None = None) -> DataFrame:
    """The ``k`` best documents of each question by cosine, of texts, and the boost by ``entries`` of questions if there are any.

    Questions, vocabulary and entries that a worker can hold are sent to the documents; else postings meet in joins, see ``best``.
    """
    boosts = held(entries, q) if entries is not None else None
    rows = written(topics.term_rows(spread(docs.select(d, d_text)), d, d_text, fixed.STOP_WORDS["retrieval"], boosts.terms if boosts else None))
    postings, idf = row_weights(rows, d)
    asked, _ = weights(questions, q, q_text, idf)
    asked = written(asked)
    if not (few(asked, HELD) and few(asked.select(q).distinct(), QUERIES) and keyed(rows, d)) or entries is not None and not boosts:
        if entries is not None:
            return matches(cosine(asked, postings, q, d), joined_boost(entries, docs, q, d, d_text), q, d, k, least)
        return best(asked, postings, idf, q, d, k, least)
    y = asked.join(norms(asked, q).where("norm > 0"), q).select(q, "term", (F.col("w") / F.col("norm")).alias("y"))
    rows, idf = held_terms(rows, idf, asked, d)
    return matches(best_where_they_lie(rows, idf, y, q, d, k, least, 4, boosts=boosts), None, q, d, k, least)


def query_impacts(rows: DataFrame, idf: DataFrame, asked: DataFrame, d: str) -> tuple[DataFrame, pa.Array, np.ndarray]:
    """Rows of d, terms (number, tf) and norm of the documents with a term of the queries, of which only these are kept; the terms by number, and their idf.

    Workers hold common terms and the queries'; postings of the others are shuffled for what they add to the norm, which is
    joined to the numbers.
    """
    common, rare = topics.common_terms(idf)
    own = asked.select("term").distinct()
    known = common.unionByName(rare.join(own, "term", "left_semi")).select("term", "idf").toArrow()
    terms = known.column("term").combine_chunks()
    mine = pc.is_in(terms, own.toArrow().column("term").combine_chunks()).to_numpy(zero_copy_only=False)
    order, n = np.argsort(~mine, kind="stable"), int(mine.sum())  # the queries' come first
    terms, numbers = terms.take(pa.array(order)), known.column("idf").to_numpy()[order]
    shared = rows.sparkSession.sparkContext.broadcast((terms, numbers, n))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2500):  # the terms are hashed anew for each slice
                part = batch.slice(at, 2500)
                yield pa.RecordBatch.from_arrays([part.column(0), *scoring.numbered(part.column(1), *shared.value)], names=[d, "terms", "square", "others"])

    lists = lambda name, kind: ArrayType(StructType([StructField(name, kind), StructField("tf", LongType())]))
    kind = StructType([rows.schema[d], StructField("terms", lists("number", IntegerType())), StructField("square", DoubleType()), StructField("others", lists("term", StringType()))])
    each = written(rows.select(d, "terms").mapInArrow(run, kind))
    found = each.where(F.size("terms") > 0).select(d, "terms", "square")
    if rare.isEmpty():
        return found.select(d, "terms", F.sqrt("square").alias("norm")).where("norm > 0"), terms[:n], numbers[:n]
    postings = each.where((F.size("terms") > 0) & (F.size("others") > 0)).select(d, F.explode("others").alias("t")).select(d, "t.term", "t.tf")
    rest = postings.join(rare.select("term", "idf"), "term").groupBy(d).agg(F.sum(F.pow(F.col("tf") * F.col("idf"), F.lit(2.0))).alias("rest"))
    norm = F.sqrt(F.col("square") + F.coalesce("rest", F.lit(0.0))).alias("norm")
    return written(found.join(rest, d, "left").select(d, "terms", norm).where("norm > 0")), terms[:n], numbers[:n]


def heads_where_they_lie(x: DataFrame, terms: pa.Array, idf: np.ndarray, d: str, k: int) -> DataFrame:
    """term, d, x, df: each task's ``k`` documents of greatest impact for a term, the first with the number of the task's postings."""
    shared = x.sparkSession.sparkContext.broadcast((terms, idf))

    def run(batches):
        (terms, idf), heads = shared.value, None
        for batch in batches:
            heads = heads or scoring.Heads(batch.column(0).type, len(terms), k)
            heads.add(batch.column(0), *scoring.impacts(batch.column(1), batch.column(2), idf))
        if heads:
            df = np.where(np.diff(heads.term, prepend=-1) > 0, heads.df[heads.term], 0)
            yield pa.RecordBatch.from_arrays([terms.take(pa.array(heads.term)), heads.d, pa.array(heads.x), pa.array(df)], names=["term", d, "x", "df"])

    return x.select(d, "terms", "norm").mapInArrow(run, StructType([StructField("term", StringType()), x.schema[d], StructField("x", DoubleType()), StructField("df", LongType())]))


def essential_where_they_lie(x: DataFrame, terms: pa.Array, idf: np.ndarray, marked: DataFrame, q: str, d: str, k: int, least: float, places: int = 4) -> DataFrame:
    """(q, d, sim): each task's ``k`` best documents of each query of those that reach its floor, as ``best_where_they_lie``.

    ``marked`` (q, term, y, so_far, floor, essential) are the queries' terms.
    """
    asked = marked.select(q, "term", "y", "so_far", "floor", "essential").toArrow()
    names = asked.column(q).combine_chunks().unique()
    place = lambda column, among: pc.index_in(column.combine_chunks(), among).to_numpy(zero_copy_only=False).astype(np.int64)
    number, mark = place(asked.column(q), names), asked.column("essential").to_numpy().astype(bool)
    floor, rest = np.zeros(len(names)), np.zeros(len(names))
    floor[number] = asked.column("floor").to_numpy()
    np.maximum.at(rest, number[~mark], asked.column("so_far").to_numpy()[~mark])
    shared = x.sparkSession.sparkContext.broadcast((number, place(asked.column("term"), terms), asked.column("y").to_numpy(), mark, floor, rest, names, idf))

    def run(batches):
        *numbers, names, idf = shared.value
        scorer, best = scoring.Essentials(*numbers, len(idf)), None
        step = max(1, min(200, scoring.CELLS // max(len(names), 1)))
        for batch in batches:
            best = best or scoring.Best(batch.column(0).type, len(names), k, least, places)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                best.add(part.column(0), scorer.scores(*scoring.impacts(part.column(1), part.column(2), idf), part.num_rows))
        if best:
            best.prune()
            yield pa.RecordBatch.from_arrays([names.take(pa.array(best.q)), best.d, pa.array(best.sim, pa.float64())], names=[q, d, "sim"])

    return x.select(d, "terms", "norm").mapInArrow(run, StructType([marked.schema[q], x.schema[d], StructField("sim", DoubleType())]))


def top_essential(docs: DataFrame, questions: DataFrame, q: str, d: str, q_text: str, d_text: str, k: int = 5, least: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """``top_cosine`` of texts: a document's essential postings, and the others if it can still pass the bound, are read where it lies.

    Neither postings nor pairs of a query and a document are shuffled, but for rare terms' shares of norms.  If workers can't
    hold the queries, or documents share an id, postings meet in joins.
    """
    rows = written(topics.term_rows(spread(docs.select(d, d_text)), d, d_text, fixed.STOP_WORDS["retrieval"]))
    counts = rows.select(F.explode("terms").alias("t")).select("t.term")
    idf = written(topics.idf_table(counts, topics.corpus_size(rows), None))
    asked = written(weights(questions, q, q_text, idf)[0])
    if not (few(asked, HELD) and few(asked.select(q).distinct(), QUERIES) and keyed(rows, d)):
        return top_cosine(asked, row_weights(rows, d, idf)[0], q, d, k, least)
    x, terms, numbers = query_impacts(rows, idf, asked, d)
    y = asked.join(norms(asked, q).where("norm > 0"), q).select(q, "term", F.abs(F.col("w") / F.col("norm")).alias("y")).where("y > 0")
    heads = written(heads_where_they_lie(x, terms, numbers, d, k))
    bounds = written(bounded(y, heads.groupBy("term").agg(F.max("x").alias("top"), F.sum("df").alias("df")), q))
    best = stats.top_per_group(heads, ["term"], [F.desc("x"), F.col(d)], k, "head")
    first = bounds.where("place <= 3").select("term").distinct().join(best, "term").select(d).distinct()  # at most 3 * k for each query
    all_of = bounds.withColumns({"so_far": F.lit(0.0), "floor": F.lit(0.0), "essential": F.lit(True)})
    sure = essential_where_they_lie(x.join(F.broadcast(first), d, "left_semi"), terms, numbers, all_of, q, d, k, least).withColumnRenamed("sim", "s")
    marked = written(essential(bounds, sure, q, d, k, least))
    return matches(essential_where_they_lie(x, terms, numbers, marked, q, d, k, least), None, q, d, k, least), postings_read(marked)


def top_bm25(docs: DataFrame, questions: DataFrame, q: str, d: str, q_text: str, d_text: str, k: int = 10, places: int = 6, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The ``k`` best documents of each question by BM25, rounded, ties by document."""
    rows = written(topics.term_rows(spread(docs.select(d, d_text)), d, d_text, fixed.STOP_WORDS["retrieval"]))
    n = rows.agg(F.count("*").alias("n_docs"))
    counts = rows.select(d, F.explode("terms").alias("t")).select(d, "t.term", "t.tf")
    idf = counts.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).select("term", F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    asked = written(questions.select(q, F.explode(F.array_distinct(T.terms(F.col(q_text)))).alias("term"), F.lit(1.0).alias("y")))
    idf = written(idf.join(asked.select("term").distinct(), "term", "left_semi"))  # other terms count for a document's length only
    if few(asked, HELD) and few(asked.select(q).distinct(), QUERIES) and keyed(rows, d):
        length = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + t["tf"])
        mean = rows.where(F.size("terms") > 0).agg(F.avg(length).alias("avg_len")).head()["avg_len"] or 1.0
        scores = best_where_they_lie(rows, idf, asked, q, d, k, 0.0, places, mean, k1, b).withColumnRenamed("sim", "score")
    else:
        scores = bm25(questions, docs, q, d, q_text, d_text, k1, b)
    return stats.top_per_group(scores.withColumn("score", F.round("score", places)), [q], [F.desc("score"), F.col(d)], k)


def expanded(queries: DataFrame, q: str, text: str, acronyms: DataFrame, objects: DataFrame) -> DataFrame:
    """Queries with the meanings of the acronyms in them, each time that one occurs, and with names and labels of the objects they mention."""
    capitals = F.regexp_extract_all(text, F.lit("[A-Z]{2,5}"), F.lit(0))
    a = queries.select(q, F.explode(capitals).alias("acronym")).join(acronyms.select("acronym", "meaning"), "acronym").select(q, F.col("meaning").alias("more"))
    spoken = F.replace(F.regexp_replace(F.lower("api_name"), "__[ce]", ""), F.lit("_"), F.lit(" "))
    names = objects.where(F.coalesce("label", F.lit("")) != "").select("api_name", "label", F.explode(F.array_distinct(F.array(F.lower("label"), spoken))).alias("term"))
    o = mentions(queries, q, text, names).join(names, "term").select(q, "api_name", "label").distinct().select(q, F.concat_ws(" ", "api_name", "label").alias("more"))
    extra = a.unionByName(o).groupBy(q).agg(F.array_join(F.array_sort(F.collect_list("more")), " ").alias("more"))  # a question's own words bound it
    return queries.join(extra, q, "left").withColumn(text, F.concat_ws(" ", text, "more")).drop("more")


#: The greatest boost.
BOOST = 0.15


class Entries:
    """Taxonomy entries (tax, also) of queries, on the driver to be sent to all workers: rows of q, tax, also."""

    def __init__(self, rows: pa.Table, q: str, most: float):
        pairs = list(zip(rows.column("tax").to_pylist(), rows.column("also").to_pylist()))
        self.entries, self.q, self.most = list(dict.fromkeys(pairs)), rows.column(q).combine_chunks(), most
        number = {e: i for i, e in enumerate(self.entries)}
        self.entry = np.array([number[p] for p in pairs], np.int64)
        self.terms = self.scorer(self.q.unique()).terms

    def scorer(self, names: pa.Array) -> scoring.Boosts:
        """By the places of queries in ``names``."""
        return scoring.Boosts(self.entries, pc.index_in(self.q, names).to_numpy(zero_copy_only=False).astype(np.int64), self.entry, len(names), self.most)


def entries_of(queries: DataFrame, q: str, q_text: str, terms: DataFrame) -> DataFrame:
    """q, tax, also: the taxonomy terms that a query has, once each.

    ``terms``: term and, if there is one, also (an acronym's meaning, which counts in the document as well).
    """
    also = F.lower("also") if "also" in terms.columns else F.lit(None).cast("string")
    entries = terms.select(F.lower("term").alias("tax"), also.alias("also")).where("tax <> ''").distinct()
    return written(mentions(queries, q, q_text, entries.withColumnRenamed("tax", "term")).join(entries, F.col("term") == F.col("tax")).select(q, "tax", "also"))


def held(entries: DataFrame, q: str, most: float = BOOST) -> Entries | None:
    """What all workers are sent, or none if it is more than they may hold."""
    rows = entries.where(F.col(q).isNotNull())
    size = F.sum((F.length("tax") + F.coalesce(F.length("also"), F.lit(0))).cast("long"))
    fits = few(rows, HELD) and few(rows.select(q).distinct(), QUERIES) and (rows.select("tax", "also").distinct().agg(size.alias("n")).head()["n"] or 0) <= BOUND
    return Entries(rows.toArrow(), q, most) if fits else None


def boost(queries: DataFrame, docs: DataFrame, q: str, d: str, q_text: str, d_text: str, terms: DataFrame, most: float = BOOST) -> DataFrame:
    """(q, d, boost): min(most, shared / in query * most) over taxonomy terms of the query that the document has, too.

    Only terms that some query has are looked for in documents, and boosts are made where a document lies; if workers can't
    hold the terms or documents share an id, both sides meet in a join.
    """
    entries = entries_of(queries, q, q_text, terms)
    asked = held(entries, q, most)
    if not asked or not keyed(docs, d):
        return joined_boost(entries, docs, q, d, d_text, most)
    names = asked.q.unique()
    shared, name, step = docs.sparkSession.sparkContext.broadcast((asked.scorer(names), names)), uuid.uuid4().hex, max(1, min(200, scoring.CELLS // max(len(names), 1)))

    def run(batches):
        scorer, names = shared.value
        table = dictionary(name, pa.array(scorer.terms, pa.string()))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows, numbers = table.each(part.column(1).to_pylist())
                found = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1)), pa.int32()), pa.array(numbers, pa.int32()))
                scores = scorer.scores(found)
                doc, query = np.nonzero(scores)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), part.column(0).take(pa.array(doc)), pa.array(scores[doc, query], pa.float64())], names=[q, d, "boost"])

    low = spread(docs.select(d, F.lower(F.coalesce(d_text, F.lit(""))).alias("__low")))
    return low.mapInArrow(run, StructType([queries.schema[q], docs.schema[d], StructField("boost", DoubleType())]))


def joined_boost(in_q: DataFrame, docs: DataFrame, q: str, d: str, d_text: str, most: float = BOOST) -> DataFrame:
    """The same from the queries' entries: each side is matched by itself, and the two meet on the term."""
    asked = in_q.select("tax", "also").distinct().select("tax", "also", F.explode(F.array_distinct(F.array_compact(F.array("tax", "also")))).alias("term"))
    in_d = mentions(docs, d, d_text, asked).join(asked, "term").select(d, F.col("tax").alias("found"), F.col("also").alias("found_also")).distinct()
    checks = in_q.groupBy(q).agg(F.count("*").alias("checks"))
    same = (F.col("tax") == F.col("found")) & F.col("also").eqNullSafe(F.col("found_also"))
    shared = in_q.join(in_d, same).groupBy(q, d).agg(F.count("*").alias("shared"))
    return shared.join(checks, q).select(q, d, F.least(F.lit(most), F.col("shared") / F.col("checks") * most).alias("boost"))


def matches(sims: DataFrame, boosts: DataFrame | None, q: str, d: str, k: int = 5, least: float = 0.01) -> DataFrame:
    """The ``k`` best documents of each query above ``least``, rounded to four places, ties by document."""
    both = sims if boosts is None else sims.join(boosts, [q, d], "full")
    total = F.coalesce("sim", F.lit(0.0)) + (F.lit(0.0) if boosts is None else F.coalesce("boost", F.lit(0.0)))
    rows = both.select(q, d, total.alias("sim")).where(F.col("sim") > least).withColumn("sim", F.round("sim", 4))
    return stats.top_per_group(rows, [q], [F.desc("sim"), F.col(d)], k)


def eligible(queries: DataFrame, text: str = "query") -> DataFrame:
    """Questions of ten characters or more that aren't about tools."""
    kinds = T.intents(F.col(text)) if "intents" not in queries.columns else F.col("intents")
    return queries.where((F.length(text) >= 10) & ~F.array_contains(kinds, "workspace_tooling"))


def questions(asked: DataFrame | None, spark: SparkSession) -> DataFrame:
    """query_id, query, intents: the eligible questions, or the fixed ones if there are none."""
    if asked is not None and not (rows := eligible(asked)).isEmpty():
        return rows
    rows = [(i, q, [intent]) for i, (q, intent) in enumerate(fixed.FALLBACK_QUERIES)]
    return spark.createDataFrame(rows, "query_id long, query string, intents array<string>")


def best_of(queries: DataFrame, top: DataFrame, q: str) -> DataFrame:
    return queries.select(q).join(top.groupBy(q).agg(F.max("sim").alias("best")), q, "left").withColumn("best", F.coalesce("best", F.lit(0.0)))


def evaluation(best: DataFrame) -> DataFrame:
    """How many queries are answered how well; ``no_match`` are among the poor."""
    s = F.col("best")
    return best.agg(
        F.count("*").alias("queries"), F.round(F.coalesce(F.avg(s), F.lit(0.0)), 4).alias("mean_best"),
        F.count_if(s >= 0.5).alias("excellent"), F.count_if((s >= 0.3) & (s < 0.5)).alias("good"), F.count_if((s >= 0.1) & (s < 0.3)).alias("partial"),
        F.count_if(s < 0.1).alias("poor"), F.count_if(s == 0).alias("no_match"),
    )


def exact_hits(queries: DataFrame, top: DataFrame, q: str, d: str, wanted: str = "stories") -> DataFrame:
    """Queries one of whose named stories was found."""
    named = queries.select(q, F.explode(wanted).alias(d))
    return named.join(top.select(q, d), [q, d], "left_semi").select(q).distinct()


def gaps(best: DataFrame, exact: DataFrame | None, q: str) -> DataFrame:
    """Queries whose best match is below 0.1 and that named no story found."""
    out = best.where("best < 0.1")
    return out if exact is None else out.join(exact, q, "left_anti")


def gap_terms(gap: DataFrame, queries: DataFrame, q: str, text: str, k: int = 20) -> DataFrame:
    rows = queries.join(gap.select(q), q, "left_semi").select(F.explode(T.terms(F.col(text))).alias("term"))
    return rows.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)


def coverage_by_sprint(top: DataFrame, docs: DataFrame, d: str, span: str = "sprint", good: float = 0.3) -> DataFrame:
    """First matches by sprint: how many are good and how many aren't."""
    return top.where("rank = 1").join(docs.select(d, span), d).groupBy(span).agg(F.count_if(F.col("sim") >= good).alias("well"), F.count_if(F.col("sim") < good).alias("poorly"))


def component_coverage(documented: DataFrame, queries: DataFrame, text: str = "query") -> DataFrame:
    """Components with their stories and the queries that mention one; over- and under-documented ones are marked.

    ``documented``: component, stories.  A query mentions a component if one of its terms is part of the name.
    """
    terms = queries.select(F.explode(T.terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    # "is part of" as an equi-join: names are short, so all their parts are few, and neither side is broadcast
    low = F.lower("component")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), F.length(low)), lambda i: F.transform(F.sequence(F.lit(3), F.greatest(F.length(low) - i + 1, F.lit(3))), lambda n: F.substring(low, i, n))))
    named = documented.select("component", F.explode(F.array_distinct(parts)).alias("term"))
    asked = terms.join(named, "term").groupBy("component").agg(F.sum("n").alias("queries"))
    out = documented.join(asked, "component", "left").withColumn("queries", F.coalesce("queries", F.lit(0)))
    verdict = F.when((F.col("stories") >= 20) & (F.col("queries") < 3), "over").when((F.col("stories") <= 2) & (F.col("queries") >= 2), "under")
    return out.withColumn("verdict", F.coalesce(verdict, F.lit("balanced")))


def bm25(queries: DataFrame, docs: DataFrame, q: str, d: str, q_text: str, d_text: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(q, d, score) by BM25; an extension, as a baseline beside the cosine."""
    counts = topics.term_counts(docs, d, d_text, fixed.STOP_WORDS["retrieval"])
    n = topics.corpus_size(docs)
    lengths = counts.groupBy(d).agg(F.sum("tf").alias("len"))
    mean = lengths.agg(F.avg("len").alias("avg_len"))
    df = counts.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).select("term", F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    asked = queries.select(q, F.explode(F.array_distinct(T.terms(F.col(q_text)))).alias("term"))
    rows = asked.join(df, "term").join(counts, "term").join(lengths, d).crossJoin(F.broadcast(mean))
    part = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return rows.groupBy(q, d).agg(F.sum(part).alias("score"))


def ranking_quality(top: DataFrame, relevant: DataFrame, q: str, d: str, k: int = 10) -> DataFrame:
    """Precision at 5, recall at ``k``, reciprocal rank and nDCG of each query; an extension."""
    hits = top.where(F.col("rank") <= k).join(relevant.select(q, d).distinct(), [q, d]).select(q, "rank")
    wanted = relevant.select(q, d).distinct().groupBy(q).agg(F.count("*").alias("wanted"))
    got = hits.groupBy(q).agg(F.count_if(F.col("rank") <= 5).alias("at5"), F.count("*").alias("found"), F.min("rank").alias("first"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("wanted"), F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    out = wanted.join(got, q, "left").fillna(0, ["at5", "found", "dcg"])
    return out.select(q, (F.col("at5") / 5).alias("precision_at_5"), (F.col("found") / F.col("wanted")).alias("recall"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"), (F.col("dcg") / ideal).alias("ndcg"))
