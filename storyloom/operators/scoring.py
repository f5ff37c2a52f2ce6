"""Scores of documents for all queries where a document lies, and the best of each query in a task."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Scores of a slice of documents and pairs of a posting and a query, at most, about.
CELLS, PAIRS = 2_000_000, 2_000_000


def rounded(x: np.ndarray, places: int) -> np.ndarray:
    """Rounded half up as Spark does by the decimal digits of a double, in units of the last place."""
    y = x * 10.0**places
    out = np.floor(y + 0.5)
    for i in np.nonzero(np.abs(y - np.floor(y) - 0.5) < 1e-5)[0].tolist():
        out[i] = float(Decimal(repr(float(x[i]))).scaleb(places).quantize(Decimal(1), ROUND_HALF_UP))
    return out


class Scorer:
    """``terms`` with their idf; the queries' postings as numbers of a query and a term with a weight.

    A document's weight of a term is its share tf * idf / norm of the cosine, or with ``mean``, the mean length, BM25's.
    """

    def __init__(self, terms: list[str], idf: np.ndarray, q: np.ndarray, term: np.ndarray, weight: np.ndarray, queries: int, mean: float | None = None, k1: float = 1.2, b: float = 0.75):
        self.index, self.idf, self.queries, self.mean, self.k1, self.b = {t: i for i, t in enumerate(terms)}, idf, queries, mean, k1, b
        order = np.argsort(term, kind="stable")
        self.q, self.weight = q[order], weight[order]
        self.ends = np.cumsum(np.bincount(term, minlength=len(terms)))

    def scores(self, lists: pa.Array, rest: np.ndarray | None = None) -> np.ndarray:
        """A row of scores for each document of ``lists`` (term, tf); 0 if it has no term of the query.

        ``rest`` is what terms that aren't among the scorer's add to the square of each document's norm.
        """
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        term = np.fromiter((self.index.get(t, -1) for t in pc.struct_field(flat, "term").to_pylist()), np.int64, len(flat))
        tf = pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False).astype(np.float64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        length = np.bincount(doc, tf, len(sizes))
        doc, term, tf = doc[term >= 0], term[term >= 0], tf[term >= 0]
        if self.mean is None:
            w = tf * self.idf[term]
            norm = np.sqrt(np.bincount(doc, w * w, len(sizes)) + (0.0 if rest is None else rest))
            w = np.divide(w, norm[doc], out=np.zeros_like(w), where=norm[doc] > 0)
        else:
            w = self.idf[term] * tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length[doc] / self.mean))
        many = self.ends[term] - np.where(term > 0, self.ends[term - 1], 0)
        out = np.zeros(len(sizes) * self.queries)
        asked = np.nonzero(many)[0]
        doc, term, w, many = doc[asked], term[asked], w[asked], many[asked]
        edges = np.searchsorted(np.cumsum(many), np.arange(0, int(many.sum()) + PAIRS, PAIRS), "left")
        for lo, hi in zip(edges, [*edges[1:], len(many)]):
            n = many[lo:hi]
            if len(n):
                place = np.repeat(self.ends[term[lo:hi]] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                np.add.at(out, np.repeat(doc[lo:hi], n) * self.queries + self.q[place], np.repeat(w[lo:hi], n) * self.weight[place])
        return out.reshape(len(sizes), self.queries)


class Lists:
    """The values of each number from 0 to ``n``, one after another."""

    def __init__(self, number: np.ndarray, value: np.ndarray, n: int):
        self.value, self.ends = value[np.argsort(number, kind="stable")], np.cumsum(np.bincount(number, minlength=n))

    def of(self, numbers: np.ndarray):
        """The place in ``numbers`` and a value of the number there, in arrays of some ``PAIRS``."""
        many = self.ends[numbers] - np.where(numbers > 0, self.ends[numbers - 1], 0)
        edges = np.searchsorted(np.cumsum(many), np.arange(0, int(many.sum()) + PAIRS, PAIRS), "left")
        for lo, hi in zip(edges, [*edges[1:], len(many)]):
            n = many[lo:hi]
            yield np.repeat(np.arange(lo, hi), n), self.value[np.repeat(self.ends[numbers[lo:hi]] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


class Essentials:
    """Scores of the documents that can reach a query's floor, from the postings of essential terms; the rest is read for these only.

    A query's terms that aren't essential add up to ``rest`` at most, which is below its floor.
    """

    def __init__(self, q: np.ndarray, term: np.ndarray, weight: np.ndarray, essential: np.ndarray, floor: np.ndarray, rest: np.ndarray, terms: int):
        self.q, self.weight, self.floor, self.rest = q, weight, floor, rest
        self.essential, self.others = (Lists(term[i], i, terms) for i in (np.nonzero(essential)[0], np.nonzero(~essential)[0]))

    def scores(self, doc: np.ndarray, term: np.ndarray, x: np.ndarray, docs: int) -> np.ndarray:
        """A row of scores for each of ``docs`` documents, whose postings are given in their order; 0 if it can't reach the floor."""
        queries = len(self.floor)
        out = np.zeros(docs * queries)
        for at, i in self.essential.of(term):
            np.add.at(out, doc[at] * queries + self.q[i], x[at] * self.weight[i])
        open_ = (out.reshape(docs, queries) + self.rest >= self.floor).ravel()
        out[~open_] = 0.0
        more = np.nonzero(open_.reshape(docs, queries).any(axis=1)[doc])[0]
        for at, i in self.others.of(term[more]):
            cell = doc[more[at]] * queries + self.q[i]
            here = open_[cell]
            np.add.at(out, cell[here], x[more[at[here]]] * self.weight[i[here]])
        return out.reshape(docs, queries)


class Heads:
    """For each of ``terms`` its number of postings and the ``k`` documents of greatest impact or fewer; of equal impacts any."""

    def __init__(self, kind: pa.DataType, terms: int, k: int):
        self.k, self.df, self.floor = k, np.zeros(terms, np.int64), np.full(terms, -np.inf)
        self.term, self.x, self.d = np.zeros(0, np.int64), np.zeros(0), pa.array([], kind)

    def add(self, docs: pa.Array, doc: np.ndarray, term: np.ndarray, x: np.ndarray) -> None:
        self.df += np.bincount(term, minlength=len(self.df))
        new = np.nonzero(x > self.floor[term])[0]
        term, x, d = np.concatenate([self.term, term[new]]), np.concatenate([self.x, x[new]]), pa.concat_arrays([self.d, docs.take(pa.array(doc[new]))])
        order = np.lexsort((-x, term))
        place = np.arange(len(order)) - np.searchsorted(term[order], term[order], "left")
        order, place = order[place < self.k], place[place < self.k]
        self.term, self.x, self.d = term[order], x[order], d.take(pa.array(order))
        last = place == self.k - 1
        self.floor[self.term[last]] = self.x[last]


def lists_of(doc: np.ndarray, docs: int, **columns: pa.Array) -> pa.Array:
    """A list of structs for each of ``docs`` rows from those of ``columns``, which are in the order of ``doc``."""
    ends = np.searchsorted(doc, np.arange(docs + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


def numbered(lists: pa.Array, terms: pa.Array, idf: np.ndarray, own: int) -> list[pa.Array]:
    """Of lists (term, tf): lists (number, tf) of the first ``own`` of ``terms``, what ``terms`` add to the square of the norm, lists (term, tf) of others."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    term, tf = pc.struct_field(flat, "term"), pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False).astype(np.int64)
    number = pc.fill_null(pc.index_in(term, terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    known = np.nonzero(number >= 0)[0]
    square = np.bincount(doc[known], (tf[known] * idf[number[known]]) ** 2, len(sizes))
    mine, others = known[number[known] < own], np.nonzero(number < 0)[0]
    return [
        lists_of(doc[mine], len(sizes), number=pa.array(number[mine], pa.int32()), tf=pa.array(tf[mine])),
        pa.array(square, pa.float64()),
        lists_of(doc[others], len(sizes), term=term.take(pa.array(others)), tf=pa.array(tf[others])),
    ]


def impacts(lists: pa.Array, norm: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists (number, tf): document, number and share of the document's norm of each posting."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    doc, number = np.repeat(np.arange(len(sizes)), sizes), pc.struct_field(flat, "number").to_numpy(zero_copy_only=False).astype(np.int64)
    w = pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False) * idf[number]
    return doc, number, np.abs(w / norm.to_numpy(zero_copy_only=False)[doc])


class Boosts:
    """min(most, shared / asked * most): ``asked`` are the entries of a query, ``shared`` those that a document has, too.

    An entry is a pair of terms of which a document has one or both; ``q`` and ``entry`` say which query has which, each once.
    """

    def __init__(self, entries: list[tuple[str, str | None]], q: np.ndarray, entry: np.ndarray, queries: int, most: float):
        self.terms, self.queries, self.most, self.entries = list(dict.fromkeys(t for e in entries for t in e if t)), queries, most, len(entries)
        number = {t: i for i, t in enumerate(self.terms)}
        links = np.array([(number[t], i) for i, e in enumerate(entries) for t in e if t], np.int64).reshape(-1, 2)
        self.of_term, self.of_entry = Lists(links[:, 0], links[:, 1], len(self.terms)), Lists(entry, q, len(entries))
        self.asked = np.maximum(np.bincount(q, minlength=queries), 1)

    def scores(self, lists: pa.Array) -> np.ndarray:
        """A row of boosts for each document of ``lists``, the numbers of ``terms`` in it."""
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(doc[at] * self.entries + e for at, e in self.of_term.of(term))]))
        doc, entry = pairs // max(self.entries, 1), pairs % max(self.entries, 1)
        shared = np.zeros(len(sizes) * self.queries)
        for at, q in self.of_entry.of(entry):
            np.add.at(shared, doc[at] * self.queries + q, 1)
        return np.minimum(self.most, shared.reshape(len(sizes), self.queries) / self.asked * self.most)


class Best:
    """The ``k`` best (query, document, score) of each query above ``least``: by the rounded score, then by document."""

    def __init__(self, kind: pa.DataType, queries: int, k: int, least: float, places: int):
        self.k, self.least, self.places = k, least, places
        self.floor = np.full(queries, -np.inf)  # rounded
        self.q, self.sim, self.d, self.kind = np.zeros(0, np.int64), np.zeros(0), pa.array([], kind), kind
        self.new: list[tuple] = []
        self.size = 0

    def add(self, docs: pa.Array, scores: np.ndarray) -> None:
        # what is below the k-th by more than rounding can lift is out
        doc, q = np.nonzero((scores > self.least) & (scores * 10.0**self.places + 1 >= self.floor))
        self.new.append((q, scores[doc, q], docs.take(pa.array(doc))))
        self.size += len(q)
        if self.size > 10 * self.k * len(self.floor):
            self.prune()

    def prune(self) -> None:
        q, sim = (np.concatenate([a, *(x[i] for x in self.new)]) for i, a in enumerate((self.q, self.sim)))
        d = pa.concat_arrays([self.d, *(x[2] for x in self.new)])
        whole = rounded(sim, self.places)
        order = np.lexsort((pc.rank(d, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(), -whole, q))
        first = np.searchsorted(q[order], q[order], "left")
        order = order[np.arange(len(order)) - first < self.k]
        self.q, self.sim, self.d, self.new, self.size = q[order], sim[order], d.take(pa.array(order)), [], 0
        n = np.bincount(self.q, minlength=len(self.floor))
        least = np.full(len(self.floor), np.inf)
        np.minimum.at(least, self.q, whole[order])
        self.floor = np.where(n >= self.k, least, -np.inf)
