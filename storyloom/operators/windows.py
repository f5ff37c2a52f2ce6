"""Terms of a dictionary in texts by hashes of windows: numpy in slices of bounded size, compared as they are in the end."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that are hashed at a time, about.
CHARS = 1 << 19
#: Windows of this size are looked up first; terms that are shorter are looked up whole.
PREFIX = 8
#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Hashes:
    """Polynomial hashes of any window of a line of characters."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, b, np.uint64)))) for b in (BASE, pow(BASE, -1, 1 << 64)))

    def sums(self, line: np.ndarray) -> np.ndarray:
        self.powers(len(line) + 1)
        return np.concatenate(([np.uint64(0)], np.cumsum((line.astype(np.uint64) + np.uint64(1)) * self.up[: len(line)])))

    def of(self, sums: np.ndarray, starts, ends, at) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.down[at]


class Marks:
    """Whether a hash may be among some: one look at a table that has eight places for each."""

    def __init__(self, hashes: np.ndarray):
        bits = max(10, int(8 * max(len(hashes), 1)).bit_length())
        self.shift, self.table = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.table[self.place(hashes)] = True

    def place(self, h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift

    def may(self, h: np.ndarray) -> np.ndarray:
        return self.table[self.place(h)]


class Dictionary:
    """The distinct, non-empty ``terms``; some 40 bytes a term besides their characters."""

    def __init__(self, terms: pa.Array):
        self.terms, self.hashes = terms, Hashes()
        sizes = pc.utf8_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
        self.longest = int(sizes.max(initial=0))
        whole, heads = np.zeros(len(terms), np.uint64), np.zeros(len(terms), np.uint64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(terms):  # as many terms as make a slice
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARS, "right")))
            line = codes("".join(terms.slice(at, to - at).to_pylist()))
            sums, e = self.hashes.sums(line), np.cumsum(sizes[at:to])
            s = e - sizes[at:to]
            whole[at:to] = self.hashes.of(sums, s, e, s)
            heads[at:to] = self.hashes.of(sums, s, s + np.minimum(sizes[at:to], PREFIX), s)
            at = to
        # by length: sorted hashes, and which term each is
        self.by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(sizes).tolist():
            own = np.nonzero(sizes == n)[0]
            order = own[np.argsort(whole[own], kind="stable")]
            self.by[n] = whole[order], order
        self.long = [n for n in self.by if n >= PREFIX]
        self.heads = np.unique(heads[sizes >= PREFIX])
        self.marks = {n: Marks(self.by[n][0]) for n in self.by if n < PREFIX}
        self.head_marks, self.long_marks = Marks(self.heads), {n: Marks(self.by[n][0]) for n in self.long}

    def candidates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, start, term and length of each window whose hash is a term's; the texts lie one after another."""
        line = codes("".join(texts))
        sums, ends = self.hashes.sums(line), np.cumsum([len(t) for t in texts])
        found = []

        def look(starts: np.ndarray, n: int, marks: Marks) -> None:
            starts = starts[: np.searchsorted(starts, len(line) - n, "right")]
            h = self.hashes.of(sums, starts, starts + n, starts)
            there = marks.may(h)
            starts, h = starts[there], h[there]
            own, names = self.by[n]
            first, last = np.searchsorted(own, h, "left"), np.searchsorted(own, h, "right")
            many = last - first  # terms of one hash are all looked at
            if not many.any():
                return
            starts, first, many = starts[many > 0], first[many > 0], many[many > 0]
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            starts, terms = np.repeat(starts, many), names[np.repeat(first, many) + nth]
            text = np.searchsorted(ends, starts, "right")
            inside = starts + n <= ends[text]
            found.append((text[inside], starts[inside], terms[inside], np.full(int(inside.sum()), n)))

        for n in self.marks:
            look(np.arange(max(len(line) - n + 1, 0)), n, self.marks[n])
        if self.long and len(line) >= PREFIX:
            h = (sums[PREFIX:] - sums[:-PREFIX]) * self.hashes.down[: len(line) - PREFIX + 1]
            at = np.nonzero(self.head_marks.may(h))[0]
            near = np.searchsorted(self.heads, h[at])
            at = at[self.heads[np.minimum(near, len(self.heads) - 1)] == h[at]]
            for n in self.long:
                look(at, n, self.long_marks[n])
        text, start, term, size = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))
        return text, start - np.concatenate(([0], ends[:-1]))[text].astype(np.int64) if found else start, term, size

    def found(self, texts: list[str], words: list[tuple[bool, bool]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """text, term of each term that stands in a text, once.

        ``words``: only where no ASCII letter stands before or after it; says of each text whether it goes on before and after.
        """
        text, start, term, size = self.candidates(texts)
        if not len(text):
            return text, term
        if not words:
            # a term's first place in a text tells for all, unless another string of its hash stands there
            first = np.unique(text * np.int64(len(self.terms)) + term, return_index=True)[1]
            if self.same(texts, text[first], start[first], term[first], size[first]).all():
                return text[first], term[first]
        same = self.same(texts, text, start, term, size)
        if words:
            # where a piece goes on, the piece beside it sees this place from inside
            before = lambda i, s: words[i][0] if s == 0 else texts[i][s - 1].isascii() and texts[i][s - 1].isalpha()
            after = lambda i, e: words[i][1] if e == len(texts[i]) else texts[i][e].isascii() and texts[i][e].isalpha()
            same &= np.array([not (before(i, s) or after(i, s + n)) for i, s, n in zip(text.tolist(), start.tolist(), size.tolist())], bool)
        key = np.unique(text[same] * np.int64(len(self.terms)) + term[same])
        return key // len(self.terms), key % len(self.terms)

    def same(self, texts: list[str], text: np.ndarray, start: np.ndarray, term: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the term stands there."""
        cut = [texts[i][s : s + n] for i, s, n in zip(text.tolist(), start.tolist(), size.tolist())]
        return pc.equal(self.terms.take(pa.array(term)), pa.array(cut, self.terms.type)).to_numpy(zero_copy_only=False)

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """text, term of each term that stands in a text, once, in their order, of any number of texts."""
        keys = [np.zeros(0, np.int64)]
        for numbers, pieces, _ in self.slices(texts):
            text, term = self.found(pieces)
            keys.append(np.array(numbers, np.int64)[text] * len(self.terms) + term)
        key = np.unique(np.concatenate(keys))
        return key // max(len(self.terms), 1), key % max(len(self.terms), 1)

    def slices(self, texts: list[str]):
        """Numbers of texts, pieces of them and whether these go on before and after, in lists of some ``CHARS``.

        Pieces of a long text overlap by the longest term and a character.
        """
        step, over = max(CHARS, 2 * self.longest), self.longest + 1
        numbers, parts, more, size = [], [], [], 0
        for i, t in enumerate(texts):
            for at in range(0, max(len(t) - over, 1), step):
                piece = t[at : at + step + over]
                numbers.append(i)
                parts.append(piece)
                more.append((at > 0, at + step + over < len(t)))
                size += len(piece)
                if size >= step:
                    yield numbers, parts, more
                    numbers, parts, more, size = [], [], [], 0
        if numbers:
            yield numbers, parts, more
