"""SentencePiece encoding and decoding by one weighted finite-state transducer.

A model is compiled once.  The normaliser is a transducer of a few states
(dummy prefix, spaces to the meta symbol, runs of them to one), the pieces are a
trie whose accepting states emit an id and go back to the root, characters
without a piece loop there: to their bytes, or, a whole run of them, to the
unknown id.  The two are composed into one machine over input characters.
Encoding composes it with a text, place by place, and takes the shortest path in
the tropical semiring (min, +).

* Unigram models: emitting a piece costs minus its score.
* BPE models: the machine is composed with one more, lazily, as its states are
  pairs of pieces.  To emit a piece after another costs 0 if merging leaves the
  two as they are, and infinity if it doesn't.  A sequence is what merging makes
  of a text if and only if each of its adjacent pairs is, so the shortest path is
  the encoding, and one path to each place is finite.

Pieces that a user defined stand alone in BPE, the longest first; in unigram
models they have the weight that the library gives them.  Models whose
normaliser replaces characters or that hold unused pieces are refused.

Words met before are cached: with byte fallback no piece and no loop runs across
the cuts that ``safe`` finds in the model.  Null and empty texts have no ids.
Very long texts are taken word by word, or, where there are no safe cuts, in one
pass whose memory grows with their length.  Repeated rows and null ids are
encoded like any others, and other columns aren't looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import Memo, kept, read, sliced

META = "▁"
INF = float("inf")
#: A run of letters, or of anything else, with the meta symbols or spaces before it.
LETTER = "[^\\W\\d_¹²³¼-¾]"
CUT = re.compile(rf"[{META} ]*(?:{LETTER}+|(?:(?!{LETTER})[^{META} ])+)|[{META} ]+", re.DOTALL)
#: What a character without a piece costs beyond the worst piece, as in the library.
PENALTY = 10.0
NO_PAIRS: dict[int, float] = {}


@dataclass
class Normaliser:
    """States and their arcs; each arc takes one character, and a space is written as the meta symbol or not at all."""

    #: By state, for a space: (what is written, next state).
    space: list[list[tuple[str, int]]]
    #: By state, for any other character, which is written as it is: the next state.
    other: list[int | None]
    final: list[bool]
    start: int
    #: Stands before any text that isn't empty.
    begin: str


def normaliser(dummy: bool, squeeze: bool) -> Normaliser:
    begin = " " if dummy else ""
    if not squeeze:  # one state: each space is written
        return Normaliser([[(META, 0)]], [0], [True], 0, begin)
    # 0 in text; 1 in a run of spaces of which none is written; 2 the run's last one is; 3 spaces before any text
    text, run = [("", 1), (META, 2)], [("", 1), (META, 2)]
    if not dummy:
        return Normaliser([text, run, [], [("", 3)]], [0, None, 0, 0], [True, True, False, True], 3, begin)
    # 3 at the prefix; 4 it is written, spaces before any text
    return Normaliser([text, run, [], [(META, 4)], [("", 4)]], [0, None, 0, None, 0], [True, True, False, True, False], 3, begin)


@dataclass
class Machine:
    """The composed transducer: states are pairs of a normaliser's state and a trie's.

    Beside each root there is a state in a run of unknown characters, which loops without writing.
    """

    #: By state: input character to the next state.
    steps: list[dict[str, int]] = field(default_factory=list)
    #: By state: where a space leads as well.
    forks: dict[int, int] = field(default_factory=dict)
    #: By state: the piece that may be emitted there and the state that follows; in a state where no piece has begun none and itself.
    ends: list[tuple[int | None, int] | None] = field(default_factory=list)
    #: By state: where a character without a piece leads, if anywhere, and whether it writes.
    loops: list[tuple[int, bool] | None] = field(default_factory=list)
    #: States at which a text may end.
    final: list[int] = field(default_factory=list)
    #: State at a text's start, and after a cut.
    start: int = 0
    inner: int = 0
    #: A state that nothing leaves.
    dead: int = 0


ROOT, RUN = 0, -1


def composed(norm: Normaliser, pieces: dict[str, int], runs: bool) -> Machine:
    """The normaliser composed with the trie of pieces, as far as the start reaches.

    ``runs``: a run of unknown characters is written once, else each of them is.
    """
    children: list[dict[str, int]] = [{}]
    accepts: list[int | None] = [None]
    for piece, i in pieces.items():
        node = ROOT
        for c in piece:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                accepts.append(None)
            node = children[node][c]
        accepts[node] = i

    out = Machine()
    number: dict[tuple[int, int], int] = {}
    queue: list[tuple[int, int]] = []

    def state(n: int, node: int) -> int:
        if (n, node) not in number:
            number[n, node] = len(queue)
            queue.append((n, node))
        return number[n, node]

    out.start, out.inner = state(norm.start, ROOT), state(0, ROOT)
    for n, node in queue:  # grows as states are met
        arcs, m = children[max(node, ROOT)], norm.other[n]
        steps = {c: state(m, to) for c, to in arcs.items()} if m is not None else {}
        spaces = [(max(node, ROOT) if not written else arcs.get(written), k) for written, k in norm.space[n]]
        moves = [state(k, to) for to, k in spaces if to is not None]
        if moves:
            steps[" "] = moves[0]
        if len(moves) > 1:
            out.forks[len(out.steps)] = moves[1]
        out.steps.append(steps)
        out.ends.append((None, number[n, node]) if node <= ROOT else (accepts[node], state(n, ROOT)) if accepts[node] is not None else None)
        out.loops.append((state(m, RUN if runs else ROOT), node == ROOT) if node <= ROOT and m is not None else None)
    out.dead = len(out.steps)
    out.steps.append({})
    out.ends.append(None)
    out.final = [k for (n, node), k in number.items() if node <= ROOT and norm.final[n]]
    return out


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kind = model.normalizer_spec, pb.ModelProto.SentencePiece
        self.bpe = model.trainer_spec.model_type == pb.TrainerSpec.BPE
        normal = {kind.NORMAL, kind.USER_DEFINED}
        own = [p.piece for p in model.pieces if p.type == kind.USER_DEFINED]
        if norm.precompiled_charsmap or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models whose normaliser keeps characters as they are")
        if any(p.type == kind.UNUSED for p in model.pieces) or not self.bpe and model.trainer_spec.model_type != pb.TrainerSpec.UNIGRAM:
            raise ValueError("only BPE and unigram models without unused pieces")
        if own and (norm.remove_extra_whitespaces or any(" " in p or META in p for p in own)):
            raise ValueError("pieces that a user defined go with a normaliser that keeps all spaces, and have none")
        self.dummy, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.text = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in normal}
        self.score = [p.score for p in model.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        scores = [p.score for p in model.pieces if p.type == kind.NORMAL]
        self.cost = [0.0 if self.bpe else -s for s in self.score]
        if not self.bpe:  # as the library does, whose greatest score isn't below the least positive one
            for p in own:
                self.cost[self.ids[p]] = 0.1 - len(p.encode()) * max(scores + [float(np.finfo(np.float32).tiny)])
        self.strange = 0.0 if self.bpe else PENALTY - min(scores, default=0.0)
        # frozen pieces of BPE are cut out of a text before it is walked
        self.frozen = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")") if own and self.bpe else None
        walked = {p: i for p, i in self.ids.items() if not (self.frozen and p in own)}
        self.letters = {p for p in walked if len(p) == 1}
        #: A character that no piece has.
        self.stop = next(chr(c) for c in range(0xFFFF, 0, -1) if not any(chr(c) in p for p in walked))
        #: Characters that are in pieces but have none of their own.
        self.inside = set().union(*walked) - self.letters if self.bpe else set()
        if META not in self.letters:
            raise ValueError("only models with a piece for the space")
        norm = normaliser(self.dummy, self.squeeze)
        self.begin, self.machine = norm.begin, composed(norm, walked, not self.bytes)
        self.surface = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else p.piece.replace(META, " ").encode() if p.type in normal else b"" if p.type == kind.CONTROL else model.trainer_spec.unk_surface.encode() for p in model.pieces]
        self.pairs: dict[int, dict[int, float]] = {}
        self.n_pairs = 0
        self.cut = CUT if self.safe() else None
        self.memo = Memo(lambda unit: self.written(self.path(unit, self.machine.inner)), 800_000)

    def safe(self) -> bool:
        """Whether no piece and no loop runs across a cut: each piece is all of one match."""
        return bool(self.bytes) and not self.squeeze and all(CUT.fullmatch(p) for p in self.ids)

    # --- the lazy part of the machine for BPE ---

    def name(self, emitted: int) -> str:
        """The text of a piece, or of a character without one (-1 - its code point)."""
        return self.text[emitted] if emitted >= 0 else chr(-1 - emitted)

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def pair_cost(self, last: int | None, piece: int) -> float:
        """The weight of the arc from the state of ``last`` (None: nothing that could merge) to that of ``piece``."""
        after = self.pairs.get(last)
        if after is None:
            after = self.pairs[last] = {}
        cost = after.get(piece)
        if cost is None:
            want = [self.name(piece)] if last is None else [self.name(last), self.name(piece)]
            cost = after[piece] = 0.0 if self.merged("".join(want)) == want else INF
            self.n_pairs += 1
            if self.n_pairs > 2_000_000:
                self.n_pairs, self.pairs = 0, {}
        return cost

    # --- composition with a text, and the shortest path ---

    def path(self, text: str, start: int) -> list[int]:
        """What the shortest path through the machine from ``start`` emits, in order.

        All arcs go forward in the text, so a place's costs are final when it is left.
        """
        machine, cost, letters, pairs, n = self.machine, self.cost, self.letters, self.pairs, len(text)
        steps, ends, loops, forks, dead = machine.steps, machine.ends, machine.loops, machine.forks, machine.dead
        chars = text + self.stop
        # by place and state: cost, (path before, what was emitted last), what may merge with the next
        live: list[dict[int, tuple]] = [{} for _ in range(n + 1)]
        live[0][start] = (0.0, None, None)
        for at in range(n):
            c = chars[at]
            strange = c not in letters and c != " "
            for state, token in live[at].items():
                so_far, before, last = token
                if strange and (arc := loops[state]) is not None:
                    self.loop(c, token, arc, live[at + 1])
                known = pairs.get(last, NO_PAIRS) if self.bpe else None
                q, e, more = state, at, []
                while True:
                    if forks and chars[e] == " " and q in forks:
                        more.append((forks[q], e + 1))
                    q = steps[q].get(chars[e])
                    if q is not None:
                        e += 1
                    elif more:
                        q, e = more.pop()
                    else:
                        break
                    end = ends[q]
                    if end is not None:
                        piece, to = end
                        there = live[e]
                        best = there.get(to)
                        if piece is None:  # a space that isn't written
                            q = dead
                            if best is None or so_far < best[0]:
                                there[to] = token
                            continue
                        total = so_far + cost[piece]
                        if best is None or total < best[0]:
                            if known is not None:
                                weight = known.get(piece)
                                if weight is None:
                                    weight = self.pair_cost(last, piece)
                                if weight:
                                    continue
                            there[to] = (total, (before, piece), piece)
        last = live[n]
        best = min((last[k] for k in machine.final if k in last), key=lambda token: token[0], default=(0.0, None, None))
        out, before = [], best[1]
        while before is not None:
            before, piece = before
            out.append(piece)
        return out[::-1]

    def loop(self, c: str, token: tuple, arc: tuple[int, bool], there: dict[int, tuple]) -> None:
        """The arc of a character without a piece."""
        (so_far, before, last), (to, writes) = token, arc
        emitted, merges = -1 - ord(c), c in self.inside
        so_far += self.strange + (self.pair_cost(last, emitted) if merges and last is not None else 0.0)
        if so_far < (there[to][0] if to in there else INF):
            there[to] = (so_far, (before, emitted) if writes else before, emitted if merges else None)

    def written(self, emitted: list[int]) -> bytes:
        """Ids, little-endian unsigned 32-bit; characters without a piece as their bytes or unknown."""
        out: list[int] = []
        for k in emitted:
            if k >= 0:
                out.append(k)
            elif self.bytes:
                out += [self.bytes[b] for b in chr(-1 - k).encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return array("I", out).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a text."""
        if not text:
            return b""
        text = self.begin + text
        if self.frozen is not None:
            out = []
            for k, part in enumerate(self.frozen.split(text)):
                out += [self.ids[part]] if k % 2 else self.path(part, self.machine.inner)
            return self.written(out)
        if self.cut is None:
            return self.written(self.path(text, self.machine.start))
        return b"".join(map(self.memo.__getitem__, self.cut.findall(text)))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that aren't UTF-8 become the replacement character."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def transducer(name: str) -> Transducer:
    """The worker's own machine, kept from task to task; ``name`` is a path or a public file's name."""
    return kept((name,), lambda: Transducer(name if "/" in name else public_tokenizers.path(name)))


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id and ids of every text."""

    def run(batches):
        for batch in sliced(batches, keeps=True):
            ids = [np.frombuffer(transducer(model).encode(t), "<u4").astype(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id and text of rows of ids; null ids give the empty text."""

    def run(batches):
        for batch in sliced(batches, keeps=True):
            texts = [transducer(model).decode(np.array(ids or [], dtype=np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    """Every document encoded and decoded: n_tokens, ids_crc32, and whether the decoded text is the same."""

    def run(batches):
        for batch in sliced(batches, keeps=True):
            machine = transducer(model)
            out = {"n_tokens": [], "ids_crc32": [], "same": []}
            for text in batch.column("text").to_pylist():
                ids = machine.encode(text)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_crc32"].append(zlib.crc32(ids))
                out["same"].append(machine.decode(np.frombuffer(ids, "<u4")) == (text or ""))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_crc32"], pa.int64()), pa.array(out["same"], pa.bool_())], names=["doc_id", "n_tokens", "ids_crc32", "same"])

    docs = read(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, same boolean")
