"""Token ids of whole texts by a public tokenizer, with a bounded cache of its words.

The two families of public tokenizer files cut a text into words before they
merge anything, so a word's ids don't depend on its neighbours.  Words met
before come from the cache, new ones go to the library's model one by one.  A
text with any character outside the plain Latin range goes to the library
whole, so no rule about other scripts is repeated here.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import public_tokenizers

from storyloom.llm.common import kept

#: Words that an encoder keeps the ids of, at most; about 130 bytes each.
CACHE = 1_600_000
#: Characters for which cutting here and in the library is the same beyond doubt.
PLAIN = re.compile("[^\t\n\x20-\x7e\xa1-\xac\xae-įı-ɏ–—‘-”…]")
#: The letters and numbers among them.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
#: How each family cuts words, by the expression in its file.
CUTS = {
    "": re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"),
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": re.compile(rf"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"),
}


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level models: itself if it prints, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}


#: What stands for a space.
SPACE = chr(byte_letters()[32])


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str, size: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = [(p.get("type"), (p.get("pattern") or {}).get("Regex"), p.get("add_prefix_space", False), p.get("use_regex")) for p in pre.get("pretokenizers", [pre])]
        plain = norm is None, [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.words, self.lower = None, False
        if spec["model"].get("type") == "BPE" and plain[0] and steps == [("ByteLevel", None, False, True)]:
            self.words = CUTS[""]
        elif spec["model"].get("type") == "BPE" and plain[1] and len(steps) == 2 and steps[1] == ("ByteLevel", None, False, False):
            self.words, self.lower = CUTS.get(steps[0][1]), True
        self.table, self.model = byte_letters(), self.library.model
        self.half, self.new, self.old = size // 2, {}, {}

    def word(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word.lstrip(" ").isalnum():  # most are; their bytes stand for themselves
                letters = word.replace(" ", SPACE)
            else:
                letters = word.encode().decode("latin-1").translate(self.table)
            ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if len(word) > 100:  # their number would bound nothing
            return ids
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text; null counts as empty."""
        text = text or ""
        if self.words is None or PLAIN.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = self.words.findall(text.lower() if self.lower else text)
        ids = list(map(self.new.get, words))
        at = -1
        try:
            while True:
                at = ids.index(None, at + 1)
                ids[at] = self.new.get(words[at]) or self.word(words[at])
        except ValueError:  # none is missing any more
            return b"".join(ids)


def encoder(name: str, size: int = CACHE) -> Encoder:
    """The worker's own encoder, kept from task to task; ``name`` is a path or a public file's name."""
    return kept((name, size), lambda: Encoder(name if os.sep in name else public_tokenizers.path(name), size))


def encoded(texts: list[str | None], name: str, end: int, size: int = CACHE):
    """Yields each text's ids and the end id."""
    last = np.array([end], dtype="<u4").tobytes()
    machine = encoder(name, size)
    for text in texts:
        yield machine.encode(text) + last
