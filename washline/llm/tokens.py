"""Token ids of whole texts, by a public tokenizer file of the tokenizers library.

`Encoder` gives exactly the ids of `Tokenizer.from_file(path)` without added special tokens, several
times faster:

- A byte-level file whose ids are in merge order holds what the tiktoken library calls ranks;
  that library then merges, by the same vocabulary and splitting pattern.
- Where white space is dropped, a text's ids are those of its words in order.  Distinct words are
  encoded once and kept in a bounded cache.
- Any other file, and any text that may hold the content of an added token, which has an id of its
  own, is left to the tokenizers library as it is.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Pieces kept per worker and level, twice over while a generation changes; some 100 MB at most.
CACHED = 250_000

#: Longer pieces are not worth keeping.
LONGEST_KEPT = 40

# The splitting patterns stated in the two public tokenizer files.
GPT2_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CLIP_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Python counts these as white space, Unicode doesn't.
SEPARATORS = re.compile("[\x1c-\x1f]")

#: The start of an added token that is the same in any case.
CASELESS = re.compile(r"[!-@\[-`{-~]*")

#: Marks that no part of either pattern joins to a letter before them.
ALONE = {".", ",", "!", "?", ":", ";"}

#: Beyond the Latin blocks the library itself normalises and splits.
NOT_LATIN = re.compile("[^\x00-ɏ]")


class Pieces(dict):
    """Ids by piece: two generations, so that frequent pieces stay when old ones go."""

    def __init__(self, make: Callable[[str], bytes], most: int = CACHED):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """`encode(text)`: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token["content"].lower() for token in spec["added_tokens"]]
        # Any text with an added token has one of these; they have no other case, so one quick search rules out most texts.
        self.starts = {CASELESS.match(token["content"])[0] for token in spec["added_tokens"]}
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        steps = before.get("pretokenizers") or [{}]
        if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not spec["normalizer"] and _ranked(model):
            letters = {letter: byte for byte, letter in byte_letters().items()}
            ranks = {x.translate(letters).encode("latin-1"): i for x, i in model["vocab"].items() if {*map(ord, x)} <= letters.keys()}
            for token in spec["added_tokens"]:
                ranks.pop(token["content"].encode(), None)
            self.ranks = tiktoken.Encoding(path, pat_str=GPT2_PARTS, mergeable_ranks=ranks, special_tokens={})
            self.encode = self._ranks
        elif steps[0].get("pattern") == {"Regex": CLIP_PARTS} and model["end_of_word_suffix"]:
            self.encode = self._words
            self.parts = regex.compile(CLIP_PARTS).findall
            self.letters = byte_letters()
            self.part_ids = Pieces(self._part)
            self.word_ids = Pieces(self._word)
            gc.set_threshold(100_000, 20, 50)  # the many small lists here form no cycles
        else:
            self.encode = self.whole

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _holds_added(self, text: str) -> bool:
        """May the text hold an added token?  Case is ignored, as some are looked for in the normalised text."""
        if not any(start in text for start in self.starts):
            return False
        lower = text.lower()
        return any(token in lower for token in self.added)

    def _ranks(self, text: str) -> bytes:
        if self._holds_added(text):
            return self.whole(text)
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def _words(self, text: str) -> bytes:
        if self._holds_added(text):
            return self.whole(text)
        return b"".join(map(self.word_ids.__getitem__, text.replace("\n", " ").split(" ")))

    def _word(self, word: str) -> bytes:
        if not word.isascii() and NOT_LATIN.search(word):
            return self.whole(word)
        word, ids = word.lower(), self.part_ids
        if word.isalpha():
            return ids[word]
        if word[-1:] in ALONE and word[:-1].isalpha():
            return ids[word[:-1]] + ids[word[-1]]
        if SEPARATORS.search(word):
            return self.whole(word)
        return b"".join(map(ids.__getitem__, self.parts(word)))

    def _part(self, part: str) -> bytes:
        letters = part
        if not (part.isascii() and part.isprintable()):
            letters = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()


def _ranked(model: dict) -> bool:
    """Are ids in the order of the merges, after those of the 256 bytes?"""
    vocab = model["vocab"]
    return all(vocab["".join(pair if isinstance(pair, list) else pair.split(" "))] == 256 + i for i, pair in enumerate(model["merges"]))


def byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself, or from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)
