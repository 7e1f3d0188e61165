"""Token ids of whole texts, word by word, for a vocabulary that drops white space.

Such a tokenizer never joins letters across white space, so a text's ids are
its words' ids in turn. Each worker keeps the ids of the words it has met, by
the hash of their bytes, and only tokenizes words that are new to it.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

from roomledger.llm.words import grouped, scan_words

VOCABULARY = "word_bpe_49k.json"
KNOWN_WORDS = 1 << 20  # kept by a worker at most; beyond it starts anew
TEXT_GROUP = 4 << 20
# Fixed values of the vocabulary: the pattern that splits a normal text, and how bytes are shown as letters.
PARTS = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # a line end parts two words
PLAIN = re.compile(r"(?!.*<\|)[\x21-\x7E\xA1-\xAC\xAE-\xFF]+")  # printable Latin-1 without the sign of special tokens
UNSHOWN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
SHOWN = {b: 256 + k for k, b in enumerate(UNSHOWN)}


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every run, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids after each other, and their lengths."""
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts


class WordEncoder:
    """Encodes texts with a tokenizer file; ``literal`` takes special tokens in a text as ordinary text."""

    def __init__(self, path: str, literal: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.part_no: dict[str, int] = {"\n": 0}
        self.part_start = np.zeros(1, np.int64)
        self.part_length = np.zeros(1, np.int64)
        self.part_ids = np.zeros(0, np.uint32)

    def _part(self, part: str) -> list[int]:
        """Ids of one run of letters or signs, straight from the merges."""
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN)
        return [t.id for t in self.tokenizer.model.tokenize(shown)]

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_tokenize``, for plain words: all are cut into parts at once, and parts are tokenized when first met."""
        parts = PARTS.findall("\n".join([*words, ""]).lower())
        new = [p for p in dict.fromkeys(parts) if p not in self.part_no]
        ids, counts = _flat([self._part(p) for p in new])
        self.part_no.update(zip(new, range(len(self.part_no), len(self.part_no) + len(new))))
        self.part_start = np.append(self.part_start, len(self.part_ids) + np.cumsum(counts) - counts)
        self.part_length = np.append(self.part_length, counts)
        self.part_ids = np.append(self.part_ids, ids)
        place = np.fromiter(map(self.part_no.__getitem__, parts), np.int64, len(parts))
        length = self.part_length[place]
        ends = np.cumsum(length)[place == 0]
        return self.part_ids[runs(self.part_start[place], length)], np.diff(ends, prepend=0)

    def _tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in turn, and how many each has: plain words part by part, all others by the whole tokenizer."""
        plain = np.fromiter(map(bool, map(PLAIN.fullmatch, words)), bool, len(words))
        others = [self.tokenizer.encode(words[i], add_special_tokens=False).ids for i in np.flatnonzero(~plain)]
        counts = np.zeros(len(words), np.int64)
        found = self._plain([words[i] for i in np.flatnonzero(plain)]), _flat(others)
        for own, (_, n) in zip((plain, ~plain), found):
            counts[own] = n
        starts, ids = np.cumsum(counts) - counts, np.zeros(int(counts.sum()), np.uint32)
        for own, (each, n) in zip((plain, ~plain), found):
            ids[runs(starts[own], n)] = each
        return ids, counts

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Add words by their sorted, new hashes."""
        ids, counts = self._tokenize(words)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.start = np.insert(self.start, at, len(self.ids) + np.cumsum(counts) - counts)
        self.length = np.insert(self.length, at, counts)
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of every text, as ``uint32``."""
        found = []
        for low, high in grouped(texts, TEXT_GROUP):
            # The tokenizer finds special tokens before it lower-cases, so texts with their sign stay as they are.
            words = scan_words(texts[low:high], lower=not any(b"<|" in t for t in texts[low:high]))
            each, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
            if len(self.known) + len(each) > KNOWN_WORDS:
                self.forget()
            at = np.searchsorted(self.known, each)
            new = np.flatnonzero(self.known[at.clip(max=len(self.known) - 1)] != each) if len(self.known) else np.arange(len(each))
            if len(new):
                self._learn(each[new], words.some(first[new]))
                at = np.searchsorted(self.known, each)
            place = at[inverse]
            length = self.length[place]
            ids = self.ids[runs(self.start[place], length)]
            ends = np.concatenate(([0], np.cumsum(length)))[words.bounds]
            found.extend(ids[a:b] for a, b in zip(ends[:-1], ends[1:]))
        return found


@lru_cache(maxsize=4)
def encoder(path: str | None = None, literal: bool = False) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    return WordEncoder(path or public_tokenizers.path(VOCABULARY), literal)
