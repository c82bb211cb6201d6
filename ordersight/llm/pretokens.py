"""Token ids of a word-end BPE tokenizer for many texts at once.

Such a tokenizer lower-cases a text, splits it by a pattern into pre-tokens
(contractions, runs of letters, single digits, runs of other marks) and encodes each one
on its own. So the ids of every different pre-token are asked of the tokenizer once
per worker and kept in a table by the pre-token's 64-bit hash. Texts beyond Latin-1,
and texts that may hold a special token's string, go to the tokenizer whole; ``parts``
gives their pre-tokens as the tokenizer splits them.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
from tokenizers import Tokenizer

from ordersight.llm.byte_words import RangeHash, mix

#: Different pre-tokens kept per worker; beyond, the table starts anew.
TABLE_BITS = 21
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[0xC0:0xDF] += 32
_LOWER[0xD7] = 0xD7
_KIND = np.full(256, _OTHER, np.uint8)
for _span in ((65, 91), (97, 123), (0xAA, 0xAB), (0xB5, 0xB6), (0xBA, 0xBB), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x100)):
    _KIND[slice(*_span)] = _LETTER
_KIND[48:58] = _KIND[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
_KIND[9:14] = _KIND[[0x20, 0x85, 0xA0]] = _SPACE
_QUOTE = ord("'")


@dataclass
class PreTokens:
    """Per pre-token its range in the joined Latin-1 bytes and its entry in the table."""

    starts: np.ndarray
    ends: np.ndarray
    entries: np.ndarray
    bounds: np.ndarray


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of lower-cased Latin-1 texts."""
    kind = _KIND[data]
    border = np.ones(len(data) + 1, bool)
    border[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    border[offsets] = True
    # A lone quote takes s, t, m, d, re, ve or ll with it.
    quotes = np.flatnonzero((data[:-1] == _QUOTE) & border[:-2] & border[1:-1] & (kind[1:] == _LETTER)) if len(data) > 1 else np.zeros(0, int)
    if len(quotes):
        quotes = quotes[~np.isin(quotes + 1, offsets)]
        padded = np.append(data, [0, 0]).astype(np.uint8)
        one, two = padded[quotes + 1], padded[quotes + 2]
        inside = ~border[np.minimum(quotes + 2, len(data))]
        pair = inside & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        taken = quotes[pair | single]
        border[taken + 1] = False
        border[taken + np.where(pair, 3, 2)[pair | single]] = True
    starts = np.flatnonzero(border[:-1]) if len(data) else np.zeros(0, int)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    some = kind[starts] != _SPACE if len(starts) else np.zeros(0, bool)
    return starts[some], ends[some]


class Encoder:
    """Ids and counts of texts; one per worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self._ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self._ends[number] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(1 << TABLE_BITS, np.uint64)
        self._entry = np.zeros(1 << TABLE_BITS, np.int32)
        self._used = 0
        self.counts = np.zeros(1 << 16, np.int32)
        self.firsts = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self._pooled = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        found = np.full(len(hashes), -1, np.int32)
        open_ = np.arange(len(hashes))
        place = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        while len(open_):
            keys = self._keys[place]
            hit = keys == hashes[open_]
            found[open_[hit]] = self._entry[place[hit]]
            going = ~hit & (keys != 0)
            open_, place = open_[going], (place[going] + 1) & ((1 << TABLE_BITS) - 1)
        return found

    def _insert(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        place = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        while len(hashes):
            free = self._keys[place] == 0
            self._keys[place[free]] = hashes[free]
            mine = self._keys[place] == hashes
            self._entry[place[mine]] = entries[mine]
            hashes, entries = hashes[~mine], entries[~mine]
            place = (place[~mine] + 1) & ((1 << TABLE_BITS) - 1)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Ask the tokenizer for new pre-tokens, many joined by blanks in a call."""
        groups = [words[k : k + 256] for k in range(0, len(words), 256)]
        ids, counts = [], []
        for group, coded in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            mine = np.array(coded.ids, np.uint32)
            ends = np.flatnonzero(self._ends[mine])
            if len(ends) == len(group):
                counts.append(np.diff(np.append(-1, ends)))
                ids.append(mine)
                continue
            for word in group:
                alone = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32)
                counts.append(np.array([len(alone)]))
                ids.append(alone)
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        first, past = self._used, self._used + len(hashes)
        while past > len(self.counts):
            self.counts = np.append(self.counts, np.zeros_like(self.counts))
            self.firsts = np.append(self.firsts, np.zeros_like(self.firsts))
        while self._pooled + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        self.counts[first:past] = counts
        self.firsts[first:past] = self._pooled + np.cumsum(counts) - counts
        self.pool[self._pooled : self._pooled + len(ids)] = ids
        self._pooled += len(ids)
        self._used = past
        self._insert(hashes, np.arange(first, past, dtype=np.int32))

    def entries(self, texts: list[bytes]) -> PreTokens:
        """Pre-tokens of Latin-1 texts; their entries are valid until the next call."""
        data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
        starts, ends = split(data, offsets)
        hashes = mix(RangeHash(data, lower=False).of(starts, ends)) | np.uint64(1)
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unknown, at = np.unique(hashes[new], return_index=True)
            if self._used + len(unknown) > (1 << TABLE_BITS) * 0.6 and self._used:
                self._clear()
                return self.entries(texts)
            words = [data[starts[k] : ends[k]].tobytes().decode("latin-1") for k in new[at]]
            self._learn(unknown, words)
            found[new] = self._find(hashes[new])
        return PreTokens(starts, ends, found, np.searchsorted(starts, offsets))

    def plain(self, text: str) -> bytes | None:
        """The text as Latin-1, or None if it must be encoded whole."""
        if "<|" in text:
            return None
        try:
            return text.encode("latin-1")
        except UnicodeEncodeError:
            return None

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def parts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text the first character and the number of ids of its pre-tokens, by the tokenizer's own split."""
        out = []
        for coded in self.tokenizer.encode_batch(texts, add_special_tokens=False):
            words = np.array([-1 if w is None else w for w in coded.word_ids], np.int64)
            # A special token is no word and a part of its own.
            new = np.flatnonzero((words < 0) | (np.append(-2, words[:-1]) != words))
            starts = np.array([first for first, _ in coded.offsets], np.int64)[new]
            out.append((starts, np.diff(np.append(new, len(words)))))
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the tokenizer gives them without special tokens."""
        out: list[np.ndarray | None] = [None] * len(texts)
        coded = [self.plain(t) for t in texts]
        at, size = [], 0
        for k, text in enumerate([*coded, b""]):
            if k == len(coded) or size > 1 << 20:
                for row, found in zip(at, self._ids([coded[r] for r in at]) if at else []):
                    out[row] = found
                at, size = [], 0
            if k < len(coded) and text is None:
                out[k] = self.whole(texts[k])
            elif k < len(coded):
                at.append(k)
                size += len(text)
        return out

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.entries(texts)
        counts = self.counts[found.entries].astype(np.int64)
        past = np.cumsum(counts)
        total = int(past[-1]) if len(past) else 0
        shift = self.firsts[found.entries] - (past - counts)
        flat = self.pool[np.arange(total) + np.repeat(shift, counts)]
        bounds = np.append(0, past)[found.bounds]
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, with what it has learned."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]
