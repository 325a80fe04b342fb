"""Token ids of a byte-level vocabulary for whole batches of texts.

The word pattern of the vocabulary is applied to a whole batch by array
operations on character classes; only words not met before are encoded, and a
task's cache of encoded words gives the ids of all others. Character classes
come from the tokenizer file's own pre-tokenizer. The ids are exactly those of
`Tokenizer.from_file(...).encode(text, add_special_tokens=False)`; texts that
spell a special token out go through that call itself.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from textloom.llm.common import prefix_hash, span_hash

LETTER, DIGIT, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 4
CACHE_WORDS = 1_500_000
# Endings that an apostrophe starts.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
NEWLINE = "\n"


class Encoder:
    def __init__(self, path: str, ranks_path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.kind = np.full(0x110000, UNKNOWN, np.uint8)
        self.words = self._word_encoder(ranks_path)
        (self.newline,) = self.words([NEWLINE])[0]
        self._reset()

    def _word_encoder(self, ranks_path: str | None):
        """Encoder of many short strings: by the vocabulary's rank file where
        there is one (the same ids, several times faster)."""
        if ranks_path is None:
            return lambda texts: [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        coded = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [coded.encode_ordinary(t) for t in texts]

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, bounds of each text)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spelled = np.zeros(len(texts), bool)
        for word in self.specials:
            spelled |= pc.match_substring(texts, word).to_numpy(zero_copy_only=False)
        if not spelled.any():
            return self._encode(texts)
        asked = texts.filter(pa.array(spelled)).to_pylist()
        odd = [e.ids for e in self.whole.encode_batch(asked, add_special_tokens=False)]
        ids, bounds = self._encode(texts.filter(pa.array(~spelled)))
        rows = iter(np.split(ids, bounds[1:-1]))
        odd = iter(odd)
        parts = [np.asarray(next(odd) if s else next(rows), np.uint32) for s in spelled]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        joined = "".join(texts.to_pylist())
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        text_at = np.concatenate([[0], np.cumsum(lengths)])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        start = self._word_starts(codes, text_at)
        end = np.append(start[1:], len(codes))
        keys = span_hash(prefix_hash(codes), start, end)
        code, fresh = pd.factorize(keys)
        place = np.minimum(np.searchsorted(self.keys, fresh), max(len(self.keys) - 1, 0))
        new = self.keys[place] != fresh if len(self.keys) else np.ones(len(fresh), bool)
        if new.any():
            where = np.empty(len(fresh), np.int64)
            where[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            where = where[new]
            self._learn(joined, fresh[new], start[where], end[where], codes)
            place = np.searchsorted(self.keys, fresh)
        slot = place[code]
        size = self.size[slot]
        before = np.cumsum(size) - size
        out = self.ids[np.repeat(self.at[slot] - before, size) + np.arange(int(size.sum()))]
        ends = np.append(before, len(out))
        result = out, ends[np.searchsorted(start, text_at)]
        if len(self.keys) > CACHE_WORDS:
            self._reset()
        return result

    def _learn(self, joined: str, keys: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray) -> None:
        """Encode new words: those that a newline sets apart safely in one call
        joined by it, the rest one by one."""
        words = [joined[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        safe = (self.kind[codes[end - 1]] != SPACE) & (codes[start] != 39)
        sure, rest = np.flatnonzero(safe), np.flatnonzero(~safe)
        size = np.zeros(len(words), np.int64)
        parts = [self.ids]
        for at in range(0, len(sure), 20_000):
            part = sure[at : at + 20_000]
            ids = np.array(self.words([NEWLINE.join(words[i] for i in part)])[0], np.uint32)
            cut = np.flatnonzero(ids == self.newline)
            if len(cut) != len(part) - 1:
                raise ValueError("a word runs across a line break")
            size[part] = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1
            parts.append(ids[ids != self.newline])
        for i, row in zip(rest.tolist(), self.words([words[i] for i in rest]), strict=True):
            size[i] = len(row)
            parts.append(np.array(row, np.uint32))
        at = np.empty(len(words), np.int64)
        order = np.concatenate([sure, rest])
        at[order] = len(self.ids) + np.cumsum(size[order]) - size[order]
        self.ids = np.concatenate(parts)
        order = np.argsort(np.concatenate([self.keys, keys]))
        self.keys = np.concatenate([self.keys, keys])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        kinds = self.kind[codes]
        if (kinds == UNKNOWN).any():
            for code in np.unique(codes[kinds == UNKNOWN]).tolist():
                self.kind[code] = self._kind_of(chr(code))
            kinds = self.kind[codes]
        return kinds

    def _kind_of(self, char: str) -> int:
        """By which neighbour the pre-tokenizer leaves the character with."""
        for kind, mate in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")):
            if len(self.whole.pre_tokenizer.pre_tokenize_str(mate + char)) == 1:
                return kind
        return SPACE

    def _word_starts(self, codes: np.ndarray, text_at: np.ndarray) -> np.ndarray:
        """Where the pattern starts a new word; every text starts one."""
        n = len(codes)
        kinds = self._kinds(codes)
        first = np.zeros(n + 1, bool)  # first character of a text
        first[text_at] = True
        first = first[:n]
        final = np.ones(n, bool)  # last character of a text
        final[:-1] = first[1:]
        before = np.empty(n, np.uint8)
        before[:1] = UNKNOWN
        before[1:] = kinds[:-1]
        space = kinds == SPACE
        after_space = (before == SPACE) & ~first
        after_blank = np.zeros(n, bool)
        after_blank[1:] = codes[:-1] == 32
        after_blank &= ~first
        # A run of one kind starts a word unless a blank already did.
        starts = first | ((kinds != before) & ~space & ~after_blank) | (space & ~after_space)
        # Of two or more blanks before a word, the last one starts a word again.
        follows = np.zeros(n, bool)
        follows[:-1] = ~space[1:]
        starts |= space & after_space & follows & ~final
        self._endings(codes, kinds, first, final, after_blank, before, starts)
        return np.flatnonzero(starts)

    @staticmethod
    def _endings(codes, kinds, first, final, after_blank, before, starts) -> None:
        """'s, 'll and the like are words of their own where a word can start."""
        n = len(codes)
        marks = np.flatnonzero((codes == 39) & ~final)
        marks = marks[first[marks] | ((before[marks] != OTHER) & ~after_blank[marks])]
        free = np.ones(len(marks), bool)
        for ending in sorted(ENDINGS, key=len):
            size = len(ending)
            hit = free & (marks + size < n)
            for k, char in enumerate(ending, 1):
                at = np.minimum(marks + k, n - 1)
                hit &= (codes[at] == ord(char)) & ~first[at]
            here = marks[hit]
            starts[here + 1] = False
            after = here + size + 1
            after = after[after < n]
            starts[after[~first[after] & (kinds[after] == LETTER)]] = True
            free &= ~hit


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None = None) -> Encoder:
    """One encoder per task process; its cache of words lasts across batches."""
    return Encoder(path, ranks_path)
