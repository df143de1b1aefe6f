"""Hashed n-grams of texts: words, word pairs and the shapes of tokens."""

from __future__ import annotations

import itertools
import string

import numpy as np

WORD_BITS, PAIR_BITS, SHAPE_BITS = 19, 18, 16
REPEAT = (1 << WORD_BITS) + (1 << PAIR_BITS) + (1 << SHAPE_BITS)  # the same word three times in a row
BUCKETS = REPEAT + 1

_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(token: str) -> str:
    """Shape of the common kinds of words; empty for others."""
    if token.islower():
        return "a"
    if token.isupper():
        return "A"
    return "Aa" if token[0].isupper() and token[1:].islower() else ""


def shape(token: str) -> str:
    """``Word,`` is ``Aa,``, ``WORD!!`` is ``A!``: one sign for each run of a kind."""
    token = token[:64]
    if token.isalpha():
        found = _letters(token)
        if found:
            return found
    elif token[:-1].isalpha() and not token[-1].isdigit():
        found = _letters(token[:-1])
        if found:
            return found + token[-1]
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return "".join(k for k, _ in itertools.groupby(kinds))


class HashedNgrams:
    """Distinct n-gram buckets of a text; keeps the hashes of tokens."""

    def __init__(self, keep: int = 250_000):
        self.keep, self.known, self.shapes = keep, {}, {}

    def _token(self, token: str) -> bytes:
        """Hash of the word and hash of the shape."""
        import xxhash

        s = shape(token)
        if s not in self.shapes:
            if len(self.shapes) > self.keep:
                self.shapes.clear()
            self.shapes[s] = xxhash.xxh3_64_digest(s, 1)
        return xxhash.xxh3_64_digest(token.strip(string.punctuation).lower() or token) + self.shapes[s]

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").split()
        if not tokens:
            return np.zeros(0, np.int64)
        known = self.known
        if len(known) > self.keep:
            known.clear()
        hashes = list(map(known.get, tokens))
        for i, h in enumerate(hashes):
            if h is None:
                t = tokens[i]
                hashes[i] = known.get(t) or known.setdefault(t, self._token(t))
        both = np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64).reshape(-1, 2)
        w, s = both[:, 0], both[:, 1]
        pairs = _mix(w[:-1] * _M + w[1:])
        # A repeated word is a shape of its own, as are two and three shapes in a row.
        again = w[:-1] == w[1:]
        s2 = _mix(s[:-1] * _M + s[1:])
        s2 = np.where(again, _mix(s2 + np.uint64(1)), s2)
        s3 = _mix(s2[:-1] * _M + s2[1:])
        spans = ((w, WORD_BITS, 0), (pairs, PAIR_BITS, 1 << WORD_BITS)) + tuple(
            (x, SHAPE_BITS, (1 << WORD_BITS) + (1 << PAIR_BITS)) for x in (s, s2, s3)
        )
        found = np.concatenate([(x >> np.uint64(64 - bits)).astype(np.int32) + np.int32(base) for x, bits, base in spans])
        if (again[1:] & again[:-1]).any():
            found = np.append(found, np.int32(REPEAT))
        found.sort()
        return found[np.concatenate([[True], found[1:] != found[:-1]])].astype(np.int64)
