"""Hashes of words and shingles.

Words are the pieces between white space (blank and the ASCII controls 9 to
13), with A-Z lower-cased.

Shingles tell documents apart, so they are made from 128-bit hashes of the
distinct words, whose halves serve as two independent ones of 64 bits. Features of
classifiers only need spread: their word hash is a polynomial in the bytes,
taken from prefix sums over a whole buffer. That one can collide by design of
the words and must not decide whether texts are equal.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import xxhash

SPACE = re.compile(rb"[\x20\x09-\x0D]")
SLICE = 1 << 20  # bytes of a text that are split into words at a time
SEGMENT = 1 << 19  # bytes hashed at a time
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit integers without pattern."""
    golden = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(n + 1)) * golden)


BYTES = constants(1, 256)
BYTES[65:91] = BYTES[97:123]
ODD = constants(2, 64) | np.uint64(1)
BASE = int(ODD[0])
BACK = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (BASE, BACK):
        steps = np.full(n, factor, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def _hash_segment(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a buffer that does not cut a word."""
    n = len(raw)
    space = np.ones(n + 2, bool)
    space[1:-1] = SPACES[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, end = edges[0::2], edges[1::2]
    powers, back = _powers(max(SEGMENT, 1 << (n + 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTES[raw] * powers[:n], out=sums[1:])
    return start, mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and the number of words of each text."""
    coded = [(text or "").encode() for text in texts]
    raw = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
    ends = np.cumsum([len(c) + 1 for c in coded])
    starts, hashes, at = [], [], 0
    while at < len(raw):
        stop = min(at + SEGMENT, len(raw))
        while stop < len(raw) and not SPACES[raw[stop - 1]]:
            ahead = np.flatnonzero(SPACES[raw[stop : stop + SEGMENT]])
            stop = min(stop + (int(ahead[0]) + 1 if len(ahead) else SEGMENT), len(raw))
        start, hashed = _hash_segment(raw[at:stop])
        starts.append(start + at)
        hashes.append(hashed)
        at = stop
    counts = np.diff(np.searchsorted(np.concatenate(starts), ends), prepend=0)
    return np.concatenate(hashes), counts


def word_numbers(coded: bytes, known: dict[bytes, int]) -> np.ndarray:
    """A number for each word; a long text is split slice by slice, behind white space."""
    parts, at = [], 0
    while at < len(coded):
        end = SPACE.search(coded, at + SLICE)
        stop = end.end() if end else len(coded)
        words = coded[at:stop].split()
        numbers = (known.setdefault(word, len(known)) for word in words)
        parts.append(np.fromiter(numbers, np.int64, len(words)))
        at = stop
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def word_digests(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of all words of all texts in order, a row each,
    and the number of words of each text."""
    known: dict[bytes, int] = {}
    numbers = [word_numbers((text or "").encode().lower(), known) for text in texts]
    raw = b"".join(map(xxhash.xxh3_128_digest, known))
    halves = np.frombuffer(raw, np.uint64).reshape(-1, 2).T
    counts = np.array([len(n) for n in numbers], np.int64)
    return halves[:, np.concatenate([*numbers, np.empty(0, np.int64)])], counts


def _sets(hashes: np.ndarray, counts: np.ndarray, width: int, most: int | None) -> list[np.ndarray]:
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(width, n)):
        rolled[: n - j] += hashes[j:] * ODD[j + 1]
    rolled = mix(rolled)
    out, at = [], 0
    for count in counts.tolist():
        if most is not None and count > most:
            out.append(np.empty(0, np.uint64))
        elif count >= width:
            out.append(np.unique(rolled[at : at + count - width + 1]))
        elif count:
            whole = (hashes[at : at + count] * ODD[1 : count + 1]).sum(dtype=np.uint64)
            out.append(mix(np.array([whole + np.uint64(count)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += count
    return out


def shingle_sets(
    texts: list[str | None], width: int, halves: dict[int, int | None] | None = None
) -> list[list[np.ndarray]]:
    """Sorted hashes of the distinct ``width``-word shingles of every text, for each of the
    independent hashes 0 and 1 asked for; those given a number only for texts of at most as
    many words.

    A text of fewer words than a shingle has its whole sequence as its only
    shingle; a text without words has none. Two shingles agree in one hash with
    a probability of 2**-64, in both of 2**-128.
    """
    digests, counts = word_digests(texts)
    asked = {0: None} if halves is None else halves
    return [_sets(digests[half], counts, width, most) for half, most in asked.items()]
