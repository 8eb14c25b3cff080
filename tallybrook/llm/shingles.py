"""Hashes of words and of word shingles, for many texts at once.

Texts are UTF-8 bytes. A word is a run of bytes other than space and \\t to \\r. A word's hash is a
polynomial over its bytes modulo 2**64, taken from running sums, so that numpy handles a whole
portion of texts in a few passes; it is then mixed. A shingle's hash combines those of its words.
"""

import re
from collections.abc import Iterator

import numpy as np

from tallybrook.llm.common import BATCH_BYTES, portions

_U = np.uint64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = odd_numbers(256, 11)
_LOWERED = _VALUE.copy()
_LOWERED[65:91] = _VALUE[97:123]
_BASE = int(odd_numbers(1, 12)[0])
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACE = odd_numbers(64, 13)


def _powers(base: int, n: int, kept: dict = {}) -> np.ndarray:
    if len(kept.get(base, ())) < n:
        steps = np.full(max(n, 2 * BATCH_BYTES), base, dtype=_U)
        steps[0] = 1
        kept[base] = np.cumprod(steps, dtype=_U)
    return kept[base][:n]


def _hash_words(data: bytes, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``data``, which must end with white space."""
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _IS_SPACE[raw]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        change = np.concatenate(([0], change))
    starts, ends = change[0::2], change[1::2]
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum(value[raw] * _powers(_BASE, len(raw)), out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * _powers(_UNBASE, len(raw))[starts])


def _slices(text: bytes) -> list[bytes]:
    """A long text cut between words, so that no step needs memory for all of it."""
    if len(text) <= BATCH_BYTES:
        return [text]
    out, at = [], 0
    while len(text) - at > BATCH_BYTES and (found := _SPACE.search(text, at + BATCH_BYTES)):
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


def word_hashes(texts: list[bytes], lower: bool = True) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    value = _LOWERED if lower else _VALUE
    for began, ended in portions(texts):
        part = texts[began:ended]
        if len(part) == 1 and len(part[0]) > BATCH_BYTES:
            yield np.concatenate([_hash_words(x + b" ", value)[1] for x in _slices(part[0])])
            continue
        starts, hashes = _hash_words(b" ".join(part) + b" ", value)
        at = np.cumsum([0, *(len(x) + 1 for x in part)])
        cuts = np.searchsorted(starts, at)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield hashes[i:j]


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words, their whole sequence."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    total = words[: n - width + 1] * _PLACE[0]
    for k in range(1, width):
        total = total + words[k : n - width + 1 + k] * _PLACE[k]
    return np.unique(mix(total + _U(width)))


def shingle_sets(texts: list[bytes], size: int = 5) -> Iterator[np.ndarray]:
    for words in word_hashes(texts):
        yield shingle_set(words, size)
