"""Words, word hashes and shingles of whole texts, worked on in numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from crmtide.llm.common import chunks

SHINGLE = 5
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on all bits of ``x`` and the seed."""
    x = x + np.uint64((seed * int(_GOLDEN) + int(_GOLDEN)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def lower_bytes(texts: Sequence[str | None]) -> list[bytes]:
    """UTF-8 with A-Z lowered; NULL is empty. bytes.split() then cuts at space and tab to carriage return."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]


def lowered(texts: pa.Array, most: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of ``texts`` of about ``most`` bytes each, with their texts as ``lower_bytes``; only one is held at a time."""
    for a, b in chunks(pc.binary_length(texts).fill_null(0).to_pylist(), most):
        yield a, b, lower_bytes(texts.slice(a, b - a).to_pylist())


def hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    array = np.empty(len(words), object)
    array[:] = words
    return pd.util.hash_array(array, categorize=False)


def hashed(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts in turn, first word of each text and the end)."""
    words: list[bytes] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words += t.split()
        bounds[i + 1] = len(words)
    return hashes(words), bounds


def shingles(word: np.ndarray) -> np.ndarray:
    """A hash for every five words in a row, at the place of the first; the last four places are void."""
    out = mix(word, 1)
    for k in range(1, SHINGLE):
        out[: len(word) - k] = mix(out[: len(word) - k] ^ mix(word[k:], k + 1))
    return out


def shingle_set(word: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of one text; of fewer than five words, the whole sequence as one."""
    if len(word) >= SHINGLE:
        return np.unique(run[: len(word) - SHINGLE + 1])
    if not len(word):
        return np.empty(0, np.uint64)
    whole = np.uint64(len(word))
    for w in word:
        whole = mix(np.array([w]) ^ mix(np.array([whole])), 99)[0]
    return np.array([whole], np.uint64)


def sets(texts: Sequence[bytes]) -> list[np.ndarray]:
    word, bounds = hashed(texts)
    run = shingles(word)
    return [shingle_set(word[a:b], run[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard of 0.75 or more of two sorted sets, in whole numbers."""
    if not len(a) or not len(b) or 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)
