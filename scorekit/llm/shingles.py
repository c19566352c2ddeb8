"""Sets of word shingles as hashes, and MinHash signatures of them."""

import hashlib

import numpy as np
import xxhash

from scorekit.llm.batches import Memo

# Words to a shingle.
WORDS = 5

# Components of a signature, 16 bits each.
COMPONENTS = 64

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(11)
_FACTORS = (_RANDOM.integers(0, 1 << 63, (COMPONENTS, 1), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, (COMPONENTS, 1), dtype=np.uint64)


def word_memo() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def shingles(text: bytes, memo: Memo) -> np.ndarray:
    """The distinct hashes of the shingles of a text in UTF-8, sorted.

    A-Z are lower-cased and words are what lies between ASCII white space, which is what bytes do. A
    text with fewer than `WORDS` words has its whole sequence as one shingle, without words none.
    """
    words = text.lower().split()
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    count = len(words) - WORDS + 1
    if not words:
        return hashes
    if count < 1:
        total = np.full(1, len(words), np.uint64)
        for h in hashes:
            total = total * _PRIME + h
        return mix(total)
    total = hashes[:count]
    for i in range(1, WORDS):
        total = total * _PRIME + hashes[i : i + count]
    return np.unique(mix(total))


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def signature(hashes: np.ndarray) -> np.ndarray:
    """`COMPONENTS` numbers of 16 bits. In two sets of similarity J each is equal with chance J, or a
    little more, as different minima may agree in 16 bits."""
    lowest = np.full(COMPONENTS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for start in range(0, len(hashes), 2048):
        values = _FACTORS * hashes[None, start : start + 2048] + _OFFSETS
        np.minimum(lowest, values.min(axis=1), out=lowest)
    return (mix(lowest) >> np.uint64(48)).astype("<u2")


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def linked(common: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of the given sizes with that much in common are similar enough."""
    return 100 * common >= percent * (left + right - common)
