"""Character n-grams of words, hashed into buckets with array operations."""

from __future__ import annotations

import numpy as np

from .common import byte_values, mix, range_hash

SIZES = (3, 4, 5, 6)
STRIP = b"".join(bytes([b]) for b in range(0x21, 0x7F) if not chr(b).isalnum())


def normal(word: bytes) -> bytes:
    """A whitespace-delimited word, already in lower case, without punctuation around it."""
    return word.strip(STRIP)


def subword_buckets(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' n-grams and of the words themselves, and where each word's begin."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8)
    values, ends = byte_values()[data], np.cumsum(sizes)
    starts = ends - sizes
    owner, found = [np.arange(len(words))], [mix(range_hash(values, starts, ends))]
    left = np.repeat(ends, sizes) - np.arange(len(data))
    word_of = np.repeat(np.arange(len(words)), sizes)
    for n in SIZES:
        at = np.flatnonzero(left >= n)
        owner.append(word_of[at])
        found.append(range_hash(values, at, at + n))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return (found[order] % np.uint64(buckets)).astype(np.int64), np.concatenate([[0], np.cumsum(counts)])
