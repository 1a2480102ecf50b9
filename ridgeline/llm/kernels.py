"""Numpy work on the words of one text or one batch, as used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
MOST_WORDS_KEPT = 1 << 18


class WordHashes(dict):
    """64-bit hash of a word, remembered; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U, count=len(words))


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


#: A-Z to a-z; every other ASCII character that is no letter or digit to a space.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` word hashes, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    g = np.full(n, U(k))
    for j in range(k):
        g = mixed(g * ODD + h[j:j + n])
    return g


def pieces(batch: pa.RecordBatch, text: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most_bytes`` of text, so one task holds little at a time."""
    column = batch.column(batch.schema.get_field_index(text))
    start, held = 0, 0
    for i, x in enumerate(column):
        held += len(x.as_buffer()) if x.is_valid else 0
        if held >= most_bytes:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


# A fixed-size bitmap of hashes: it may let a value through that was not put in, but never stops one that was.

def bit_words(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a bitmap of 2 ** bits bits that the hashes touch, and what to set in them."""
    at = np.unique(mixed(values.astype(U)) >> U(64 - bits))
    word = at >> U(6)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, int)
    one = U(1) << (at & U(63))
    return word[first].astype(np.int64), np.bitwise_or.reduceat(one, first) if len(first) else np.zeros(0, U)


def in_bitmap(bitmap: np.ndarray, bits: int, values: np.ndarray) -> np.ndarray:
    at = mixed(values.astype(U)) >> U(64 - bits)
    return (bitmap[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == U(1)
