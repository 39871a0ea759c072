"""Hashing the words of many texts at once, with numpy inside Spark tasks.

The bytes of a group of texts are laid out one after another. A running sum of
(random value of the byte) * B^position, modulo 2^64, gives the hash of any
stretch as the difference of two sums times a power of 1/B, so all words, or
parts of words, are hashed without a loop over them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

#: Texts are hashed in groups of about so many bytes, to bound memory.
GROUP_BYTES = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_WHITE = [0x20, *range(0x09, 0x0E)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = []


def _tables_for(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least; kept and grown."""
    if not _TABLES or len(_TABLES[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _TABLES[:] = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    return _TABLES


class Stretches:
    """Hashes of stretches of a sequence, from the values of its elements."""

    def __init__(self, values: np.ndarray) -> None:
        power, self._inverse = _tables_for(len(values) + 1)
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(values * power[: len(values)], dtype=np.uint64)])

    def between(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._inverse[start])


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@cache
def ascii_fold() -> np.ndarray:
    """A to Z in lower case, other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@cache
def white_space() -> np.ndarray:
    """Which bytes separate words: white space only."""
    table = np.zeros(256, dtype=bool)
    table[_WHITE] = True
    return table


@cache
def not_alphanumeric() -> np.ndarray:
    """Which bytes separate words: all of ASCII but letters and digits."""
    table = np.ones(256, dtype=bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = False
    return table


@dataclass
class Words:
    """Words of a group of texts in order. ``row`` is the text's place in the
    group, ``start`` and ``end`` are byte offsets within the text."""

    row: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    prefixes: list[np.ndarray]


def groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into ranges of about ``GROUP_BYTES``."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > GROUP_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _pieces(texts: list[bytes], separators: np.ndarray) -> Iterator[list[tuple[int, int, bytes]]]:
    """Batches of (row, offset, bytes). A very long text is cut between words."""
    batch: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            piece = text[at : at + GROUP_BYTES]
            if at + len(piece) < len(text):
                cuts = np.flatnonzero(separators[np.frombuffer(piece, np.uint8)])
                if not len(cuts):  # one word longer than a piece: keep it whole
                    rest = np.flatnonzero(separators[np.frombuffer(text, np.uint8)[at:]])
                    piece = text[at : at + int(rest[0]) + 1] if len(rest) else text[at:]
                else:
                    piece = piece[: int(cuts[-1]) + 1]
            if batch and size + len(piece) > GROUP_BYTES:
                yield batch
                batch, size = [], 0
            batch.append((row, at, piece))
            size += len(piece) + 1
            at += len(piece)
    if batch:
        yield batch


def words_of(
    texts: list[bytes],
    separators: np.ndarray,
    fold: np.ndarray | None = None,
    prefix_lengths: tuple[int, ...] = (),
) -> Words:
    """Words of a group of texts. With ``prefix_lengths`` also the hashes of
    each word's first bytes (the whole word's where it is not longer)."""
    out: list[tuple] = []
    for batch in _pieces(texts, separators):
        buffer = b"\n".join(piece for _, _, piece in batch) + b"\n"
        raw = np.frombuffer(buffer, np.uint8)
        inside = ~separators[raw]
        turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        start, end = turns[0::2], turns[1::2]
        if not len(start):
            continue
        lengths = np.array([len(piece) + 1 for _, _, piece in batch])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        piece_of = np.searchsorted(first, start, "right") - 1
        letters = Stretches(_byte_values()[raw if fold is None else fold[raw]])
        shift = np.array([at for _, at, _ in batch]) - first
        out.append(
            (
                np.array([row for row, _, _ in batch])[piece_of],
                letters.between(start, end),
                start + shift[piece_of],
                end + shift[piece_of],
                [letters.between(start, np.minimum(start + n, end)) for n in prefix_lengths],
            )
        )
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none.astype(np.uint64), none, none, [none.astype(np.uint64)] * len(prefix_lengths))
    row, hashes, start, end = (np.concatenate([x[i] for x in out]) for i in range(4))
    prefixes = [np.concatenate([x[4][i] for x in out]) for i in range(len(prefix_lengths))]
    return Words(row, hashes, start, end, prefixes)


def shingles_of(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles: (row, hash), sorted by row and hash.

    Words are separated by white space, with A to Z in lower case. A text with
    fewer words than ``width`` has its whole sequence as one shingle.
    """
    words = words_of(texts, white_space(), ascii_fold())
    rows, found = [], []
    counts = np.bincount(words.row, minlength=len(texts))
    if len(words.row) >= width:
        n = len(words.row) - width + 1
        whole = words.row[:n] == words.row[width - 1 :]
        acc = np.zeros(n, dtype=np.uint64)
        for i in range(width):
            acc = mix(acc * np.uint64(_BASE) + words.hash[i : i + n])
        rows.append(words.row[:n][whole])
        found.append(acc[whole])
    short = (counts > 0) & (counts < width)
    if short.any():
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
        for r in np.flatnonzero(short):
            acc = np.full(1, counts[r], dtype=np.uint64)
            for h in words.hash[begin[r] : begin[r] + counts[r]]:
                acc = mix(acc * np.uint64(_BASE) + h)
            rows.append(np.array([r]))
            found.append(acc)
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    row, shingle = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    return row[new], shingle[new]
