"""Hashed n-gram indicators of whole texts, computed for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Hashed features.
BITS = 18
#: Texts are worked through in slices of about this many characters; a longer text is a slice of its own.
SLICE_CHARS = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STEPS[2]
    x = (x ^ (x >> np.uint64(32))) * _STEPS[2]
    return x ^ (x >> np.uint64(32))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point up to 0xFFFF: lower case, shape class, space or not.  Later code points keep their number and count as other letters."""
    letters = [chr(c) for c in range(0x10000)]
    lower = np.array([ord(x.lower()) if len(x.lower()) == 1 else c for c, x in enumerate(letters)], dtype=np.uint32)
    shape = np.array([1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else 4 if x.isalpha() else 16 + c for c, x in enumerate(letters)], dtype=np.uint32)
    space = np.zeros(0x10000, dtype=bool)
    space[[32, *range(9, 14)]] = True
    return lower, shape, space


_TABLES: list = []


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end], all at once from prefix sums modulo 2^64."""
    powers = np.full(len(values) + 1, _ODD, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    back = np.full(len(values) + 1, _INVERSE, dtype=np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return _mixed((sums[ends] - sums[starts]) * back[starts])


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for n, text in enumerate(texts):
        if size and size + len(text) > SLICE_CHARS:
            yield begin, n
            begin, size = n, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def indicators(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature), each pair once and in order, for one slice of texts.

    Features are word unigrams and bigrams in lower case, and unigrams to
    trigrams of word shapes (runs of lower case, upper case, digits and letters
    without case become one sign each, other signs stay; a word equal to the one
    before has a shape of its own).
    """
    if not _TABLES:
        _TABLES.extend(_tables())
    lower, shape, space = _TABLES
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    borders = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    low = np.minimum(codes, 0xFFFF)
    far = codes > 0xFFFF
    blank = space[low] & ~far
    kinds = np.where(far, np.uint32(4), shape[low])
    chars = np.where(far, codes, lower[low])
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = _run_hashes(chars, starts, ends)
    turn = np.concatenate(([True], kinds[1:] != kinds[:-1]))
    turn[starts] = True
    turn &= ~blank
    place = np.concatenate(([0], np.cumsum(turn)))
    shapes = _run_hashes(kinds[turn], place[starts], place[ends])
    doc = np.searchsorted(borders, starts, side="right")
    same = np.concatenate(([False], (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])))
    shapes = np.where(same, shapes * _STEPS[0] + np.uint64(1), shapes)

    def chain(parts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        total = parts[: len(parts) - n + 1].copy()
        for k in range(1, n):
            total = total * _STEPS[0] + parts[k : len(parts) - n + 1 + k]
        whole = doc[: len(parts) - n + 1] == doc[n - 1 :]
        return doc[: len(parts) - n + 1][whole], total[whole]

    found = [(*chain(words, n), n) for n in (1, 2) if len(words) >= n] + [(*chain(shapes, n), 10 + n) for n in (1, 2, 3) if len(words) >= n]
    salted = [(d.astype(np.int64), _mixed(h ^ (np.array([salt], dtype=np.uint64) * _STEPS[1]))) for d, h, salt in found]
    keys = [(d << bits) | (h >> np.uint64(64 - bits)).astype(np.int64) for d, h in salted]
    pairs = np.unique(np.concatenate(keys))
    return pairs >> bits, pairs & ((1 << bits) - 1)
