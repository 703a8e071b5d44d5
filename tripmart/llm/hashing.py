"""64-bit hashes of words and of word windows, as NumPy arrays."""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

CACHED_WORDS = 80_000
GOLDEN = 0x9E3779B97F4A7C15


class _Words(dict):
    """Hash of a word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = _Words()


def split(text: str | None) -> list[bytes]:
    """Words between ASCII blanks (20, 09 to 0D), unchanged, as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """A random odd number for each byte, 0 for blanks, and powers of an odd number."""
    table = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table, np.cumprod(np.full(1 << 16, GOLDEN, np.uint64))


_BYTE, _POWER = _bytes()


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII blanks of all texts, and where each text's begin.

    Sums over the bytes of a word, by array operations over all texts; other numbers
    than those of ``word_hashes``. Wants texts of about 100 kB in all, so that arrays stay in cache.
    """
    joined = b" ".join(texts) + b" "
    buffer = np.frombuffer(joined, np.uint8)
    value = _BYTE[buffer]
    word = value != 0
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    if word[0]:
        starts = np.concatenate([[0], starts])
    edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    if not len(starts):
        return np.empty(0, np.uint64), edges
    low = starts[0]
    place = np.arange(low, len(buffer)) - np.repeat(starts, np.diff(np.append(starts, len(buffer))))
    return mixed(np.add.reduceat(value[low:] * _POWER[place & 0xFFFF], starts - low)), edges


@cache
def _steps(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``1 << bits`` powers of an odd number, and what undoes them."""
    steps = np.full((2, 1 << bits), 1, np.uint64)
    steps[0, 1:], steps[1, 1:] = GOLDEN, pow(GOLDEN, -1, 1 << 64)
    return tuple(np.cumprod(steps, axis=1))


def byte_values(kept: set[int] | frozenset[int] | bytes) -> np.ndarray:
    """A random odd number for each byte ``kept``, A-Z with that of a-z; 0 for the others, which part words."""
    table = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    table[0x41:0x5B] = table[0x61:0x7B]
    table[[b for b in range(256) if b not in kept]] = 0
    return table


def spellings(buffer: np.ndarray, value: np.ndarray, beginnings: list[int]) -> tuple[np.ndarray, np.ndarray, list]:
    """Starts and hashes of the words in ``buffer``; for each of ``beginnings`` which words have more code points, and the hashes of so many.

    By array operations over the bytes, whose ``value`` 0 parts words. Beginnings have the hashes that they have as words.
    """
    of_bytes = value[buffer]
    edges = np.flatnonzero(np.diff(of_bytes != 0, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    bits = max(17, len(buffer).bit_length())
    powers, undone = (_steps if bits <= 20 else _steps.__wrapped__)(bits)
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(of_bytes * powers[: len(buffer)], out=total[1:])
    back, before = undone[starts], total[starts]
    found = []
    if beginnings and len(starts):
        lead = (buffer & 0xC0) != 0x80
        first, lead = np.cumsum(lead, dtype=np.int32)[starts] - 1, np.flatnonzero(lead)
        for n in beginnings:
            stop = lead[np.minimum(first + n, len(lead) - 1)]
            longer = np.flatnonzero((first + n < len(lead)) & (stop < ends))
            found.append((longer, mixed((total[stop[longer]] - before[longer]) * back[longer])))
    return starts, mixed((total[ends] - before) * back), found


class Numbers:
    """Numbers of hashes, looked up for whole arrays; -1 for those not held. Twice held, a hash has the later number."""

    def __init__(self, hashes: np.ndarray, first: int = 0) -> None:
        self.hashes, self.first, bits = hashes, first, max(4, (2 * len(hashes)).bit_length())
        self.shift, self.owner = np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)
        left, place = np.arange(len(hashes), dtype=np.int32), (hashes >> self.shift).astype(np.int64)
        while len(left):
            free = self.owner[place] < 0
            self.owner[place[free]] = left[free]
            lost = self.owner[place] != left
            left, place = left[lost], (place[lost] + 1) & (len(self.owner) - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found, left = np.full(len(hashes), -1), np.arange(len(hashes))
        place = (hashes >> self.shift).astype(np.int64)
        while len(left):
            owner = self.owner[place]
            some = owner >= 0
            left, place, owner = left[some], place[some], owner[some]
            hit = self.hashes[owner] == hashes[left]
            found[left[hit]] = owner[hit] + self.first
            left, place = left[~hit], (place[~hit] + 1) & (len(self.owner) - 1)
        return found


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int, factor: int = GOLDEN) -> np.ndarray:
    """Hash of every run of ``size`` word hashes, by its first word; depends on their order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for j in range(1, size):
        total *= np.uint64(factor | 1)
        total += hashes[j : j + n]
    return mixed(total)
