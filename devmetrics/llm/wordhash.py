"""Words of many texts at once: places and 64-bit hashes in numpy, and a memory of what was worked out per word.

Operators whose per-word work is dear (tokenizing, language models) do it once per distinct word of a task; the
memory is bounded and is emptied when full, which changes time but no result. Words are told apart by a 64-bit
polynomial hash, so that two different words meet with a probability of about n^2 / 2^65 for n distinct words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np

_ODD = 0x9E3779B97F4A7C15 | 1
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)

#: Bytes of words made of letters: ASCII letters and all bytes of other characters.
LETTERS = np.array([chr(b).isalpha() or b >= 0x80 for b in range(128)] + [True] * 128)
#: ASCII lower-casing, byte by byte.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        n = max(n, 2 * len(_POWERS))
        found = []
        for base in (_ODD, pow(_ODD, -1, 2**64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            found.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS, _INVERSES = found
    return _POWERS, _INVERSES


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """sums[i] covers symbols[:i], modulo 2^64."""
    powers, _ = _powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers[:len(symbols)], dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each symbols[start:end], wherever it stands; never 0."""
    _, inverses = _powers(len(sums))
    found = (sums[ends] - sums[starts]) * inverses[starts]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return np.where(found == 0, np.uint64(1), found)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value for each 64-bit value (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(texts: Iterable[str | None], size: int = 1 << 18) -> Iterator[list[tuple[int, str]]]:
    """Lists of (text's number, piece) of about ``size`` characters: many short texts, or parts of a long one.

    A text over ``size`` is cut before a line feed, else before a space; where it has none, the part is as long as need be."""
    held: list[tuple[int, str]] = []
    n = 0
    for i, text in enumerate(texts):
        text, at = text or "", 0
        while True:
            end = len(text)
            if end - at > size:
                end = text.rfind("\n", at + 1, at + size)
                if end < 0:
                    end = text.rfind(" ", at + 1, at + size)
                if end < 0:
                    end = min([x for x in (text.find("\n", at + size), text.find(" ", at + size)) if x >= 0], default=len(text))
            held.append((i, text[at:end]))
            n += end - at
            at = end
            if n >= size:
                yield held
                held, n = [], 0
            if at >= len(text):
                break
    if held:
        yield held


class ByteWords:
    """Maximal runs of word bytes in some pieces of texts; ``which`` is the piece of each word."""

    def __init__(self, texts: list[str], is_word: np.ndarray = LETTERS, lower: bool = True):
        data = [t.encode("utf-8", "replace") for t in texts]
        self.raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
        self.buf = LOWER[self.raw] if lower else self.raw
        flags = is_word[self.raw]
        edges = np.flatnonzero(flags[1:] != flags[:-1]) + 1
        if flags[0]:
            edges = np.append(0, edges)
        self.starts, self.ends = edges[::2], edges[1::2]
        self.lengths = np.array([len(d) + 1 for d in data], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.which = np.searchsorted(self.offsets, self.starts, "right") - 1

    def hashes(self) -> np.ndarray:
        return span_hashes(prefix_sums(self.buf), self.starts, self.ends)


class Memo:
    """Rows of a table worked out once for each distinct hash, while there is room."""

    def __init__(self, make: Callable[[np.ndarray], np.ndarray], width: int, dtype=np.float32, bits: int = 20):
        """make: gets places of words to work out, returns their rows."""
        self.make, self.bits, self.room = make, bits, 1 << (bits - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.slots = np.zeros(1 << bits, np.int32)
        self.rows = np.zeros((self.room, width), dtype)
        self.n = 0

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(_ODD)) >> np.uint64(64 - self.bits)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        found, slot, rest = np.full(len(hashes), -1, np.int64), self._slot(hashes), np.arange(len(hashes))
        last = np.uint64((1 << self.bits) - 1)
        while len(rest):
            keys = self.keys[slot]
            hit = keys == hashes[rest]
            found[rest[hit]] = self.slots[slot[hit]]
            on = ~hit & (keys != 0)
            rest, slot = rest[on], (slot[on] + np.uint64(1)) & last
        return found

    def _add(self, hashes: np.ndarray) -> None:
        """Distinct hashes that are not there yet."""
        slot, rest, last = self._slot(hashes), np.arange(len(hashes)), np.uint64((1 << self.bits) - 1)
        while len(rest):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[rest[free]]
            won = self.keys[slot] == hashes[rest]
            self.slots[slot[won]] = self.n + rest[won]
            rest, slot = rest[~won], (slot[~won] + np.uint64(1)) & last
        self.n += len(hashes)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The row number of each hash."""
        found = self.find(hashes)
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        distinct, first, again = np.unique(hashes[new], return_index=True, return_inverse=True)
        if self.n + len(distinct) > self.room:
            self.keys[:], self.n = 0, 0
            new = np.arange(len(hashes))
            distinct, first, again = np.unique(hashes, return_index=True, return_inverse=True)
            if len(distinct) > self.room:
                self.bits = int(len(distinct)).bit_length() + 1
                self.room = 1 << (self.bits - 1)
                self.keys, self.slots = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
                self.rows = np.zeros((self.room, self.rows.shape[1]), self.rows.dtype)
        self.rows[self.n:self.n + len(distinct)] = self.make(new[first])
        found[new] = self.n + again
        self._add(distinct)
        return found
