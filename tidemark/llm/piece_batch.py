"""Best paths of many words side by side, in numpy.

Place by place from the left, every word takes the last piece of its beginning: the first of its
candidates, from the shortest on, that fits the piece before it (see ``piece_scan``). Substrings are
looked up by a rolling hash in one table of pieces and their endings, pairs of neighbours in a table of
the pairs judged so far. Words longer than ``LONGEST`` are left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LONGEST = 64
BLOCK = 8_192
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64(np.iinfo(np.int64).min)
_CHARS = 21  # bits of a piece number: pieces first, then characters without a piece


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, one row each, and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    out = np.zeros((len(words), int(sizes.max(initial=0))), dtype=np.uint32)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = points
    return out, sizes


def _hashes(points: np.ndarray) -> np.ndarray:
    """Rolling hash of every beginning: one column more than there are characters."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), dtype=np.uint64)
    for i in range(points.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + points[:, i] + np.uint64(1)
    return out


class Numbers:
    """Numbers by 64-bit keys: open addressing, a quarter full at most, looked up side by side."""

    def __init__(self, bits: int = 12):
        self.used, self.bits = 0, bits
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.full(1 << bits, _NONE, dtype=np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        out = self.values[slot]
        open_ = np.flatnonzero((out != _NONE) & (self.keys[slot] != keys))
        while open_.size:
            slot[open_] = (slot[open_] + 1) & (self.keys.size - 1)
            at = slot[open_]
            out[open_] = self.values[at]
            open_ = open_[(self.values[at] != _NONE) & (self.keys[at] != keys[open_])]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are different from each other and from all before."""
        if 4 * (self.used + keys.size) > self.keys.size:
            held = self.values != _NONE
            old = self.keys[held], self.values[held]
            self.__init__(int(8 * (self.used + keys.size)).bit_length())
            self.put(*old)
        self.used += keys.size
        slot = self._slots(keys)
        while keys.size:
            _, first = np.unique(slot, return_index=True)  # one key a free slot
            free = first[self.values[slot[first]] == _NONE]
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            left = np.ones(keys.size, dtype=bool)
            left[free] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & (self.keys.size - 1)


class WordPaths:
    """Paths of words over the pieces of a model. ``apart(left, right)`` judges a pair of pieces."""

    def __init__(self, ids: dict[str, int], suffixes: set[str], longest: int, byte_ids: list[int],
                 apart: Callable[[str, str], bool]):
        self.apart, self.longest, self.byte_ids, self.size = (
            apart, longest, byte_ids, max(ids.values(), default=0) + 1)
        self.text = {i: p for p, i in ids.items()}
        strings = sorted(suffixes.union(ids))
        points, sizes = _matrix(strings)
        keys = np.take_along_axis(_hashes(points), sizes[:, None], axis=1)[:, 0]
        # twice the piece's number, or -2 where there is only an ending, plus 1 if longer ones go on
        self.pieces = Numbers()
        self.pieces.put(keys, np.array(
            [2 * ids.get(s, -1) + (s in suffixes) for s in strings], dtype=np.int64))
        self.powers = np.ones(longest + 1, dtype=np.uint64)
        np.cumprod(np.full(longest, _BASE), out=self.powers[1:])
        self.pairs = Numbers(16)

    def _string(self, number: int) -> str:
        return self.text[number] if number < self.size else chr(number - self.size)

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = (left << _CHARS | right).astype(np.uint64)
        fits = self.pairs.get(pair)
        new = np.unique(pair[fits == _NONE])
        if new.size:
            mask = (1 << _CHARS) - 1
            self.pairs.put(new, np.array(
                [self.apart(self._string(p >> _CHARS), self._string(p & mask)) for p in new.tolist()],
                dtype=np.int64))
            fits = self.pairs.get(pair)
        return fits == 1

    def _block(self, words: list[str]) -> list[bytes | None]:
        points, sizes = _matrix(words)
        hashed = _hashes(points)
        n, width = points.shape
        last = np.full((n, width + 1), -1, dtype=np.int32)
        step = np.ones((n, width + 1), dtype=np.int32)
        for end in range(1, width + 1):
            rows = np.flatnonzero(sizes >= end)
            for size in range(1, min(self.longest, end) + 1):
                if not rows.size:
                    break
                key = hashed[rows, end] - hashed[rows, end - size] * self.powers[size]
                found = self.pieces.get(key)
                piece = found >> 1
                if size == 1:
                    piece = np.where(piece < 0, self.size + points[rows, end - 1].astype(np.int64), piece)
                able = piece >= 0
                if size < end:
                    left = last[rows, end - size].astype(np.int64)
                    able &= left >= 0
                    able[able] = self._fit(left[able], piece[able])
                taken = rows[able]
                last[taken, end], step[taken, end] = piece[able], size
                more = ~able if size == 1 else ~able & (found != _NONE) & (found & 1 == 1)
                rows = rows[more]
        whole = last[np.arange(n), sizes] >= 0
        out = np.zeros((n, width), dtype=np.int32)
        count = np.zeros(n, dtype=np.int64)
        place = np.where(whole, sizes, 0)
        known = whole.copy()
        rows = np.flatnonzero(place)
        while rows.size:
            piece = last[rows, place[rows]]
            known[rows] &= piece < self.size
            out[rows, count[rows]] = piece
            count[rows] += 1
            place[rows] -= step[rows, place[rows]]
            rows = rows[place[rows] > 0]
        return [row[:c][::-1].tobytes() if k else self._in_bytes(row[:c][::-1]) if w else None
                for row, c, k, w in zip(out, count.tolist(), known.tolist(), whole.tolist(), strict=True)]

    def _in_bytes(self, numbers: np.ndarray) -> bytes:
        """Ids with byte pieces for the characters that have no piece."""
        ids: list[int] = []
        for n in numbers.tolist():
            if n < self.size:
                ids.append(n)
            else:
                ids.extend(self.byte_ids[b] for b in chr(n - self.size).encode())
        return np.array(ids, dtype=np.int32).tobytes()

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of the words, as 32-bit numbers; words that are left to the caller are missing."""
        able = sorted((w for w in words if 0 < len(w) <= LONGEST), key=len)
        out: dict[str, bytes] = {}
        for i in range(0, len(able), BLOCK):
            part = able[i:i + BLOCK]
            out.update((w, b) for w, b in zip(part, self._block(part), strict=True) if b is not None)
        return out
