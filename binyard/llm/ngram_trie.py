"""Elias-Fano coded n-gram levels (numpy, vectorised).

A level is a flat run of 64-bit words, so it can be viewed in place: in an
Arrow buffer, or in a memory-mapped file (``EliasFano.view``, ``Trie.view``).
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
#: _ZERO[b, k], _ONE[b, k]: place of the k-th zero, or one, bit of byte b
_ZERO, _ONE = np.full((256, 8), 8, dtype=np.uint8), np.full((256, 8), 8, dtype=np.uint8)
for _b in range(256):
    for _bit, _table in ((0, _ZERO), (1, _ONE)):
        for _k, _p in enumerate([i for i in range(8) if _b >> i & 1 == _bit]):
            _table[_b, _k] = _p


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers in 2 + log2(u/n) bits each.

    Layout in 64-bit words: n, low width, words of the high part, low bits,
    high bits (unary), ones before each word of the high part."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> None:
        self.n, self.width, self.low, self.high, self.rank = n, width, low, high, rank
        self._bytes = high.view(np.uint8)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(_U, copy=False)
        n = len(v)
        top = int(v[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (v >> _U(width)) + np.arange(n, dtype=_U)
        size = (int(bits[-1]) if n else 0) + 2
        high = np.zeros((size + 63) // 64 + 1, dtype=_U)
        if n:
            at = (bits >> _U(6)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            high[at[first]] = np.bitwise_or.reduceat(_U(1) << (bits & _U(63)), first)
        low = np.zeros(n * width // 64 + 2, dtype=_U)
        if n and width:
            part = v & _U((1 << width) - 1)
            place = np.arange(n, dtype=np.int64) * width
            at, off = place >> 6, (place & 63).astype(_U)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            low[at[first]] = np.bitwise_or.reduceat(part << off, first)
            over = np.flatnonzero(off + _U(width) > _U(64))
            low[at[over] + 1] |= part[over] >> (_U(64) - off[over])
        ones = _POP[high.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        rank = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int64)
        return cls(n, width, low, high, rank)

    def tobytes(self) -> bytes:
        head = np.array([self.n, self.width, len(self.high)], dtype=np.int64)
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.rank.tobytes()

    @classmethod
    def view(cls, buffer) -> EliasFano:
        """The sequence in a buffer (bytes, Arrow buffer, ``np.memmap``), not copied."""
        raw = np.frombuffer(buffer, dtype=_U)
        n, width, size = (int(x) for x in raw[:3].view(np.int64))
        a = 3 + n * width // 64 + 2
        return cls(n, width, raw[3:a], raw[a : a + size], raw[a + size : a + 2 * size].view(np.int64))

    def values(self) -> np.ndarray:
        """All of them."""
        place = np.flatnonzero(np.unpackbits(self._bytes, bitorder="little"))[: self.n]
        high = (place - np.arange(self.n)).astype(_U)
        return (high << _U(self.width)) | self._lows(np.arange(self.n, dtype=np.int64))

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=_U)
        place = i * self.width
        at, off = place >> 6, (place & 63).astype(_U)
        x = self.low[at] >> off
        spill = np.where(off > 0, self.low[at + 1] << ((_U(64) - off) & _U(63)), _U(0))
        return (x | spill) & _U((1 << self.width) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The elements at places ``i``, which must exist."""
        i = i.astype(np.int64, copy=False)
        word = np.searchsorted(self.rank, i, side="right") - 1
        left, place, done = i - self.rank[word], np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=bool)
        for byte in range(8):
            b = self._bytes[word * 8 + byte]
            here = _POP[b].astype(np.int64)
            hit = ~done & (left < here)
            place = np.where(hit, word * 64 + byte * 8 + _ONE[b, np.clip(left, 0, 7)], place)
            done |= hit
            left = left - here
        return ((place - i).astype(_U) << _U(self.width)) | self._lows(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many elements have a high part below each of ``high``: the
        place of the high-th zero, less that number."""
        k = high.astype(np.int64) - 1
        some = k >= 0
        zeros = np.arange(len(self.rank), dtype=np.int64) * 64 - self.rank
        word = np.searchsorted(zeros, k, side="right") - 1
        word = np.clip(word, 0, len(self.rank) - 1)
        left = k - zeros[word]
        place = word * 64
        done = ~some
        for byte in range(8):
            b = self._bytes[np.minimum(word * 8 + byte, len(self._bytes) - 1)]
            here = 8 - _POP[b].astype(np.int64)
            hit = ~done & (left < here)
            place = np.where(hit, word * 64 + byte * 8 + _ZERO[b, np.clip(left, 0, 7)], place)
            done |= hit
            left = left - here
        return np.where(some, place + 1 - high.astype(np.int64), 0)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The index of each of ``x`` (of the first of equals), or -1."""
        x = x.astype(_U, copy=False)
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n:
            return out
        high = x >> _U(self.width)
        most = int(self.high.size) * 64
        ok = np.flatnonzero(high < _U(most))
        high, want = high[ok].astype(np.int64), x[ok] & _U((1 << self.width) - 1) if self.width else np.zeros(len(ok), _U)
        a, b = np.minimum(self._before(high), self.n), np.minimum(self._before(high + 1), self.n)
        end = b.copy()
        while True:  # successor search inside the run of one high part
            live = np.flatnonzero(a < b)
            if not len(live):
                break
            mid = (a[live] + b[live]) >> 1
            less = self._lows(mid) < want[live]
            a[live[less]] = mid[less] + 1
            b[live[~less]] = mid[~less]
        hit = np.flatnonzero(a < end)
        hit = hit[self._lows(a[hit]) == want[hit]]
        out[ok[hit]] = a[hit]
        return out


#: Steps of a quantised base-10 logarithm: 1 .. 255 cover 0 .. -10.6.
STEP = 1 / 24


def quantise(p: np.ndarray) -> np.ndarray:
    """Probabilities in (0, 1] to codes 1 .. 255."""
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-300)) / STEP), 0, 254).astype(np.uint8) + np.uint8(1)


def restore(code: np.ndarray) -> np.ndarray:
    """Codes to probabilities; code 0 (not there) to 0."""
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) * STEP), 0.0)


#: Bits of a successor's hash.  Of a million successors of one word, less than
#: one pair is expected to share them.
SUCCESSOR_BITS = 40
SUCCESSOR_MASK = (1 << SUCCESSOR_BITS) - 1


class Trie:
    """A bigram trie in one buffer, read in place (Arrow, ``np.memmap``).

    First level: words (64-bit hashes), their counts, the quantised back-off
    weight of each, and, as a monotone sequence of pointers, where its
    successors start in the level below.  Second level: the successors of all
    words, and for each its quantised smoothed probability, the discounted
    share of its context.

    A successor is coded relative to its context: the numbers of one context
    go on from the last of the context before, so the whole level is one rising
    sequence.  A search takes the context's range from the pointers, adds the
    last number before the range, looks for the sum, and takes what it finds
    only inside the range."""

    def __init__(self, words: EliasFano, count: np.ndarray, backoff: np.ndarray, pointers: EliasFano, successors: EliasFano, code: np.ndarray) -> None:
        self.words, self.count, self.backoff, self.pointers, self.successors, self.code = words, count, backoff, pointers, successors, code

    @staticmethod
    def build(word: np.ndarray, count: np.ndarray, pair: np.ndarray, pair_count: np.ndarray, taken: np.ndarray,
              whole: dict[int, tuple[int, int, int, int]]) -> bytes:
        """``word`` sorted; ``pair`` sorted: (place of the word << 40) +
        successor, with counts above 0.  ``taken``: discounts of counts 0, 1, 2,
        3 and more.  ``whole``: of words whose successors other tries hold too,
        how often they are followed and their numbers of successors with count
        1, 2, 3 and more, over all tries."""
        context, successor = (pair >> _U(SUCCESSOR_BITS)).astype(np.int64), pair & _U(SUCCESSOR_MASK)
        n = np.bincount(context, minlength=len(word))
        follows = np.bincount(context, weights=pair_count, minlength=len(word))
        some = [np.bincount(context[np.minimum(pair_count, 3) == c], minlength=len(word)).astype(np.float64) for c in (1, 2, 3)]
        for h, (total, *own) in whole.items():
            i = int(np.searchsorted(word, _U(h)))
            if i < len(word) and int(word[i]) == h:
                follows[i] = total
                for c in range(3):
                    some[c][i] = own[c]
        share = sum(taken[c + 1] * some[c] for c in range(3)) / np.maximum(follows, 1)
        pointer = np.concatenate(([0], np.cumsum(n)))
        last = pointer[1:][n > 0] - 1
        start = np.concatenate((np.zeros(1, _U), np.cumsum(successor[last] + _U(1), dtype=_U)))[:-1]
        if len(start) >= 1 << (63 - SUCCESSOR_BITS):
            raise ValueError("too many contexts for one trie")
        value = np.repeat(start, n[n > 0]) + successor + _U(1)
        parts = [EliasFano.encode(word).tobytes(), count.astype(np.int64).tobytes(), np.where(share > 0, quantise(share), 0).astype(np.uint8).tobytes(),
                 EliasFano.encode(pointer.astype(_U)).tobytes(), EliasFano.encode(value).tobytes(),
                 quantise((pair_count - taken[np.minimum(pair_count, 3)]) / np.maximum(follows[context], 1)).tobytes()]
        parts = [x + bytes(-len(x) % 8) for x in parts]
        ends = np.cumsum([len(x) for x in parts])
        return np.array([len(word), len(pair), *ends], dtype=np.int64).tobytes() + b"".join(parts)

    @classmethod
    def view(cls, buffer) -> Trie:
        raw = np.frombuffer(buffer, dtype=np.uint8)
        n, m, *ends = raw[:64].view(np.int64).tolist()
        parts = [raw[64 + a : 64 + b] for a, b in zip([0, *ends], ends, strict=False)]
        return cls(EliasFano.view(parts[0]), parts[1].view(np.int64)[:n], parts[2][:n], EliasFano.view(parts[3]), EliasFano.view(parts[4]), parts[5][:m])

    def word(self, h: np.ndarray) -> np.ndarray:
        """Places of words, -1 if unknown."""
        return self.words.find(h)

    def pairs(self, place: np.ndarray, spread: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes (0: not there) of successors: ``spread[i]`` of them for the
        context at ``place[i]``, in order."""
        out = np.zeros(len(successor), dtype=np.uint8)
        if not self.pointers.n or not len(successor):
            return out
        known = np.maximum(place, 0)
        start, end = self.pointers.access(known).astype(np.int64), self.pointers.access(known + 1).astype(np.int64)
        end[place < 0] = start[place < 0]
        base = np.zeros(len(place), dtype=_U)
        some = np.flatnonzero((end > start) & (start > 0))
        base[some] = self.successors.access(start[some] - 1)
        asked = np.repeat(end > start, spread)
        start, end, base = (np.repeat(x, spread)[asked] for x in (start, end, base))
        at = self.successors.find(base + successor[asked].astype(_U) + _U(1))
        seen = (at >= start) & (at < end)
        out[np.flatnonzero(asked)[seen]] = self.code[at[seen]]
        return out


def discounts(count: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2, 3 and more, from the counts."""
    return discounts_of(*((count == c).sum() for c in (1, 2, 3, 4)))


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The same from the counts of counts 1 .. 4."""
    y = n1 / max(n1 + 2 * n2, 1)
    d = [1 - 2 * y * n2 / max(n1, 1), 2 - 3 * y * n3 / max(n2, 1), 3 - 4 * y * n4 / max(n3, 1)]
    return np.array([0.0, *(float(np.clip(x, 0.1 * c, 0.95 * c)) for c, x in zip((1, 2, 3), d, strict=True))])
