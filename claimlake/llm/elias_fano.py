"""Elias-Fano sequences and the n-gram trie made of them: compact levels, opened by memory mapping."""

from __future__ import annotations

import numpy as np

#: Logarithms of probabilities are kept in steps of 1 / STEPS of a decade; NEVER stands for probability 0.
STEPS, NEVER = 256, 65535
#: Discounts of counts 1, 2 and 3 or more where the counts of counts leave them undefined.
FALLBACK = (0.5, 1.0, 1.5)


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        code = np.rint(-np.log10(p) * STEPS)
    return np.where(p > 0, np.minimum(code, NEVER - 1), NEVER).astype(np.uint16)


_VALUES = np.append(10.0 ** (-np.arange(NEVER) / STEPS), 0.0)


def restored(codes: np.ndarray) -> np.ndarray:
    return _VALUES[codes]


class EliasFano:
    """A non-decreasing sequence below a universe: low bits packed, high bits in unary with a count of zeros before each word.

    About 2 + log2(universe / n) bits a value. place(x): where x would stand, by the zeros that close x's high part and
    a search among the low bits of that part alone.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros
        self.unaligned = np.ndarray((max(0, len(low) - 7),), "<u8", low, strides=(1,))
        self.mask = np.uint64((1 << low_bits) - 1)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, min(56, (max(universe, 1) // max(n, 1)).bit_length() - 1))
        unary = np.zeros(-(-(n + (universe >> bits) + 2) // 64) * 64, np.uint8)
        unary[(values >> bits) + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view(np.uint64)
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))[:-1]])
        low = []
        for at in range(0, n if bits else 0, 1 << 16):  # eight values end on a whole byte
            part = values[at : at + (1 << 16)]
            low.append(np.packbits((part[:, None] >> np.arange(bits) & 1).astype(np.uint8).ravel(), bitorder="little"))
        return cls(n, bits, np.concatenate([*low, np.zeros(8, np.uint8)]), high, zeros)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits]), self.low, self.high, self.zeros]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        return self.unaligned[at >> 3] >> (at & 7).astype(np.uint64) & self.mask

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Where the zero number k stands among the high bits."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        left, bits, at = k - self.zeros[word], ~self.high[word], word * 64
        for width in (32, 16, 8, 4, 2, 1):
            own = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            on = left >= own
            left = left - on * own
            bits = bits >> (on * width).astype(np.uint64)
            at = at + on * width
        return at

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x: how many values are smaller, and whether the next value is x."""
        if not self.n or not len(x):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high, low = x >> self.low_bits, x.astype(np.uint64) & self.mask
        last = len(self.high) * 64 - self.n - 1  # zeros in all, less one
        beyond = high > last
        high = np.minimum(high, last)
        a = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - (high - 1), 0)
        b = self._zero(high) - high
        b[beyond] = a[beyond] = self.n
        end = b.copy()
        while (open_ := np.flatnonzero(a < b)).size:
            mid = (a[open_] + b[open_]) >> 1
            less = self._low(mid) < low[open_]
            a[open_] = np.where(less, mid + 1, a[open_])
            b[open_] = np.where(less, b[open_], mid)
        found = a < end
        found[found] = self._low(a[found]) == low[found]
        return a, found

    def all(self) -> np.ndarray:
        """The whole sequence."""
        ones = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little"))[: self.n]
        return (ones - np.arange(self.n)) << self.low_bits | self._low(np.arange(self.n)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values by their place."""
        ends = 64 * np.arange(len(self.zeros)) - self.zeros  # ones before each word
        word = np.searchsorted(ends, i, "right") - 1
        left, bits, at = i - ends[word], np.asarray(self.high)[word], word * 64
        for width in (32, 16, 8, 4, 2, 1):
            own = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            on = left >= own
            left, bits, at = left - on * own, bits >> (on * width).astype(np.uint64), at + on * width
        return (at - i) << self.low_bits | self._low(i).astype(np.int64)


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, and 3 or more; FALLBACK where the counts of counts leave one undefined."""
    n1, n2, n3, n4 = (int((counts == k).sum()) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return np.array([0.0, *FALLBACK])
    y = n1 / (n1 + 2 * n2)
    return np.array([0.0, *(min(k - 0.05, max(0.05, k - (k + 1) * y * b / a)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))])


def runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


class Trie:
    """Interpolated modified Kneser-Ney n-grams (context root, word before it, word) in Elias-Fano levels.

    roots -> what follows each, in id order (with pointers to where a root's begin) and the words seen before each ->
    n-grams, whose last word is its place among what follows the root, not its id. Values: quantised discounted shares
    of n-grams, and what a context leaves to the shorter one.
    """

    SEQUENCES = ("roots", "pointers", "follow", "contexts", "grams")
    VALUES = ("root_left", "follow_share", "context_left", "gram_share")

    def __init__(self, ids: int, places: int, levels: dict[str, EliasFano], values: dict[str, np.ndarray]):
        self.ids, self.places, self.levels, self.values = ids, places, levels, values

    @classmethod
    def build(cls, root: np.ndarray, before: np.ndarray, word: np.ndarray, count: np.ndarray) -> Trie:
        """Of distinct n-grams in order of (root, before, word), each counted once or more."""
        ids = int(max(before.max(initial=0), word.max(initial=0))) + 1
        first = runs(root)
        roots = root[first]
        of_root = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(root))))
        # A shorter n-gram counts the words that stand before it.
        pairs, kinds = np.unique(of_root * ids + word, return_counts=True)
        begins = np.searchsorted(pairs, np.arange(len(roots) + 1) * ids)
        follow_share, root_left = cls._smoothed(kinds, begins[:-1])
        context = of_root * ids + before
        starts = runs(context)
        gram_share, context_left = cls._smoothed(count, starts)
        place = np.searchsorted(pairs, of_root * ids + word) - begins[of_root]
        places = int(place.max(initial=0)) + 1
        of_context = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(root))))
        sequences = {
            "roots": (roots, int(roots.max(initial=0)) + 1),
            "pointers": (begins, len(pairs) + 1),
            "follow": (pairs, max(1, len(roots)) * ids),
            "contexts": (context[starts], max(1, len(roots)) * ids),
            "grams": (of_context * places + place, max(1, len(starts)) * places),
        }
        values = dict(zip(cls.VALUES, map(quantised, (root_left, follow_share, context_left, gram_share)), strict=True))
        return cls(ids, places, {k: EliasFano.of(*sequences[k]) for k in cls.SEQUENCES}, values)

    @staticmethod
    def _smoothed(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each count's discounted share of its context, and what discounts leave in each context. starts: the contexts' first counts."""
        if not len(counts):
            return np.zeros(0), np.zeros(0)
        off = discounts(counts)[np.minimum(counts, 3)]
        total = np.add.reduceat(counts, starts)
        sizes = np.diff(np.append(starts, len(counts)))
        return (counts - off) / np.repeat(total, sizes), np.add.reduceat(off, starts) / total

    def write(self, path: str) -> None:
        arrays = [np.array([self.ids, self.places])]
        for k in self.SEQUENCES:
            arrays += self.levels[k].arrays()
        arrays += [self.values[k] for k in self.VALUES]
        with open(path, "wb") as f:
            f.write(np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes())
            for a in arrays:
                f.write(a.tobytes() + bytes(-a.nbytes % 8))

    @classmethod
    def opened(cls, path: str) -> Trie:
        """The trie of a file, its levels mapped, not read."""
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view(np.int64)[0])
        sizes, at, parts = raw[8 : 8 * (n + 1)].view(np.int64), 8 * (n + 1), []
        for s in sizes.tolist():
            parts.append(raw[at : at + s])
            at += s + -s % 8
        head, levels = parts[0].view(np.int64), {}
        for i, k in enumerate(cls.SEQUENCES):
            one, low, high, zeros = parts[1 + 4 * i : 5 + 4 * i]
            levels[k] = EliasFano(*one.view(np.int64).tolist(), low, high.view(np.uint64), zeros.view(np.int64))
        values = {k: parts[len(parts) - len(cls.VALUES) + i].view(np.uint16) for i, k in enumerate(cls.VALUES)}
        return cls(int(head[0]), int(head[1]), levels, values)

    def ask(self, root: np.ndarray, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """own and left of each n-gram, quantised: its probability is own + left * (the word's own probability)."""
        at = runs(root)
        sizes = np.diff(np.append(at, len(root)))
        of, known = (np.repeat(x, sizes) for x in self.levels["roots"].place(root[at]))
        own, left = np.zeros(len(root)), np.ones(len(root))
        some = np.flatnonzero(known)
        if not len(some):
            return quantised(own), quantised(left)
        of, u, w = of[some], before[some], word[some]
        left_ = restored(self.values["root_left"][of])
        begins = np.repeat(self.levels["pointers"].get(of[runs(of)]), np.diff(np.append(runs(of), len(of))))
        fits = w < self.ids
        place, follows = self.levels["follow"].place(of * self.ids + np.where(fits, w, 0))
        follows &= fits
        own_ = np.zeros(len(some))
        own_[follows] = restored(self.values["follow_share"][place[follows]])
        fits = u < self.ids
        key = of * self.ids + np.where(fits, u, 0)
        at = runs(key)
        context, seen = (np.repeat(x, np.diff(np.append(at, len(key)))) for x in self.levels["contexts"].place(key[at]))
        seen &= fits
        passed = restored(self.values["context_left"][context[seen]])
        own_[seen] *= passed
        left_[seen] *= passed
        both = np.flatnonzero(seen & follows)
        gram, found = self.levels["grams"].place(context[both] * self.places + place[both] - begins[both])
        own_[both[found]] += restored(self.values["gram_share"][gram[found]])
        own[some], left[some] = own_, left_
        return quantised(own), quantised(left)
