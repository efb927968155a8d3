"""An FM-index over sequences of words: suffix order, wavelet matrix, backward search, matching statistics.

All arrays are numpy; many searches step together, one word to the left at a time.
"""

from __future__ import annotations

import numpy as np

#: Rows of a block of the range minimum.
_BLOCK = 32
_NONE = np.iinfo(np.int64).max


class Wavelet:
    """Wavelet matrix of a sequence: one bit vector for each bit of the symbols, with counts of ones before every 64 bits."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols - 1).bit_length())
        n = len(sequence)
        blocks = n // 64 + 1
        self.words = np.zeros((self.bits, blocks), np.uint64)
        self.before = np.zeros((self.bits, blocks), np.int64)
        self.zeros = np.zeros(self.bits, np.int64)
        for level in range(self.bits):
            bit = (sequence >> (self.bits - 1 - level)) & 1
            packed = np.zeros(blocks * 8, np.uint8)
            held = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[:len(held)] = held
            self.words[level] = packed.view(np.uint64)
            ones = np.bitwise_count(self.words[level]).astype(np.int64)
            self.before[level] = np.cumsum(ones) - ones
            self.zeros[level] = n - int(ones.sum())
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            word = i >> 6
            below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[level][word] + np.bitwise_count(self.words[level][word] & below)
            i = np.where((symbol >> (self.bits - 1 - level)) & 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first i of the sequence."""
        return self._down(symbol, i) - self.start[symbol]


class RangeMin:
    """Smallest value of row ranges: minima of blocks in a table of doubling widths, the ends of a range read as they are."""

    def __init__(self, values: np.ndarray) -> None:
        n = -(-len(values) // _BLOCK) * _BLOCK
        self.values = np.full(n + _BLOCK, _NONE)
        self.values[:len(values)] = values
        self.table = [self.values[:n].reshape(-1, _BLOCK).min(axis=1)]
        width = 1
        while 2 * width <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _ends(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        cells = start[:, None] + np.arange(_BLOCK)
        inside = cells < stop[:, None]
        return np.where(inside, self.values[np.where(inside, cells, 0)], _NONE).min(axis=1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Minimum of values[start:stop] for each pair, a great number for none."""
        out = np.empty(len(start), np.int64)
        for a in range(0, len(start), 20_000):
            out[a:a + 20_000] = self._of(start[a:a + 20_000], stop[a:a + 20_000])
        return out

    def _of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        first, last = -(-start // _BLOCK), stop // _BLOCK
        out = self._ends(start, np.minimum(stop, first * _BLOCK))
        out = np.minimum(out, self._ends(np.maximum(start, last * _BLOCK), stop))
        short = start + _BLOCK >= stop
        out[short] = self._ends(start[short], stop[short])
        blocks = last - first
        some = np.flatnonzero(blocks > 0)
        level = np.zeros(len(blocks), np.int64)
        level[some] = np.frexp(blocks[some].astype(np.float64))[1] - 1
        for k in np.unique(level[some]):
            at = some[level[some] == k]
            held = self.table[k]
            out[at] = np.minimum(out[at], np.minimum(held[first[at]], held[last[at] - (1 << k)]))
        return out


def suffix_order(first_rank: np.ndarray) -> np.ndarray:
    """Start positions in suffix order, by prefix doubling, where every suffix meets a symbol that occurs once."""
    n = len(first_rank)
    rank = np.unique(first_rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key)
        held = key[order]
        new = np.cumsum(np.concatenate([[0], (held[1:] != held[:-1]).astype(np.int64)])) if n else held
        rank[order] = new
        if not n or new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Index of texts, each of an owner; owners are ranks, and a search may ask for owners below its own only.

    `words` holds the symbols (0 up to `symbols` - 1) of all texts one after the other, `offsets` their bounds. In `text` each text is
    followed by an end, symbol 0, and words are one higher.
    """

    def __init__(self, words: np.ndarray, offsets: np.ndarray, owner: np.ndarray, symbols: int) -> None:
        texts, n = len(owner), len(words) + len(owner)
        length = np.diff(offsets)
        self.start = offsets[:-1] + np.arange(texts)
        self.end = self.start + length
        self.text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.end] = False
        self.text[inside] = words + 1
        first = self.text + texts - 1
        first[self.end] = np.arange(texts)
        order = suffix_order(first)
        bwt = self.text[order - 1]
        self.wavelet = Wavelet(bwt, symbols + 1)
        self.below = np.cumsum(np.bincount(self.text, minlength=symbols + 1)) - np.bincount(self.text, minlength=symbols + 1)
        self.owner = owner
        self.lowest = RangeMin(np.repeat(owner, length + 1)[order] << 32 | order)

    def reach(self, stream: np.ndarray, end: np.ndarray, floor: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Matching statistics to the left: the smallest start >= floor for which stream[start:end] stands in a text of a lower owner.

        Each search keeps a witness, a place of its match in such a text. While the witness goes on, nothing else is asked; when it
        breaks off, the suffix interval of the match is asked for the lowest owner in it.
        """
        out = end.copy()
        going = np.flatnonzero(end > floor)
        low, high = np.zeros(len(end), np.int64), np.full(len(end), len(self.text))
        witness = np.zeros(len(end), np.int64)
        while len(going):
            symbol = stream[out[going] - 1]
            known = (symbol > 0) & (symbol < len(self.below))
            going, symbol = going[known], symbol[known]
            both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low[going], high[going]]))
            low[going] = self.below[symbol] + both[:len(going)]
            high[going] = self.below[symbol] + both[len(going):]
            held = witness[going] - 1
            lost = (held < 0) | (self.text[held] != symbol)
            asked = going[lost]
            lowest = self.lowest.of(low[asked], high[asked])
            held[lost] = np.where((lowest >> 32) < own[asked], lowest & 0xFFFFFFFF, -1)
            going, held = going[held >= 0], held[held >= 0]
            witness[going] = held
            out[going] -= 1
            going = going[out[going] > floor[going]]
        return out

    def repeats(self, width: int) -> list[np.ndarray]:
        """(text, from, to) of windows of `width` words, by start within their text, that stand in a text of a lower owner too.

        A range of windows is searched to the left from both its ends. From the end of the last window, all windows that start
        inside the match are known. From the end of the first one, a match that breaks off before the word at f rules out all windows up
        to f, since each holds the piece from f to that end. What is left between is halved; all ranges step together.
        """
        found = []
        size = self.end - self.start - width
        text = np.flatnonzero(size >= 0)
        low, high = np.zeros(len(text), np.int64), size[text]
        while len(text):
            start, own = self.start[text], self.owner[text]
            left = self.reach(self.text, np.concatenate([start + low, start + high]) + width, np.tile(start + low, 2), np.tile(own, 2)) - np.tile(start, 2)
            of_first, of_last = left[:len(text)], left[len(text):]
            hit = of_last <= high
            found.append(np.stack([text[hit], of_last[hit], high[hit]], axis=1))
            only = (of_first == low) & (of_last > low)
            found.append(np.stack([text[only], low[only], low[only]], axis=1))
            low = np.maximum(of_first, low + 1)
            high = np.minimum(of_last, high) - 1
            on = low <= high
            text, low, high = text[on], low[on], high[on]
            middle = (low + high) // 2
            second = middle < high
            text, low, high = np.concatenate([text, text[second]]), np.concatenate([low, middle[second] + 1]), np.concatenate([middle, high[second]])
        return found
