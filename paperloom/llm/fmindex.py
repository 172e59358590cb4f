"""A compressed FM-index over word numbers: bit-packed wavelet matrix and backward search.

Suffixes are ordered by their first ``length`` words only, which is enough to search patterns of
at most that many words.
"""

import numpy as np

from paperloom.llm.text import grams, mix

#: Windows searched together: few enough for a step's arrays to stay in a core's cache.
SEARCHES = 1 << 15


class PackedBits:
    """Bits in cells of 32, each with the ones before it in the cell's upper half, so that a rank reads one cell."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 32 + 1) * 32, dtype=np.uint8)
        padded[: len(bits)] = bits
        words = np.packbits(padded, bitorder="little").view("<u4").astype(np.int64)
        counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
        self.cells = (np.concatenate(([0], counts[:-1])) << 32) | words
        self.ones = int(counts[-1])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        cell = self.cells[place >> 5]
        return (cell >> 32) + np.bitwise_count(cell & ((np.int64(1) << (place & 31)) - 1))


class WaveletMatrix:
    """Rank over a sequence of numbers below 2 to the ``bits``."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in reversed(range(bits)):
            bit = ((values >> level) & 1).astype(np.uint8)
            packed = PackedBits(bit)
            self.levels.append((packed, len(values) - packed.ones))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def descend(self, numbers: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The place at the bottom; ranks are differences of such places."""
        for level, (packed, zeros) in zip(reversed(range(self.bits)), self.levels):
            ones = packed.rank(place)
            place = np.where((numbers >> level) & 1, zeros + ones, place - ones)
        return place


def suffix_order(symbols: np.ndarray, length: int) -> np.ndarray:
    """Positions in the order of the ``length`` symbols that begin there; zeros follow the end.

    Symbols, and then the ranks of short runs, are put together to longer runs, as many as a key
    holds. Positions whose symbols are the same stand in any order, which no search of at most
    ``length`` symbols sees.
    """
    count, rank, covered = len(symbols), symbols, 1
    while True:
        bits = max(1, int(rank.max()).bit_length())
        padded = np.concatenate((rank, np.zeros(length, dtype=np.int64)))
        key, reach = rank, covered
        for _ in range(63 // bits - 1):
            # An overlap is settled by the ranks before, so together they stand for the longer run.
            step = min(covered, length - reach)
            place = reach + step - covered
            key = (key << bits) | padded[place : place + count]
            reach += step
            if reach == length:
                break
        order, covered = np.argsort(key), reach
        if covered == length:
            return order
        fresh = np.ones(count, dtype=np.int64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(count, dtype=np.int64)
        rank[order] = np.cumsum(fresh)


def distinct_windows(symbols: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows that cover all texts among ``starts``, and for each start the number of its own there.

    Windows meet by a hash; one that differs from the first of its hash stands for itself.
    """
    if not len(starts):
        return starts, starts
    names = grams(mix(symbols.astype(np.uint64)), length)[starts]
    order = np.argsort(names)
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = names[order[1:]] != names[order[:-1]]
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(fresh) - 1
    texts = starts[order[fresh]]
    odd = np.zeros(len(starts), dtype=bool)
    for step in range(length):
        odd |= symbols[starts + step] != symbols[texts[which] + step]
    which[odd] = len(texts) + np.arange(odd.sum())
    return np.concatenate((texts, starts[odd])), which


class FmIndex:
    """Backward search in a text of symbols above zero; a zero stands after each of its parts."""

    def __init__(self, symbols: np.ndarray, length: int):
        self.length = length
        self.order = suffix_order(symbols, length)
        self.bits = max(1, int(symbols.max()).bit_length())
        last = np.where(self.order > 0, symbols[self.order - 1], 0)
        self.tree = WaveletMatrix(last, self.bits)
        every = np.arange(int(symbols.max()) + 1)
        counts = np.bincount(symbols, minlength=len(every))
        below = np.cumsum(counts) - counts
        self.shift = below - self.tree.descend(every, np.zeros(len(every), dtype=np.int64))

    def search(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of windows of a text: (matched, low, high) for each start.

        A window is read from its last symbol to its first. It is given up as soon as fewer than
        two places of the index match, which is only the window's own; ``matched`` counts the
        symbols up to there, and for windows matched whole ``low`` to ``high`` is their range.
        Windows of the same symbols are searched once.
        """
        texts, which = distinct_windows(symbols, starts, self.length)
        found = [self._search(symbols, texts[at : at + SEARCHES]) for at in range(0, max(1, len(texts)), SEARCHES)]
        matched, low, high = (np.concatenate(x)[which] for x in zip(*found))
        return matched, low, high

    def _search(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count = len(starts)
        matched = np.zeros(count, dtype=np.int64)
        lows, highs = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        active = np.arange(count)
        low, high = np.zeros(count, dtype=np.int64), np.full(count, len(self.order), dtype=np.int64)
        for step in reversed(range(self.length)):
            symbol = symbols[starts[active] + step]
            low = self.tree.descend(symbol, low) + self.shift[symbol]
            high = self.tree.descend(symbol, high) + self.shift[symbol]
            go = high - low >= 2
            active, low, high = active[go], low[go], high[go]
            matched[active] += 1
            if not len(active):
                break
        lows[active], highs[active] = low, high
        return matched, lows, highs
