"""Words and their hashes over Arrow batches, in bounded slices."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: UTF-8 bytes of text worked on at once; the arrays made from a slice are a few dozen times as large.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A-Z in lower case, other ASCII characters that are no letters or digits as spaces.
_PLAIN = np.array([b if b > 127 or chr(b).isalnum() else 32 for b in _LOWER.tolist()], dtype=np.uint8)
TABLES = {"as is": np.arange(256, dtype=np.uint8), "lower": _LOWER, "plain": _PLAIN}


def mix(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)


def powers(base: np.uint64, count: int) -> np.ndarray:
    """1, base, base squared and so on, modulo 2 to the 64."""
    steps = np.full(count, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``SLICE_BYTES`` of text; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts; a NULL text has none.

    ``first`` has the number of the first word of each text, and the number of all words at
    its end; ``starts`` and ``ends`` are byte positions in ``data``. ``reading`` names the table
    the bytes go through first: "as is", "lower" (A-Z) or "plain" (also without punctuation).
    """

    def __init__(self, texts: pa.Array, reading: str = "as is"):
        raw = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset :][: len(raw) + 1]
        body = raw.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
        data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self.data = data = data if reading == "as is" else TABLES[reading][data]
        gap = np.ones(len(data) + 2, dtype=bool)
        gap[1:-1] = _SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        solid = ~gap[1:-1]
        self.starts = np.flatnonzero(solid & (gap[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(solid & (gap[2:] | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.texts = len(raw)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(self.texts), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        reach = np.diff(self.starts, append=len(self.data))
        place = np.arange(self.starts[0], len(self.data)) - np.repeat(self.starts, reach)
        values = _BYTE[self.data[self.starts[0] :]] * powers(_BASE, int(reach.max()))[place]
        values[place >= np.repeat(lengths, reach)] = 0
        return mix(np.add.reduceat(values, self.starts - self.starts[0]) + lengths.astype(np.uint64))


def grams(words: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` words; empty when there are fewer words."""
    count = max(0, len(words) - length + 1)
    total = np.zeros(count, dtype=np.uint64)
    for step, factor in enumerate(powers(_BASE, length)):
        total += words[step : step + count] * factor
    return mix(total)
