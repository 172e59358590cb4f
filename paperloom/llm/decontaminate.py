"""Benchmark passages in documents: SimHash of item-sized windows, then exact verification.

Words are read in lower case and without punctuation; shingles are five words. A window has as
many words as the item it is compared with. Only windows that can reach the wanted similarity
are hashed: two windows of n shingles with a weighted Jaccard similarity of t share at least
2nt / (1 + t) of them, so that many of the window's shingles must occur in items of its size.
Fingerprints are looked up in eight blocks of eight bits: within ``RADIUS`` at least one block
differs in at most two bits, and all such blocks are probed, so no fingerprint within the radius
is missed. Candidates are then compared by their shingles with multiplicities.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import share
from paperloom.llm.text import Words, grams, slices

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Blocks of the fingerprint, bits a block may differ, and the radius these guarantee.
BLOCKS, BLOCK_RADIUS = 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Text of the items that are searched together; more items take more passes over the documents.
ITEM_BYTES = 16 << 20
LEAK = "struct<item_id:bigint,start:bigint,words:bigint,similarity:double>"
_PROBES = [[v for v in range(256) if (v ^ x).bit_count() <= BLOCK_RADIUS] for x in range(256)]
_PROBES = np.array(_PROBES, dtype=np.int64)
_FILTER_BITS = 18


def simhashes(windows: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each row of shingle hashes; repeated shingles weigh as often."""
    out = np.zeros(len(windows), dtype=np.uint64)
    for at in range(0, len(windows), 1024):
        part = np.ascontiguousarray(windows[at : at + 1024]).astype(">u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(*part.shape, 8), axis=2)
        ones = bits.reshape(*part.shape, 64).sum(axis=1, dtype=np.int32)
        out[at : at + 1024] = np.packbits(2 * ones > part.shape[1], axis=1).view(">u8")[:, 0]
    return out


def weighted_similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Sum of the smaller multiplicities over the sum of the larger ones."""
    names, counts = np.unique(left, return_counts=True)
    others, their = np.unique(right, return_counts=True)
    _, a, b = np.intersect1d(names, others, assume_unique=True, return_indices=True)
    same = np.minimum(counts[a], their[b]).sum()
    return float(same / (counts.sum() + their.sum() - same))


def position_ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and for each the number of its range."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner], owner


class SizeIndex:
    """The items with one number of words."""

    def __init__(self, words: int, items: list[tuple[list[int], np.ndarray]]):
        self.words, self.width = words, min(SHINGLE_WORDS, words)
        self.ids = [ids for ids, _ in items]
        self.shingles = np.stack([grams(hashes, self.width) for _, hashes in items])
        self.known = np.unique(self.shingles)
        self.prints = simhashes(self.shingles)
        blocks = self.prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        self.order = [np.argsort(blocks[:, b], kind="stable") for b in range(BLOCKS)]
        self.bounds = [np.searchsorted(np.sort(blocks[:, b]), np.arange(257)) for b in range(BLOCKS)]

    def starts(self, hits: np.ndarray, threshold: float) -> np.ndarray:
        """Windows with enough of the positions ``hits``, where some item's shingle begins."""
        count = self.words - self.width + 1
        need = max(1, math.ceil(2 * count * threshold / (1 + threshold) - 1e-9))
        if len(hits) < need:
            return hits[:0]
        last = hits[need - 1 :]
        first = hits[: len(last)]
        tight = last - first < count
        found, _ = position_ranges(last[tight] - count + 1, first[tight] + 1)
        return np.unique(found)

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs whose fingerprints lie within the radius."""
        blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        pairs = []
        for b in range(BLOCKS):
            probes = _PROBES[blocks[:, b]]
            low, high = self.bounds[b][probes].ravel(), self.bounds[b][probes + 1].ravel()
            place, owner = position_ranges(low, high)
            pairs.append(np.stack((owner // probes.shape[1], self.order[b][place]), axis=1))
        window, item = np.unique(np.concatenate(pairs), axis=0).T
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[near], item[near]


class ItemIndex:
    """Items by number of words; items with the same words are one with several ids."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        sizes: dict[int, dict[bytes, tuple[list, np.ndarray]]] = {}
        words = Words(pa.array([text for _, text in rows], pa.string()), "plain")
        hashes = words.hashes()
        for row, (item, _) in enumerate(rows):
            own = hashes[words.first[row] : words.first[row + 1]]
            if len(own):
                sizes.setdefault(len(own), {}).setdefault(own.tobytes(), ([], own))[0].append(item)
        self.sizes = [SizeIndex(n, list(found.values())) for n, found in sorted(sizes.items())]
        self.filters = {}
        for width in {s.width for s in self.sizes}:
            self.filters[width] = np.zeros(1 << _FILTER_BITS, dtype=bool)
        for size in self.sizes:
            self.filters[size.width][size.known >> np.uint64(64 - _FILTER_BITS)] = True

    def leaks(self, texts: pa.Array, threshold: float) -> list[list[dict]]:
        """For each text the items it holds, each with its best window, the first of equal ones."""
        words = Words(texts, "plain")
        hashes, best = words.hashes(), [{} for _ in range(words.texts)]
        spots = {}
        for width, maybe in self.filters.items():
            all_grams = grams(hashes, width)
            place = np.flatnonzero(maybe[all_grams >> np.uint64(64 - _FILTER_BITS)])
            spots[width] = (all_grams, place, all_grams[place])
        for size in self.sizes:
            all_grams, place, found = spots[size.width]
            spot = np.searchsorted(size.known, found)
            spot[spot == len(size.known)] = 0
            starts = size.starts(place[size.known[spot] == found], threshold)
            starts = starts[(starts >= 0) & (starts + size.words <= len(hashes))]
            text = np.searchsorted(words.first, starts, side="right") - 1
            inside = starts + size.words <= words.first[text + 1]
            starts, text = starts[inside], text[inside]
            for at in range(0, len(starts), 4096):
                some, where = starts[at : at + 4096], text[at : at + 4096]
                shingles = all_grams[some[:, None] + np.arange(size.words - size.width + 1)]
                for window, item in zip(*size.candidates(simhashes(shingles))):
                    value = weighted_similarity(shingles[window], size.shingles[item])
                    key, own = (size.words, int(item)), best[where[window]]
                    if value >= threshold - 1e-12 and (key not in own or value > own[key][0]):
                        own[key] = (value, int(some[window] - words.first[where[window]]), size.ids[item])
        return [
            [
                {"item_id": i, "start": start, "words": key[0], "similarity": value}
                for key, (value, start, ids) in sorted(own.items())
                for i in ids
            ]
            for own in best
        ]


def _item_groups(items: DataFrame, item_id: str, text: str) -> list[list[tuple]]:
    """The items in groups of at most about ``ITEM_BYTES`` of text, one group in the driver at a time."""
    rows = items.select(F.col(item_id).cast("long"), text)
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    groups = max(1, math.ceil(2 * size / ITEM_BYTES)) if size > ITEM_BYTES else 1
    for group in range(groups):
        own = rows if groups == 1 else rows.where(F.pmod(F.xxhash64(item_id, text), F.lit(groups)) == group)
        yield [tuple(r) for r in own.orderBy(item_id).collect()]


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = SIMILARITY,
    leaks: str = "leaks",
) -> DataFrame:
    """The documents with the benchmark items found in them, an array of ``LEAK``.

    Each item of at least one word is looked for in every window of its size; shingles are five
    words, or the whole item when it is shorter. An item is listed once per document with its
    most similar window: its first word (counted from 0), its number of words and the weighted
    Jaccard similarity. NULL or empty texts and items hold nothing. Repeated documents are
    searched each for itself, repeated items are all listed, a NULL item id is listed as NULL;
    item ids are whole numbers.
    All columns are kept; one named like ``leaks`` is replaced.

    Documents are not moved. The items' index is sent to all tasks behind a check of its size;
    beyond ``ITEM_BYTES`` the documents are passed once for each group of items.
    """
    docs = docs.drop(leaks)
    names = docs.columns
    rows = docs.withColumn(leaks, F.array().cast(f"array<{LEAK}>"))
    for group in _item_groups(items, item_id, item_text):
        shared = share(docs.sparkSession, ItemIndex(group))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared()
            for batch in batches:
                for part in slices(batch, text):
                    found = index.leaks(part.column(text), threshold)
                    before = part.column(leaks).to_pylist()
                    column = pa.array([a + b for a, b in zip(before, found)], part.schema.field(leaks).type)
                    yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column], [*names, leaks])

        rows = rows.mapInArrow(search, rows.schema)
    return rows
