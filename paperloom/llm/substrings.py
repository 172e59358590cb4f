"""Removal of word passages that an earlier document holds, with an FM-index per shard.

Every window of ``WINDOW`` words has an anchor, the smallest hash of the short word runs in it, so
equal windows have equal anchors wherever they stand. Consecutive windows with one anchor form a
segment. Anchors are compared first: only segments whose anchor occurs in two documents go on.
These are sent to the shard of their anchor. A shard indexes its segments and streams them through
the index: backward search gives the matching statistics of each window, and a window matched over
its whole length belongs to the smallest document in its range. Words covered by a window of a
larger document are removed.

An anchor with more than ``HOT_WORDS`` words of segments, such as one in a notice that many documents
hold in different surroundings, is split: each window is a segment of its own and its shard follows
from the whole window, so that equal windows still meet and no anchor fills a shard.

Copies are reduced before they move: of equal segments in one task's buffer only those of the
smallest document are sent, the others are known to be removed.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paperloom.llm.fmindex import FmIndex
from paperloom.llm.text import Words, grams, mix, powers, slices
from paperloom.session import work_folder

WINDOW = 13
ANCHOR_WORDS = 5
#: Text of a task that is worked on before results are sent on.
BUFFER_BYTES = 16 << 20
#: Text for each group of anchors, and for each shard.
ANCHOR_TEXT, SHARD_TEXT = 48 << 20, 12 << 20
#: Words of one anchor's segments from which they are sent window by window, each to its own shard.
HOT_WORDS = 1 << 16
#: Bits of an anchor that are compared to find out which occur twice; more hits only cost time.
_ANCHOR_SHIFT = np.uint64(20)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PARTS = "part int, direct boolean, body binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("direct", pa.bool_()), ("body", pa.binary())])


def pack_arrays(*arrays: np.ndarray) -> bytes:
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + body)


def unpack_arrays(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, count in json.loads(raw[4:at]):
        out.append(np.frombuffer(raw, dtype=kind, count=count, offset=at))
        at += out[-1].nbytes
    return out


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def segments(first: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, words, anchor) of the segments of some texts.

    ``first`` has the number of each text's first word; windows do not cross texts.
    """
    count = len(hashes) - WINDOW + 1
    none = np.zeros(0, dtype=np.int64)
    if count <= 0:
        return none, none, none, np.zeros(0, dtype=np.uint64)
    runs = grams(hashes, ANCHOR_WORDS)
    anchor = runs[:count].copy()
    for step in range(1, WINDOW - ANCHOR_WORDS + 1):
        np.minimum(anchor, runs[step : step + count], out=anchor)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:count]
    place = np.flatnonzero(np.arange(count) + WINDOW <= first[text + 1])
    if not len(place):
        return none, none, none, np.zeros(0, dtype=np.uint64)
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = (anchor[place[1:]] != anchor[place[:-1]]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(fresh)
    start = place[begin]
    last = place[np.append(begin[1:], len(place)) - 1]
    return text[start], start, last - start + WINDOW, anchor[start]


class _Buffer:
    """Rows of a task and their segments."""

    def __init__(self) -> None:
        self.docs: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.parts: list[tuple] = []
        self.words: list[np.ndarray] = []
        self.bytes = self.count = self.total = 0

    def add(self, part: pa.RecordBatch) -> None:
        words = Words(part.column("text"))
        hashes = words.hashes()
        text, start, size, anchor = segments(words.first, hashes)
        fresh = np.flatnonzero(np.diff(text, prepend=-1))
        ordinal = np.arange(len(text)) - np.repeat(fresh, np.diff(fresh, append=len(text)))
        self.parts.append((text + self.count, start + self.total, start - words.first[text], size, anchor, ordinal))
        if "shared" in part.schema.names:
            wanted = [unpack_arrays(own)[0] for own in part.column("shared").to_pylist()]
            names = np.concatenate([row * (1 << 32) + own.astype(np.int64) for row, own in enumerate(wanted)])
            keep = np.isin(text * (1 << 32) + ordinal, names)
            self.parts[-1] = tuple(a[keep] for a in self.parts[-1])
            self.words.append(hashes)
            self.total += len(hashes)
        self.docs.append(part.column("doc").to_numpy())
        self.rows.append(part.column("row").to_numpy())
        self.count += part.num_rows
        self.bytes += len(words.data)

    def gathered(self) -> list[np.ndarray]:
        """doc and row of each input row, then text, place, start, words, anchor, ordinal of each segment."""
        return [np.concatenate(self.docs), np.concatenate(self.rows), *(np.concatenate(a) for a in zip(*self.parts))]


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[_Buffer]:
    buffer = _Buffer()
    for batch in batches:
        for part in slices(batch):
            buffer.add(part)
            if buffer.bytes >= BUFFER_BYTES:
                yield buffer
                buffer = _Buffer()
    if buffer.count:
        yield buffer


def _batch(parts: list[int], direct: list[bool], bodies: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(parts, pa.int32()), pa.array(direct, pa.bool_()), pa.array(bodies, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "direct", "body"])


def _messages(docs: np.ndarray, rows: np.ndarray, parts: int, *values: np.ndarray) -> pa.RecordBatch:
    """What is known about input rows, one message to each part; all arrays have an entry for each value."""
    part = rows % parts
    order = np.argsort(part * np.int64(2) ** 40 + np.arange(len(part)), kind="stable")
    edges = _group_edges(part[order])
    ends = np.append(edges[1:], len(order))
    bodies = [pack_arrays(*(v[order[a:b]] for v in (docs, rows, *values))) for a, b in zip(edges, ends)]
    return _batch(part[order[edges]].tolist(), [True] * len(bodies), bodies)


def _take_apart(table: pa.Table) -> tuple[list[pa.RecordBatch], list[list[np.ndarray]]]:
    """The messages to be passed on, and the arrays of the others."""
    direct, rest = [], []
    for batch in table.to_batches():
        known = batch.column("direct")
        direct.append(batch.filter(known))
        rest += [unpack_arrays(body.as_py()) for body in batch.filter(pc.invert(known)).column("body")]
    return direct, rest


def _gather(messages: DataFrame) -> DataFrame:
    """(doc, row, body): one row for each input row, with all values sent to it."""

    def gather(table: pa.Table) -> pa.Table:
        arrays = [np.concatenate(a) for a in zip(*(unpack_arrays(body.as_py()) for body in table.column("body")))]
        order = np.lexsort(arrays[:2])
        docs, rows = arrays[0][order], arrays[1][order]
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (rows[1:] != rows[:-1]) | (docs[1:] != docs[:-1])
        edges = np.flatnonzero(fresh)
        ends = np.append(edges[1:], len(order))
        bodies = [pack_arrays(*(v[order[a:b]] for v in arrays[2:])) for a, b in zip(edges, ends)]
        return pa.table({"doc": docs[edges], "row": rows[edges], "body": pa.array(bodies, pa.binary())})

    return messages.groupBy("part").applyInArrow(gather, "doc long, row long, body binary")


def _group_edges(sorted_values: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(sorted_values), dtype=bool)
    fresh[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(fresh)


def _several(names: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each entry whether its name occurs in more than one document."""
    order = np.argsort(names, kind="stable")
    edges = _group_edges(names[order])
    sorted_docs = docs[order]
    shared = np.minimum.reduceat(sorted_docs, edges) < np.maximum.reduceat(sorted_docs, edges)
    out = np.zeros(len(names), dtype=bool)
    out[order] = np.repeat(shared, np.diff(edges, append=len(order)))
    return out


def _shared_anchors(rows: DataFrame, parts: int) -> DataFrame:
    """(doc, row, body): for each row the ordinals of its segments whose anchor others hold too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer in _buffers(batches):
            docs, rows, text, _, _, _, anchor, ordinal = buffer.gathered()
            if not len(text):
                continue
            name = anchor >> _ANCHOR_SHIFT
            several = _several(name, docs[text])
            if several.any():
                yield _messages(docs[text[several]], rows[text[several]], parts, ordinal[several].astype(np.int32))
            part = (mix(name) % np.uint64(parts)).astype(np.int64)
            common = np.unique(name[several])
            common_part = (mix(common) % np.uint64(parts)).astype(np.int64)
            for number in range(parts):
                own = np.flatnonzero((part == number) & ~several)
                there = common[common_part == number]
                if len(own) or len(there):
                    who, local = np.unique(text[own], return_inverse=True)
                    body = pack_arrays(there, docs[who], rows[who], local.astype(np.int32), name[own], ordinal[own].astype(np.int32))
                    yield _batch([number], [False], [body])

    def answer(table: pa.Table) -> pa.Table:
        out, sent = _take_apart(table)
        if sent:
            common = np.concatenate([there for there, *_ in sent])
            sent = [(docs[local], rows[local], name, ordinal) for _, docs, rows, local, name, ordinal in sent]
            docs, rows, name, ordinal = (np.concatenate(a) for a in zip(*sent))
            hit = _several(name, docs) | np.isin(name, common) if len(name) else np.zeros(0, dtype=bool)
            if hit.any():
                out.append(_messages(docs[hit], rows[hit], parts, ordinal[hit]))
        return pa.Table.from_batches(out, schema=_SCHEMA)

    return _gather(rows.mapInArrow(send, _PARTS).groupBy("part").applyInArrow(answer, _PARTS))


def covered_spans(docs: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, from, to): runs of words covered by windows that a smaller document holds.

    The segments' words stand one after the other in ``words``.
    """
    numbers = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    symbols[spans(begin, sizes)] = numbers
    index = FmIndex(symbols, WINDOW)
    windows = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    starts = spans(begin, windows)
    _, low, high = index.search(symbols, starts)
    found = np.flatnonzero(high > low)
    holder = np.repeat(np.arange(len(sizes)), sizes + 1)
    held_by = np.append(docs[holder[index.order]], np.iinfo(np.int64).max)
    ranges, which = np.unique(low[found] * (len(symbols) + 1) + high[found], return_inverse=True)
    bounds = np.stack((ranges // (len(symbols) + 1), ranges % (len(symbols) + 1)), axis=1).ravel()
    smallest = np.minimum.reduceat(held_by, bounds)[::2] if len(ranges) else np.zeros(0, dtype=np.int64)
    lost = found[smallest[which] < docs[owner[found]]]
    place, segment = starts[lost] - begin[owner[lost]], owner[lost]
    fresh = np.ones(len(lost), dtype=bool)
    fresh[1:] = (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)
    edges = np.flatnonzero(fresh)
    last = np.append(edges[1:], len(lost)) - 1
    return segment[edges], place[edges], place[last] + WINDOW if len(lost) else place


def _hot_anchors(rows: DataFrame) -> np.ndarray:
    """The anchors with more than ``HOT_WORDS`` words of segments, ascending; ``rows`` has the shared ordinals.

    At most one for each ``HOT_WORDS`` words of the segments comes to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer in _buffers(batches):
            *_, size, anchor, _ = buffer.gathered()
            names, which = np.unique(anchor, return_inverse=True)
            total = np.bincount(which, weights=size, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(total)], ["anchor", "words"])

    counted = rows.mapInArrow(count, "anchor long, words long").groupBy("anchor").agg(F.sum("words").alias("words"))
    hot = [row.anchor for row in counted.where(F.col("words") > HOT_WORDS).select("anchor").collect()]
    return np.sort(np.array(hot, dtype=np.int64).view(np.uint64))


def split_segments(words: np.ndarray, hot: np.ndarray, text: np.ndarray, place: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray) -> list[np.ndarray]:
    """text, place, start, words and anchor of the segments, those of hot anchors window by window.

    ``words`` has the hashes ``place`` counts in. A window's anchor is made from all its words.
    """
    split = np.isin(anchor, hot)
    count = size[split] - WINDOW + 1
    step = spans(np.zeros(len(count), dtype=np.int64), count)
    at = np.repeat(place[split], count) + step
    new = [np.repeat(text[split], count), at, np.repeat(start[split], count) + step, np.full(len(at), WINDOW), mix(grams(words, WINDOW)[at])]
    return [np.concatenate((old[~split], made)) for old, made in zip((text, place, start, size, anchor), new)]


def _covered(rows: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """(doc, row, body): for each row the word ranges to remove. ``rows`` has the shared ordinals."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer in _buffers(batches):
            docs, rows, text, place, start, size, anchor, _ = buffer.gathered()
            if not len(text):
                continue
            words = np.concatenate(buffer.words)
            if len(hot):
                text, place, start, size, anchor = split_segments(words, hot, text, place, start, size, anchor)
            power = powers(_BASE, len(words) + 1)
            running = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * power[:-1], dtype=np.uint64)))
            # Equal runs of words at different places differ by a power of the base.
            back = powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(words) + 1)
            name = mix((running[place + size] - running[place]) * back[place] + size.astype(np.uint64)) ^ anchor
            order = np.argsort(name, kind="stable")
            edges = _group_edges(name[order])
            least = np.empty(len(name), dtype=np.int64)
            least[order] = np.repeat(np.minimum.reduceat(docs[text][order], edges), np.diff(edges, append=len(order)))
            later = docs[text] > least
            if later.any():
                begin, end = start[later].astype(np.int32), (start + size)[later].astype(np.int32)
                yield _messages(docs[text[later]], rows[text[later]], parts, begin, end)
            part = (mix(anchor) % np.uint64(parts)).astype(np.int64)
            for number in range(parts):
                own = np.flatnonzero((part == number) & ~later)
                if len(own):
                    who, local = np.unique(text[own], return_inverse=True)
                    vocabulary, inside = np.unique(words[spans(place[own], size[own])], return_inverse=True)
                    inside = inside.astype(np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32)
                    body = pack_arrays(docs[who], rows[who], local.astype(np.int32), start[own].astype(np.int32), size[own].astype(np.int32), vocabulary, inside)
                    yield _batch([number], [False], [body])

    def index(table: pa.Table) -> pa.Table:
        out, sent = _take_apart(table)
        if sent:
            sent = [(docs[local], rows[local], start, size, words[inside]) for docs, rows, local, start, size, words, inside in sent]
            docs, rows, start, size, words = (np.concatenate(a) for a in zip(*sent))
            segment, begin, end = covered_spans(docs, size.astype(np.int64), words)
            if len(segment):
                begin, end = (start[segment] + begin).astype(np.int32), (start[segment] + end).astype(np.int32)
                out.append(_messages(docs[segment], rows[segment], parts, begin, end))
        return pa.Table.from_batches(out, schema=_SCHEMA)

    return _gather(rows.mapInArrow(send, _PARTS).groupBy("part").applyInArrow(index, _PARTS))


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without passages that a document with a smaller id holds.

    A window is 13 consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document; every word covered by
    a window whose words also stand in a document with a smaller id is removed. Windows are judged
    on the input. ``text`` becomes the kept words joined by one space; ``n_words`` and ``n_removed``
    count before and removed. A NULL or empty text has no words and becomes empty. Rows with one id
    are one document and do not remove each other's words; a NULL id ranks above all ids. Input
    columns named ``n_words`` or ``n_removed`` are replaced, others kept. Ids are whole numbers; a text
    that is no number is refused. Words are compared by 64-bit hashes.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "substrings")
    docs = docs.drop("n_words", "n_removed")
    body = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(body)), F.lit(0))).first()[0]
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit(2**63 - 1))
    keys = {"__doc": doc, "__row": F.shiftrightunsigned(F.xxhash64(F.col(id_column), body), 1)}
    rows = docs.withColumns(keys)
    narrow = rows.select(F.col("__doc").alias("doc"), F.col("__row").alias("row"), body.alias("text"))
    anchors = _shared_anchors(narrow, max(1, -(-size // ANCHOR_TEXT)))
    anchors.withColumnRenamed("body", "shared").write.parquet(f"{folder}/anchors")
    chosen = narrow.join(spark.read.parquet(f"{folder}/anchors"), ["doc", "row"])
    covered = _covered(chosen, max(1, -(-size // SHARD_TEXT)), _hot_anchors(chosen))
    covered.write.parquet(f"{folder}/covered")
    names_of = {"doc": "__doc", "row": "__row", "body": "__spans"}
    covered = spark.read.parquet(f"{folder}/covered").withColumnsRenamed(names_of)
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts, counts, removed = [], [], []
                for value, found in zip(part.column(text).to_pylist(), part.column("__spans").to_pylist()):
                    words = (value or "").encode().split()
                    counts.append(len(words))
                    if found:
                        edges = np.zeros(len(words) + 1, dtype=np.int64)
                        begin, end = unpack_arrays(found)
                        np.add.at(edges, begin, 1)
                        np.add.at(edges, end, -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                    removed.append(counts[-1] - len(words))
                    texts.append(b" ".join(words).decode())
                made = {text: pa.array(texts, part.schema.field(text).type)}
                columns = [made[n] if n in made else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [*names, "n_words", "n_removed"]
                )

    return rows.join(covered, ["__doc", "__row"], "left").select(*names, "__spans").mapInArrow(remove, schema)
