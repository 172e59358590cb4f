"""SimHash near-duplicates found with Gray-ordered hierarchical indexes.

The fingerprints of a group that agrees on a few blocks of bits are sorted by Gray rank, so
that neighbours share most bits. Runs of eight are put under a node that holds the bits they
share; runs of eight nodes under a node one level up, and so on. A search goes down from the
root, adds up the differing bits node by node, and leaves out a whole subtree as soon as the
sum exceeds the radius.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.components import components
from paperloom.llm.text import slices
from paperloom.session import stored, work_folder

SHINGLE_WORDS = 4
HASH_SEED = 42
RADIUS = 4
#: Nodes or leaves below one node of the index.
FANOUT = 8
#: Fingerprints wanted in a group that is searched as one; more blocks are compared beyond it.
GROUP_SIZE = 4096
#: Index entries meant for one task.
TASK_ENTRIES = 400_000
#: Searches that go down an index together, and the most open nodes they may have at once.
SEARCHES = 4096
FRONTIER = 1_000_000
_BITS = 64
_ALL = (1 << _BITS) - 1


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text; zero when it has no word."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], dtype=">u8")
    ones = np.zeros(_BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        chunk = hashes[part : part + (1 << 16)]
        ones += np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << _BITS) if value >> (_BITS - 1) else value


def with_fingerprint(docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp, kept columns): the fingerprint of every row as a signed 64-bit number. A NULL text has none: 0."""
    columns = [id_column, *keep]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values = [_signed(fingerprint(x)) for x in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in columns], pa.array(values, pa.int64())], [*columns, "fp"]
                )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns, text).mapInArrow(compute, f"{kinds}, fp long")


def block_masks(radius: int, same: int) -> list[int]:
    """Masks of every choice of ``same`` out of ``radius + same`` blocks.

    Two fingerprints within the radius differ in at most ``radius`` blocks, so they agree on
    all bits of at least one mask.
    """
    count = radius + same
    cuts = [round(i * _BITS / count) for i in range(count + 1)]
    blocks = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(count)]
    return [sum(choice) for choice in combinations(blocks, same)]


def blocks_to_match(rows: int, radius: int = RADIUS) -> int:
    """How many blocks must agree so that random groups stay near ``GROUP_SIZE``."""
    same = 1
    while same < 4 and rows >> (_BITS * same // (radius + same)) > GROUP_SIZE:
        same += 1
    return same


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the sequence of Gray codes."""
    rank = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """The indexes of many groups at once, one tree for each group.

    ``groups`` are numbers in ascending order; ``values`` are the distinct fingerprints of a
    group in the order of their Gray ranks. ``levels[0]`` are the leaves. A level has the
    nodes' pattern, the mask of bits that are new to them (not held by a node above), and the
    range of their children.
    """

    def __init__(self, groups: np.ndarray, values: np.ndarray):
        self.values = values
        patterns, masks = values, np.full(len(values), _ALL, dtype=np.uint64)
        owner = groups
        self.levels: list[list[np.ndarray]] = [[patterns, masks, np.zeros(0, int), np.zeros(0, int)]]
        self.leaf_start = [np.arange(len(values))]
        while True:
            fresh = np.flatnonzero(np.diff(owner, prepend=owner[:1] - 1))
            sizes = np.diff(fresh, append=len(owner))
            place = np.arange(len(owner)) - np.repeat(fresh, sizes)
            starts = np.flatnonzero(place % FANOUT == 0)
            ends = np.append(starts[1:], len(owner))
            common = np.bitwise_and.reduceat(masks, starts)
            some, every = np.bitwise_or.reduceat(patterns, starts), np.bitwise_and.reduceat(patterns, starts)
            common &= ~(some ^ every)
            self.levels[-1][1] = masks & ~np.repeat(common, ends - starts)
            self.levels.append([every & common, common, starts, ends])
            self.leaf_start.append(self.leaf_start[-1][starts])
            patterns, masks, owner = every & common, common, owner[starts]
            if len(starts) == len(fresh):
                break
        self.roots = np.repeat(np.arange(len(owner)), np.diff(self.leaf_start[-1], append=len(values)))

    def matches(self, queries: np.ndarray, radius: int, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, leaf) pairs within the radius, by position, in chunks.

        A subtree whose leaves all carry the query's own label is left out: its links are
        known already.
        """
        uniform = []
        for starts in self.leaf_start:
            low, high = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
            uniform.append(np.where(low == high, low, -1))
        top = len(self.levels) - 1
        todo = [(top, queries, self.roots[queries], np.zeros(len(queries), dtype=np.uint8))]
        while todo:
            level, who, node, spent = todo.pop()
            if len(who) > FRONTIER and level < top:
                half = len(who) // 2
                todo += [(level, who[:half], node[:half], spent[:half]), (level, who[half:], node[half:], spent[half:])]
                continue
            pattern, mask, starts, ends = self.levels[level]
            total = spent + np.bitwise_count((self.values[who] ^ pattern[node]) & mask[node])
            keep = (total <= radius) & (uniform[level][node] != labels[who])
            who, node, total = who[keep], node[keep], total[keep]
            if not len(who):
                continue
            if level == 0:
                yield who, node
                continue
            sizes = ends[node] - starts[node]
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            todo.append((level - 1, np.repeat(who, sizes), np.repeat(starts[node], sizes) + inside, np.repeat(total, sizes)))


def _join_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked positions one label, the smallest position of their set."""
    while True:
        a, b = labels[left], labels[right]
        if (a == b).all():
            return
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def linked_sets(groups: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """For each entry the position of the first entry of its linked set, within its group."""
    index, labels = GrayIndex(groups, values), np.arange(len(values))
    for start in range(0, len(values), SEARCHES):
        queries = np.arange(start, min(start + SEARCHES, len(values)))
        for who, found in index.matches(queries, radius, labels.copy()):
            _join_labels(labels, who, found)
    return labels


def link_edges(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) edges between distinct fingerprints ``fp`` that connect exactly what the radius links.

    Each fingerprint goes to one group for each choice of blocks; a group gives at most one
    edge for each of its members, however many links it has.
    """
    rows = values.count()
    masks = block_masks(radius, blocks_to_match(rows, radius))
    keys = F.array(*[F.struct(F.lit(i).alias("n"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    session = values.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-rows * len(masks) // TASK_ENTRIES))
    entries = values.select("fp", F.explode(keys).alias("block")).select("fp", "block.n", "block.key")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        n, key, fp = (table.column(c).to_numpy() for c in ("n", "key", "fp"))
        fp = fp.view(np.uint64) if fp.dtype == np.int64 else fp.astype(np.uint64)
        order = np.lexsort((gray_rank(fp), key, n))
        n, key, fp = n[order], key[order], fp[order]
        fresh = np.ones(len(fp), dtype=bool)
        fresh[1:] = (n[1:] != n[:-1]) | (key[1:] != key[:-1])
        labels = linked_sets(np.cumsum(fresh), fp, radius)
        tied = np.flatnonzero(labels != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[tied].view(np.int64)), pa.array(fp[labels[tied]].view(np.int64))], ["a", "b"]
        )

    return entries.repartition(tasks, "n", "key").mapInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(id, fingerprint, component_id, group_key, kept columns): every row with its near-duplicate group.

    Two rows are linked when their fingerprints differ in at most ``radius`` bits; a group is
    what can be reached over links. ``component_id`` is the smallest id of the group, NULL only
    when no row of it has an id; ``group_key`` names the group and is never NULL. A NULL or
    empty text has fingerprint zero and is linked like any other; repeated rows stay repeated;
    an empty table gives an empty result. Columns other than the two named and ``keep`` are ignored.

    Equal fingerprints are reduced to one before any search, with partial aggregation, so copies
    cost no more than the first. Fingerprints are computed once and kept as a table in the
    shared folder.
    """
    folder = work_folder(docs.sparkSession, "simhash")
    rows = stored(with_fingerprint(docs, id_column, text, keep), f"{folder}/rows")
    values = stored(rows.groupBy("fp").agg(F.min(id_column).alias("least")), f"{folder}/values")
    sets = components(link_edges(values, radius)).withColumnsRenamed({"node": "fp", "root": "group_key"})
    members = values.join(sets, "fp", "left").withColumn("group_key", F.coalesce("group_key", "fp"))
    ids = members.groupBy("group_key").agg(F.min("least").alias("component_id"))
    named = members.join(ids, "group_key").select("fp", "group_key", "component_id")
    return rows.join(named, "fp").select(
        id_column, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_key", *keep
    )


def with_row_key(docs: DataFrame) -> DataFrame:
    """The documents as stored rows, each with a number ``__key`` of its own."""
    folder = work_folder(docs.sparkSession, "rows")
    return stored(docs.withColumn("__key", F.monotonically_increasing_id()), f"{folder}/keyed")


def first_of_each_group(rows: DataFrame, groups: DataFrame, id_column: str) -> DataFrame:
    """The row with the smallest id, then ``__key``, of each group; a NULL id ranks above all ids.

    ``groups`` has the id, ``__key`` and ``group_key`` of every row. Keys are unique, so exactly one
    row of each group stays.
    """
    rank = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), "__key")
    chosen = groups.groupBy("group_key").agg(F.min(rank).alias("first")).select(F.col("first.__key").alias("__key"))
    return rows.join(chosen, "__key", "left_semi").drop("__key")


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The documents with the smallest id of each near-duplicate group, one row of each group.

    Where several rows have that id, or no row of a group has an id, one of them stays.
    """
    rows = with_row_key(docs)
    groups = near_duplicates(rows, id_column, text, radius, keep=("__key",))
    return first_of_each_group(rows, groups, id_column).select(*docs.columns)
