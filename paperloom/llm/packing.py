"""Vector bin packing of examples into sequences under several limits at once.

Each example needs tokens, one segment and some loss-bearing tokens. A sequence is filled one
example after the other: of those that still fit, the one whose needs have the largest dot
product with what is left of the limits, each limit weighted by how much of it all examples
need together.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paperloom.llm.pieces import ByteIds, ragged_places
from paperloom.llm.text import slices
from paperloom.session import work_folder

SEQUENCE_TOKENS = 2048
MAX_SEGMENTS = 12
#: Loss-bearing tokens of a sequence, and the most ids of a piece: a whole piece reaches the limit.
LOSS_TOKENS = 2040
TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
#: Examples that are packed together; each such group ends with at most a few open sequences.
GROUP_ITEMS = 4096


def document_pieces(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None, limit: int = LOSS_TOKENS
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, loss_tokens): each document's ids cut into pieces.

    A document is its token ids and an end id, which bears no loss. It is cut after every
    ``limit`` ids; a NULL or empty text is one piece with the end id alone. The tokenizer is
    used as its file has it, so a special token's string gives that token. Every row is a
    document, whether its id is NULL or repeated; of further columns none is in the result.
    """
    path = tokenizer or str(public_tokenizers.path(TOKENIZER))
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "loss_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = ByteIds(path)
        for batch in batches:
            for part in slices(batch, text):
                ids, sizes = book.encode(part.column(text))
                ids = np.insert(ids, np.cumsum(sizes), END_ID).astype("<u4")
                sizes = sizes + 1
                counts = -(-sizes // limit)
                row = np.repeat(np.arange(len(sizes)), counts)
                start = ragged_places(np.zeros_like(counts), counts) * limit
                length = np.minimum(limit, sizes[row] - start)
                ends, body = np.cumsum(length).tolist(), memoryview(ids).cast("B")
                sums = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip([0, *ends], ends)]
                loss = length - (start + length == sizes[row])
                ids_of = part.column(id_column).take(pa.array(row))
                columns = [pa.array(v, pa.int64()) for v in (start, length, sums, sizes[row], loss)]
                yield pa.RecordBatch.from_arrays([ids_of, *columns], names)

    schema = f"`{id_column}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long"
    return docs.select(id_column, text).mapInArrow(cut, schema)


def pack_vectors(needs: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``needs`` the number of its sequence and its place in it."""
    count = len(needs)
    share = needs / limits
    weight = share.sum(axis=0)
    sequence, place = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
    full = np.flatnonzero((needs >= limits).any(axis=1))
    sequence[full] = np.arange(len(full))
    current = len(full)
    open_rows = np.flatnonzero(~(needs >= limits).any(axis=1))
    # Examples with equal needs are interchangeable: one line each, with the rows that have them.
    kinds, kind = np.unique(needs[open_rows], axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    queue = open_rows[np.argsort(kind, kind="stable")]
    ends = np.cumsum(np.bincount(kind, minlength=len(kinds)))
    left = np.bincount(kind, minlength=len(kinds))
    scaled = kinds / limits * weight / limits
    while len(kinds):
        room, at = limits.astype(np.float64), 0
        while True:
            fits = (kinds <= room).all(axis=1)
            if not fits.any():
                break
            pick = int(np.argmax(np.where(fits, scaled @ room, -1.0)))
            row = queue[ends[pick] - left[pick]]
            sequence[row], place[row] = current, at
            room -= kinds[pick]
            at += 1
            left[pick] -= 1
            if not left[pick]:
                keep = np.arange(len(kinds)) != pick
                kinds, scaled, left, ends = kinds[keep], scaled[keep], left[keep], ends[keep]
        current += 1
    return sequence, place


def pack(
    examples: DataFrame,
    tokens: str = "tokens",
    loss_tokens: str = "loss_tokens",
    limits: tuple[int, int, int] = (SEQUENCE_TOKENS, MAX_SEGMENTS, LOSS_TOKENS),
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """All columns plus ``sequence_id`` and ``offset``, the example's first token in its sequence.

    ``limits`` are the most tokens, segments and loss-bearing tokens of a sequence. An example
    that fills or exceeds a limit gets a sequence of its own. NULL needs count as zero, repeated
    examples are packed each for itself, no examples give no rows. Input columns named
    ``sequence_id`` or ``offset`` are replaced.

    The examples are dealt out at random to groups of about ``group_items``, whatever their
    keys, and each group is packed by one task.
    """
    spark, folder = examples.sparkSession, work_folder(examples.sparkSession, "packing")
    rows = examples.drop("sequence_id", "offset")
    names, most = rows.columns, np.array(limits, dtype=np.int64)
    rows.withColumn("__draw", F.xxhash64(F.rand(11))).write.parquet(f"{folder}/examples")
    stored = spark.read.parquet(f"{folder}/examples")
    groups = max(1, math.ceil(stored.count() / group_items))
    stored = stored.withColumn("__group", F.pmod("__draw", F.lit(groups))).drop("__draw")

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([(n, "ascending") for n in names if pa.types.is_integer(table.schema.field(n).type)])
        sizes = [pc.fill_null(table.column(n), 0).to_numpy() for n in (tokens, loss_tokens)]
        needs = np.stack([sizes[0], np.ones(len(sizes[0]), dtype=np.int64), sizes[1]], axis=1).astype(np.int64)
        sequence, spot = pack_vectors(needs, most)
        order = np.lexsort((spot, sequence))
        before = np.cumsum(needs[order, 0]) - needs[order, 0]
        first = np.flatnonzero(np.diff(sequence[order], prepend=-1))
        offset = np.zeros(len(order), dtype=np.int64)
        offset[order] = before - np.repeat(before[first], np.diff(first, append=len(order)))
        group = table.column("__group").to_numpy()
        out = table.select(names).append_column("sequence_id", pa.array(group * (1 << 24) + sequence))
        return out.append_column("offset", pa.array(offset))

    added = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    schema = StructType([*rows.schema.fields, *added])
    return stored.groupBy("__group").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Every document's pieces with their places in sequences of ``SEQUENCE_TOKENS``.

    All tokens of a document but its end id bear loss. See ``document_pieces`` for the pieces
    and ``pack`` for the placing.
    """
    placed = pack(document_pieces(docs, id_column, text, tokenizer), tokens="length")
    return placed.select(id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
