"""Alignment of two tokenizers over the same texts by diagonal run skipping.

Both tokenizers cut a text's bytes; places where both end a token cut it into groups. The end
arrays are walked with one index each. While they agree at the current shift of the indices,
tokens stand one to one, and such a stretch is jumped by probing ever longer runs of both arrays.
Where they disagree the group is settled locally, which changes the shift.

Pieces between cuts that both tokenizers respect (``pieces``) are aligned once per task. How many
documents link an id pair is counted over the whole corpus; each chunk of documents then asks for
the counts of its own distinct pairs by a join on the pair.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.pieces import CARRIER, ByteTokenizer, Cut, PieceBook, Ragged, ragged_places, split_runs
from paperloom.llm.text import slices
from paperloom.session import work_folder

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
#: Bytes of text whose pairs are looked up together; a longer text is a chunk of its own.
CHUNK_TEXT = 8 << 20
#: Links or pairs, and documents, that one stored row of a chunk has; readers and writers hold thousands of rows at once.
ROW_LINKS, ROW_DOCUMENTS = 512, 64
#: Stored rows of a chunk that are handed on together.
ROWS_AT_ONCE = 512
#: Links of a group from which on its equal tokens are put together first.
WIDE_GROUP = 4096
RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def common_ends(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group, how many tokens of ``left`` and ``right`` lie up to its end.

    Both hold ascending end offsets, the last ones being equal.
    """
    a, b, ends_a, ends_b = left.tolist(), right.tolist(), [], []
    i, j, n, m = 0, 0, len(a), len(b)
    while i < n:
        step, run = 1, 0
        # Along the diagonal: twice as far after each match, half as far after a miss.
        growing = True
        while step:
            size = min(step, n - i - run, m - j - run)
            if size and a[i + run : i + run + size] == b[j + run : j + run + size]:
                run += size
                step = 2 * step if growing else step // 2
            else:
                growing, step = False, min(step, size) // 2
        if run:
            ends_a.extend(range(i + 1, i + run + 1))
            ends_b.extend(range(j + 1, j + run + 1))
            i, j = i + run, j + run
            if i == n:
                break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i, j = i + 1, j + 1
        ends_a.append(i)
        ends_b.append(j)
    return np.array(ends_a, dtype=np.int64), np.array(ends_b, dtype=np.int64)


def _byte_of_letter() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenBytes:
    """The bytes each id stands for."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged_places(self.starts[ids], self.lengths[ids])]

    def spell(self, ids: np.ndarray, counts: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Whether each piece's ids stand for exactly its bytes."""
        own = np.array([len(p) for p in pieces])
        reach = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        ends = np.cumsum(counts)
        good = reach[ends] - reach[ends - counts] == own
        text = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        if good.all():
            wrong = np.flatnonzero(self.of(ids) != text)
            good[np.searchsorted(np.cumsum(own), wrong, side="right")] = False
            return good
        for row in np.flatnonzero(good):
            good[row] = self.of(ids[ends[row] - counts[row] : ends[row]]).tobytes() == pieces[row]
        return good


class PieceTokenizer:
    """Ids of pieces by a sentence tokenizer that puts a space before each text."""

    def __init__(self, path: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.processor
        ids = range(model.get_piece_size())
        self.tokens = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in ids]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        # Each begins with the space that the tokenizer adds; a space alone would be an empty text.
        bare = [(CARRIER + t if t == b" " else t)[1:].decode() for t in texts]
        found = self.processor.encode(bare, out_type=int, num_threads=1)
        return [np.array(ids[1:] if t == b" " else ids, dtype=np.uint32) for t, ids in zip(texts, found)]

    def encode(self, pieces: list[bytes], carried: np.ndarray, joinable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return split_runs(pieces, carried, joinable, self._encode, self.lengths)


def _without(values: np.ndarray, counts: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return values[np.repeat(good, counts)], np.where(good, counts, 0)


class AlignedPieces(PieceBook):
    """Tokens, groups and links of pieces under both tokenizers."""

    def __init__(self, byte_path: str, piece_path: str):
        self.left = ByteTokenizer(byte_path, special_as_text=True)
        self.right = PieceTokenizer(piece_path)
        letters = _byte_of_letter()
        model = self.left.tokenizer
        tokens = [model.id_to_token(i) or "" for i in range(model.get_vocab_size())]
        self.left_bytes = TokenBytes([t.encode() if t in self.left.special else bytes(letters[c] for c in t) for t in tokens])
        self.right_bytes = TokenBytes(self.right.tokens)
        self.digits = TokenBytes([f"{i},".encode() for i in range(max(len(tokens), len(self.right.tokens)))])
        super().__init__()

    def clear(self) -> None:
        self.a, self.b = Ragged(np.uint32), Ragged(np.uint32)
        self.group_a, self.group_b = Ragged(np.int32), Ragged(np.int32)
        self.pairs, self.times = Ragged(np.int64), Ragged(np.int64)
        self.good = Ragged(np.bool_)

    def held(self) -> int:
        return sum(kept.used for kept in (self.a, self.b, self.group_a, self.group_b, self.pairs, self.times))

    def learn(self, pieces: list[bytes], carried: np.ndarray, joinable: np.ndarray) -> None:
        a, count_a = self.left.encode(pieces, carried, joinable)
        b, count_b = self.right.encode(pieces, carried, joinable)
        good = self.left_bytes.spell(a, count_a, pieces) & self.right_bytes.spell(b, count_b, pieces)
        (a, count_a), (b, count_b) = _without(a, count_a, good), _without(b, count_b, good)
        end_a, end_b = common_ends(np.cumsum(self.left_bytes.lengths[a]), np.cumsum(self.right_bytes.lengths[b]))
        in_a, in_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        piece = np.searchsorted(np.cumsum(count_a), end_a)
        groups = np.bincount(piece, minlength=len(pieces))
        pairs, times, links = _links(a, b, in_a, in_b)
        self.good.append(good, np.ones(len(pieces), dtype=np.int64))
        self.a.append(a, count_a)
        self.b.append(b, count_b)
        self.group_a.append(in_a, groups)
        self.group_b.append(in_b, groups)
        sizes = np.bincount(piece, weights=links, minlength=len(pieces)).astype(np.int64)
        self.pairs.append(pairs, sizes)
        self.times.append(times, sizes)

    def align(self, texts: pa.Array) -> dict[str, np.ndarray | list[str]]:
        """Per text its numbers and the digest of its groups; its distinct links one after the other."""
        empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True).to_numpy(zero_copy_only=False)
        cut = Cut(pc.binary_join_element_wise("", pc.fill_null(texts, ""), " "), self.left.special)
        rows, text_of, count = self.look_up(cut), cut.texts_of(), len(texts)
        bad = empty.copy()
        bad[text_of[~self.good.take(rows)[0]]] = True
        rows, text_of = rows[~bad[text_of]], text_of[~bad[text_of]]

        def total(sizes: np.ndarray, owners: np.ndarray = text_of) -> np.ndarray:
            return np.bincount(owners, weights=sizes, minlength=count).astype(np.int64)

        a, count_a = self.a.take(rows)
        b, count_b = self.b.take(rows)
        in_a, groups = self.group_a.take(rows)
        in_b, _ = self.group_b.take(rows)
        pairs, links = self.pairs.take(rows)
        times, _ = self.times.take(rows)
        n_groups = total(groups)
        keys, slot = np.unique(pairs, return_inverse=True)
        owner = np.repeat(text_of, links)
        held, place = np.unique(owner * max(len(keys), 1) + slot.reshape(-1), return_inverse=True)
        return {
            "n_a": total(count_a),
            "n_b": total(count_b),
            "n_groups": n_groups,
            "n_links": total(times, owner),
            "digest": self._digests(a, b, in_a, in_b, n_groups),
            "pairs": keys[held % max(len(keys), 1)],
            "times": np.bincount(place.reshape(-1), weights=times, minlength=len(held)).astype(np.int64),
            "sizes": np.bincount(held // max(len(keys), 1), minlength=count),
        }

    def _digests(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n_groups: np.ndarray) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text; an empty string for a text without tokens."""
        end_a, end_b = np.cumsum(in_a), np.cumsum(in_b)
        stream = np.empty(len(a) + len(b), dtype=np.uint32)
        stream[np.arange(len(a)) + np.repeat(end_b - in_b, in_a)] = a
        stream[np.arange(len(b)) + np.repeat(end_a, in_b)] = b
        body = self.digits.of(stream)
        reach = np.concatenate(([0], np.cumsum(self.digits.lengths[stream])))
        body[reach[end_a + end_b - in_b] - 1] = ord("|")
        body[reach[end_a + end_b] - 1] = ord(";")
        last = np.cumsum(n_groups)
        token = np.concatenate(([0], end_a + end_b))
        stops = reach[token[last]].tolist()
        raw = memoryview(body)
        return [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip([0, *stops], stops)]


def _links(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every A-B pair of each group with how often it occurs, and how many such rows a group has.

    A pair may have several rows; in a wide group equal tokens are put together first, so its
    rows grow with its distinct tokens.
    """
    times_a, times_b = np.ones(len(a), dtype=np.int64), np.ones(len(b), dtype=np.int64)
    wide = np.flatnonzero(in_a * in_b > WIDE_GROUP)
    if len(wide):
        a, times_a, in_a = _gathered(a, in_a, wide)
        b, times_b, in_b = _gathered(b, in_b, wide)
    first_b = np.cumsum(in_b) - in_b
    index_a = np.repeat(np.arange(len(a)), np.repeat(in_b, in_a))
    index_b = ragged_places(np.repeat(first_b, in_a), np.repeat(in_b, in_a))
    pairs = a[index_a].astype(np.int64) << 32 | b[index_b].astype(np.int64)
    return pairs, times_a[index_a] * times_b[index_b], in_a * in_b


def _gathered(ids: np.ndarray, counts: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids with those of the wide groups reduced to distinct ones, their repeats and the new counts."""
    ends, out, times, at = np.cumsum(counts), [], [], 0
    counts = counts.copy()
    for group in wide.tolist():
        start, stop = ends[group] - counts[group], ends[group]
        some, often = np.unique(ids[start:stop], return_counts=True)
        out += [ids[at:start], some]
        times += [np.ones(start - at, dtype=np.int64), often]
        counts[group], at = len(some), stop
    out.append(ids[at:])
    times.append(np.ones(len(ids) - at, dtype=np.int64))
    return np.concatenate(out), np.concatenate(times), counts


def _chunk_type(kind: T.DataType) -> T.StructType:
    row = [T.StructField("id", kind), *[T.StructField(n, T.LongType()) for n in RESULT[:4]], T.StructField("digest", T.StringType())]
    return T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("part", T.LongType()),
            T.StructField("rows", T.ArrayType(T.StructType(row))),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("slots", T.ArrayType(T.IntegerType())),
            T.StructField("times", T.ArrayType(T.LongType())),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("holders", T.ArrayType(T.LongType())),
        ]
    )


def _chunk(number: int, ids: list[pa.Array], found: list[dict]) -> Iterator[pa.RecordBatch]:
    """Some documents' numbers, and their links as slots in a list of distinct pairs, dealt out over rows.

    Each column is one list, cut into the rows' cells in the order of ``part``; slots count from the
    chunk's first pair.
    """
    joined = {n: np.concatenate([f[n] for f in found]) for n in (*RESULT[:4], "pairs", "times", "sizes")}
    pairs, slots = np.unique(joined["pairs"], return_inverse=True)
    slots = slots.reshape(-1)
    all_ids = pa.concat_arrays(ids)
    numbers = [pa.array(joined[n], pa.int64()) for n in RESULT[:4]]
    digests = pa.array([d for f in found for d in f["digest"]], pa.string())
    rows = pa.StructArray.from_arrays([all_ids, *numbers, digests], ["id", *RESULT[:4], "digest"])
    count = max(-(-len(rows) // ROW_DOCUMENTS), -(-len(slots) // ROW_LINKS))

    def cells(values: pa.Array, each: int) -> pa.Array:
        ends = np.minimum(np.arange(count + 1) * each, len(values))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    columns = {
        "chunk": pa.array(np.full(count, number), pa.int64()),
        "part": pa.array(np.arange(count), pa.int64()),
        "rows": cells(rows, ROW_DOCUMENTS),
        "sizes": cells(pa.array(joined["sizes"], pa.int64()), ROW_DOCUMENTS),
        "slots": cells(pa.array(slots, pa.int32()), ROW_LINKS),
        "times": cells(pa.array(joined["times"], pa.int64()), ROW_LINKS),
        "pairs": cells(pa.array(pairs, pa.int64()), ROW_LINKS),
        "holders": cells(pa.array(np.bincount(slots, minlength=len(pairs)), pa.int64()), ROW_LINKS),
    }
    return iter(pa.Table.from_arrays(list(columns.values()), list(columns)).to_batches(ROWS_AT_ONCE))


def aligned_chunks(docs: DataFrame, id_column: str, text: str, byte_path: str, piece_path: str, chunk_text: int) -> DataFrame:
    """Aligned documents, many to a chunk, which is several rows; a task's chunks are numbered by its partition and in it."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = AlignedPieces(byte_path, piece_path)
        number, size = TaskContext.get().partitionId() << 32, 0
        ids, found = [], []
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(text)
                found.append(book.align(column))
                ids.append(part.column(id_column))
                size += int(pc.sum(pc.binary_length(column)).as_py() or 0)
                if size >= chunk_text:
                    yield from _chunk(number, ids, found)
                    number, size, ids, found = number + 1, 0, [], []
        if found:
            yield from _chunk(number, ids, found)

    return docs.select(id_column, text).mapInArrow(align, _chunk_type(docs.schema[id_column].dataType))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, holders, best): how many documents hold each linked pair; whether no pair of its A id has more."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select("p.pairs", "p.holders")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("holders"))
    path = work_folder(chunks.sparkSession, "pair_counts")
    counts.withColumn("a", F.shiftright("pair", 32)).write.parquet(path)
    stored = chunks.sparkSession.read.parquet(path)
    most = stored.groupBy("a").agg(F.max("holders").alias("most"))
    return stored.join(most, "a").select("pair", "holders", (F.col("holders") == F.col("most")).alias("best"))


def align_tokenizers(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    byte_tokenizer: str | None = None,
    piece_tokenizer: str | None = None,
    chunk_text: int = CHUNK_TEXT,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per input row.

    A are the ids of a byte-level tokenizer file for a space and the text, B those of a sentence
    tokenizer for the text; strings of special tokens are plain text. ``n_best`` counts the links
    whose pair is held by as many documents as any pair of its A id, ``count_sum`` adds the
    documents that hold each link's pair. Every row is a document, whether its id is NULL or
    repeated. A NULL or empty text, and one that either tokenizer does not spell byte for byte,
    has no tokens: zeros and an empty string. Further columns are not in the result.

    What is kept of a document is one entry per distinct link, in rows of bounded size, so that a
    task may have any number of chunks. A chunk's distinct pairs meet their
    counts by a join on the pair, so a pair is asked for once per chunk and never broadcast.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "alignment")
    paths = [byte_tokenizer or str(public_tokenizers.path(BYTE_TOKENIZER)), piece_tokenizer or str(public_tokenizers.path(PIECE_TOKENIZER))]
    aligned_chunks(docs, id_column, text, *paths, chunk_text).write.parquet(f"{folder}/chunks")
    chunks = spark.read.parquet(f"{folder}/chunks")
    asked = chunks.select("chunk", "part", F.posexplode("pairs").alias("at", "pair"))
    asked = asked.select("chunk", "pair", (F.col("part") * ROW_LINKS + F.col("at")).alias("slot"))
    answers = asked.join(pair_counts(chunks), "pair").select("chunk", "slot", "holders", "best")

    def settle(own: pa.Table, scores: pa.Table) -> pa.Table:
        own = own.sort_by("part")
        row = {n: own.column(n).combine_chunks().flatten() for n in ("rows", "sizes", "slots", "times")}
        slots, times, sizes = (row[n].to_numpy() for n in ("slots", "times", "sizes"))
        holders, best = np.zeros(scores.num_rows, dtype=np.int64), np.zeros(scores.num_rows, dtype=np.int64)
        at = scores.column("slot").to_numpy()
        holders[at] = scores.column("holders").to_numpy()
        best[at] = scores.column("best").to_numpy()
        sums = [np.concatenate(([0], np.cumsum(times * values[slots]))) for values in (best, holders)]
        ends = np.cumsum(sizes)
        added = [pa.array(s[ends] - s[ends - sizes], pa.int64()) for s in sums]
        fields = row["rows"].flatten()
        return pa.Table.from_arrays([*fields[:5], *added, fields[5]], [id_column, *RESULT, "groups_sha256"])

    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [T.StructField(id_column, kind), *[T.StructField(n, T.LongType()) for n in RESULT], T.StructField("groups_sha256", T.StringType())]
    )
    narrow = spark.read.parquet(f"{folder}/chunks").select("chunk", "part", "rows", "sizes", "slots", "times")
    return narrow.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(settle, schema)
