"""Token data of texts, put together from pieces that are each tokenized once.

Texts are cut before a space that follows a character other than white space, and before a line
end or one of ``.,;:!?`` that follows an ASCII letter or digit. The byte-level tokenizer starts
anew there, and no piece of the sentence tokenizer reaches over such a place, so what lies
between two cuts is tokenized alike wherever it stands. Texts with further white space or with a
special token's string are one piece.
"""

import hashlib
import os
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from paperloom.llm.text import _BASE, _BYTE, mix, powers

#: Pieces and token numbers a task remembers at most before it starts anew.
MEMORY_PIECES = 1_000_000
MEMORY_VALUES = 8_000_000
#: Longer pieces are told apart by a digest of their own and are not remembered.
LONG_PIECE = 1024
#: Pieces that are tokenized as one text.
JOINED = 512
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_WORD = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?\n")] = True
#: Stands before a piece that begins with a mark; one token of its own.
CARRIER = b" a"
#: First bytes of what may be white space beyond ASCII, and the separators some call white space.
_SUSPECT = np.zeros(256, dtype=bool)
_SUSPECT[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_OTHER_BLANKS = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xa0]|\xe2\x96\x81|\xe3\x80\x80"
)
_POWERS = powers(_BASE, LONG_PIECE)


def ragged_places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start``, ``start + 1``, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Ragged:
    """Runs of numbers of different lengths, in one growing array."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 16, dtype=kind), 0
        self.starts, self.runs = np.zeros(1 << 14, dtype=np.int64), 0

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        grown = np.zeros(max(need, 2 * len(array)), dtype=array.dtype)
        grown[: len(array)] = array
        return grown

    def append(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = self._room(self.values, self.used + len(values))
        self.starts = self._room(self.starts, self.runs + len(sizes) + 1)
        self.values[self.used : self.used + len(values)] = values
        self.starts[self.runs + 1 : self.runs + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.used += len(values)
        self.runs += len(sizes)

    def take(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the given runs and how many each has."""
        starts = self.starts[runs]
        sizes = self.starts[runs + 1] - starts
        return self.values[ragged_places(starts, sizes)], sizes


class Cut:
    """Texts as pieces: ``starts`` in ``data``, ``first`` has the number of each text's first piece."""

    def __init__(self, texts: pa.Array, special: Sequence[str] = ()):
        raw = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset :][: len(raw) + 1]
        body = raw.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
        self.data = data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = (data[1:] == 32) & ~_BLANK[data[:-1]] | _MARK[data[1:]] & _WORD[data[:-1]]
        self.odd = self._odd(data, offsets, [s.encode() for s in special])
        for row in np.flatnonzero(self.odd):
            cut[offsets[row] : offsets[row + 1]] = False
        filled = np.diff(offsets) > 0
        cut[offsets[:-1][filled]] = True
        cut[-1] = False
        self.starts = np.flatnonzero(cut)
        self.ends = np.append(self.starts[1:], len(data))
        self.first = np.searchsorted(self.starts, offsets)

    @staticmethod
    def _odd(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> np.ndarray:
        odd = np.zeros(len(offsets) - 1, dtype=bool)
        text = data.tobytes()
        for place in np.unique(np.searchsorted(offsets, np.flatnonzero(_SUSPECT[data]), side="right") - 1):
            odd[place] = bool(_OTHER_BLANKS.search(text, offsets[place], offsets[place + 1]))
        for string in special:
            at = text.find(string)
            while at >= 0:
                odd[np.searchsorted(offsets, at, side="right") - 1] = True
                at = text.find(string, at + 1)
        return odd

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each piece."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        sizes = self.ends - self.starts
        place = np.arange(len(self.data), dtype=np.int64)
        place -= np.repeat(self.starts, sizes)
        np.bitwise_and(place, LONG_PIECE - 1, out=place)
        values = _POWERS[place]
        values *= _BYTE[self.data]
        out = mix(np.add.reduceat(values, self.starts) + sizes.astype(np.uint64))
        for row in np.flatnonzero(sizes > LONG_PIECE):
            digest = hashlib.blake2b(self.data[self.starts[row] : self.ends[row]].tobytes(), digest_size=8)
            out[row] = int.from_bytes(digest.digest(), "little")
        return out

    def texts_of(self) -> np.ndarray:
        """For each piece the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class PieceBook:
    """What ``learn`` says about each distinct piece; 64-bit hashes tell pieces apart."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.names = np.zeros(0, dtype=np.uint64)
        self.rows = np.zeros(0, dtype=np.int64)
        self.count = 0
        self.clear()

    def clear(self) -> None:
        """Start the learnt data anew."""
        raise NotImplementedError

    def learn(self, pieces: list[bytes], carried: np.ndarray, joinable: np.ndarray) -> None:
        """Append the data of each new piece, in order; ``carried`` and ``joinable`` as in ``split_runs``."""
        raise NotImplementedError

    def held(self) -> int:
        """How many numbers are remembered."""
        raise NotImplementedError

    def look_up(self, cut: Cut) -> np.ndarray:
        """The row of each piece; new pieces are learnt first."""
        if self.count > MEMORY_PIECES or self.held() > MEMORY_VALUES:
            self.forget()
        names, place, back = np.unique(cut.hashes(), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.names, names)
        known = np.zeros(len(names), dtype=bool)
        inside = spot < len(self.names)
        known[inside] = self.names[spot[inside]] == names[inside]
        rows = np.zeros(len(names), dtype=np.int64)
        rows[known] = self.rows[spot[known]]
        new = np.flatnonzero(~known)
        if len(new):
            at = place[new]
            starts, ends = cut.starts[at], cut.ends[at]
            text = cut.data.tobytes()
            pieces = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            odd = cut.odd[np.searchsorted(cut.first, at, side="right") - 1]
            opens = cut.data[starts]
            carried = _MARK[opens] & ~odd
            joinable = ((opens == 32) | carried) & ~_BLANK[cut.data[ends - 1]] & ~odd
            self.learn(pieces, carried, joinable)
            rows[new] = self.count + np.arange(len(new))
            self.count += len(new)
            # Both are sorted, so the new names slip in between the old ones.
            self.names = np.insert(self.names, spot[new], names[new])
            self.rows = np.insert(self.rows, spot[new], rows[new])
        return rows[back.reshape(-1)]


def split_runs(
    pieces: list[bytes],
    carried: np.ndarray,
    joinable: np.ndarray,
    encode: Callable[[list[bytes]], list[np.ndarray]],
    lengths: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces one after the other, and how many each piece has.

    ``encode`` gives the ids of some texts and ``lengths`` the bytes of each id. Carried pieces
    begin with a mark and are encoded behind ``CARRIER``, whose token is dropped. Joinable pieces
    are encoded many at a time; where their ends are no ends of tokens, each by itself.
    """
    whole = [CARRIER + p if c else p for p, c in zip(pieces, carried.tolist())]
    runs, start = [], 0
    for stop in [*np.flatnonzero(~joinable).tolist(), len(pieces)]:
        runs += [(a, min(a + JOINED, stop)) for a in range(start, stop, JOINED)]
        if stop < len(pieces):
            runs.append((stop, stop + 1))
        start = stop + 1
    out, sizes = [], []
    for (a, b), found in zip(runs, encode([b"".join(whole[a:b]) for a, b in runs])):
        if b - a > 1:
            wanted = np.cumsum([len(p) for p in whole[a:b]])
            ends = np.cumsum(lengths[found])
            last = np.searchsorted(ends, wanted)
            if last[-1] == len(ends) - 1 and (ends[last] == wanted).all():
                counts = np.diff(last, prepend=-1)
            else:
                parts = encode(whole[a:b])
                found, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        else:
            counts = np.array([len(found)])
        drop = carried[a:b]
        if drop.any():
            found = np.delete(found, (np.cumsum(counts) - counts)[drop])
            counts = counts - drop
        out.append(found)
        sizes.append(counts)
    return np.concatenate(out), np.concatenate(sizes).astype(np.int64)


class ByteTokenizer:
    """Ids of pieces by a byte-level tokenizer file, and the bytes each id stands for."""

    def __init__(self, path: str, special_as_text: bool = False):
        # Spark's tasks are the parallelism.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lengths = np.array([len(t.encode()) if t in self.special else len(t) for t in tokens], dtype=np.int64)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def encode(self, pieces: list[bytes], carried: np.ndarray, joinable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids one after the other, and how many each piece has."""
        return split_runs(pieces, carried, joinable, self._encode, self.lengths)


class ByteIds(PieceBook):
    """Token ids of texts by a byte-level tokenizer file, special tokens included."""

    def __init__(self, path: str):
        self.tokens = ByteTokenizer(path)
        super().__init__()

    def clear(self) -> None:
        self.ids = Ragged(np.uint32)

    def held(self) -> int:
        return self.ids.used

    def learn(self, pieces: list[bytes], carried: np.ndarray, joinable: np.ndarray) -> None:
        self.ids.append(*self.tokens.encode(pieces, carried, joinable))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and how many each text has."""
        cut = Cut(texts, self.tokens.special)
        rows = self.look_up(cut)
        ids, sizes = self.ids.take(rows)
        return ids, np.diff(np.concatenate(([0], np.cumsum(sizes)))[cut.first])
