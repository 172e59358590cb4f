import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import docs  # noqa: F401
from paperloom.llm import fmindex, substrings
from paperloom.llm.fmindex import FmIndex, WaveletMatrix, suffix_order


def brute(rows):
    split = [(2**63 if i is None else i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in split:
        for at in range(len(words) - 12):
            name = b" ".join(words[at : at + 13])
            least[name] = min(least.get(name, i), i)
    out = []
    for (doc, _), (i, words) in zip(rows, split):
        lost = {p for at in range(len(words) - 12) if least[b" ".join(words[at : at + 13])] < i for p in range(at, at + 13)}
        kept = b" ".join(w for p, w in enumerate(words) if p not in lost).decode()
        out.append((doc, kept, len(words), len(lost)))
    return sorted(out, key=str)


def corpus(seed):
    draw = random.Random(seed)
    prose = lambda n: [draw.choice("abcdefghijklmnopqrstuvwxyz") + str(draw.randint(0, 30)) for _ in range(n)]
    passages = [prose(n) for n in (12, 13, 14, 40, 200)]
    rows = []
    for i in draw.sample(range(1000), 60):
        words = prose(draw.randint(0, 80))
        for _ in range(draw.randint(0, 3)):
            own = list(draw.choice(passages))
            if draw.random() < 0.4:
                own[draw.randrange(len(own))] = "changed"
            at = draw.randint(0, len(words))
            words[at:at] = own
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("buffer", [1 << 24, 2000])
def test_passages_equal_brute_force(docs, monkeypatch, buffer):
    monkeypatch.setattr(substrings, "BUFFER_BYTES", buffer)
    monkeypatch.setattr(substrings, "ANCHOR_TEXT", 9000)
    monkeypatch.setattr(substrings, "SHARD_TEXT", 5000)
    rows = corpus(buffer)
    rows += [(2000 + i, "the same copy of a text with more than thirteen words in it for all of them") for i in range(30)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "The " * 500), (3004, "The " * 300), (3005, "The " * 12), (3003, "The " * 40)]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (rows[1][0], rows[2][1]), (rows[1][0], rows[1][1]), (4000, "w " * 20_000 + rows[3][1])]
    frame = docs(rows, 4).withColumns({"n_words": F.lit("x"), "row": F.lit(1), "doc": F.lit(2), "shared": F.lit(3), "body": F.lit(4)})
    found = substrings.dedup_substrings(frame)
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in found.collect()), key=str) == brute(rows)


def test_nothing_to_compare(docs):
    assert substrings.dedup_substrings(docs([])).count() == 0
    row = substrings.dedup_substrings(docs([(1, " a  b ")])).first()
    assert (row.text, row.n_words, row.n_removed) == ("a b", 2, 0)


def test_wavelet_ranks_equal_counts():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 37, 1000)
    tree = WaveletMatrix(values, 6)
    places = draw.integers(0, 1001, 300)
    for number in range(37):
        same = np.full(len(places), number)
        got = tree.descend(same, places) - tree.descend(same, np.zeros(len(places), dtype=np.int64))
        assert got.tolist() == [int((values[:p] == number).sum()) for p in places]


@pytest.mark.parametrize(("alphabet", "length"), [(2, 13), (3, 5), (5000, 13), (1 << 40, 13)])
def test_search_equals_counting(alphabet, length):
    draw = np.random.default_rng(2)
    symbols = draw.integers(1, 4, 400) * (alphabet // 4 + 1)
    symbols[::37] = 0
    symbols[-1] = 0
    if alphabet > 1 << 30:
        order = suffix_order(symbols, length)
    else:
        index = FmIndex(symbols, length)
        order = index.order
        starts = np.array([s for s in range(400 - length) if 0 not in symbols[s : s + length]])
        matched, low, high = index.search(symbols, starts)
        text = symbols.tolist()
        for s, m, a, b in zip(starts.tolist(), matched, low, high):
            count = lambda n: sum(text[i : i + n] == text[s + length - n : s + length] for i in range(401 - n))
            want = max([n for n in range(1, length + 1) if count(n) >= 2], default=0)
            assert m == want
            assert b - a == (count(length) if want == length else 0)
            if want == length:
                assert all(text[i : i + length] == text[s : s + length] for i in order[a:b])
    padded = symbols.tolist() + [0] * length
    runs = [padded[i : i + length] for i in order]
    assert runs == sorted(runs)


def test_a_common_notice_in_different_surroundings_is_split(docs, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_WORDS", 100)
    monkeypatch.setattr(substrings, "SHARD_TEXT", 4000)
    monkeypatch.setattr(substrings, "BUFFER_BYTES", 2000)
    indexed, covered_spans = spark_counter(docs), substrings.covered_spans

    def counted(docs, sizes, words):
        indexed.add(int(sizes.max()))
        return covered_spans(docs, sizes, words)

    monkeypatch.setattr(substrings, "covered_spans", counted)
    draw = random.Random(8)
    notice = " ".join(f"n{i}" for i in range(14))
    rows = []
    for i in range(120):
        before, after = (" ".join(str(draw.random()) for _ in range(20)) for _ in range(2))
        rows.append((i, f"{before} {notice} {after}"))
    found = substrings.dedup_substrings(docs(rows, 4)).collect()
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in found), key=str) == brute(rows)
    assert indexed.value == substrings.WINDOW  # the shards hold single windows, not the surroundings


def spark_counter(docs):
    from pyspark.accumulators import AccumulatorParam

    class Largest(AccumulatorParam):
        def zero(self, value):
            return 0

        def addInPlace(self, one, other):
            return max(one, other)

    return docs([]).sparkSession.sparkContext.accumulator(0, Largest())


def test_windows_of_the_same_words_are_searched_once(monkeypatch):
    passage = list(range(1, 41))
    symbols = np.array(([*passage, 0] * 5) + [*range(50, 90), 0])
    starts = np.concatenate([np.arange(28) + 41 * copy for copy in range(6)])
    index, searched = fmindex.FmIndex(symbols, substrings.WINDOW), []
    plain = index._search
    monkeypatch.setattr(index, "_search", lambda s, at: searched.extend(at.tolist()) or plain(s, at))
    matched, low, high = index.search(symbols, starts)
    assert len(searched) == 2 * 28
    assert (high - low).tolist() == [5] * 140 + [0] * 28 and (matched == substrings.WINDOW).tolist() == [True] * 140 + [False] * 28
    # Where all hashes are alike, windows that differ are still told apart.
    monkeypatch.setattr(fmindex, "grams", lambda words, length: np.zeros(len(words) - length + 1, dtype=np.uint64))
    assert all((a == b).all() for a, b in zip(index.search(symbols, starts), (matched, low, high)))
