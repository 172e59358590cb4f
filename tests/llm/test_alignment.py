import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_rows import docs  # noqa: F401
from paperloom.llm import alignment
from paperloom.llm.queries import op12_diagonal_alignment

LETTERS = alignment._byte_of_letter()
PARTS = ["the", "Word", " ", "  ", "\n", "\n\n", ".", ",", "'s", "12", "é", "日本", "\t", "\xa0", " ", "!?", ", ", "😀", "<s>", "</s>", "<|endoftext|>", "<0x41>", "-", ":x", "\r\n", "\x00", "ab" * 40, "▁"]
_DRAW = random.Random(5)
ODD = ["".join(_DRAW.choices(PARTS, k=_DRAW.randint(1, 25))) for _ in range(300)]
TEXTS = [None, "", " ", "word", " lead", "trail ", "two  spaces", "\n", "<s> is text", "a▁b", "don't", "word " * 2000, "ab" * 5000, "x" * 300_000, *ODD]


@pytest.fixture(scope="module")
def tokens():
    left = Tokenizer.from_file(str(public_tokenizers.path(alignment.BYTE_TOKENIZER)))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(alignment.PIECE_TOKENIZER)))

    def both(text):
        if not text:
            return [], []
        a = left.encode(" " + text, add_special_tokens=False).ids
        b = right.encode(text)
        pa_ = [bytes(LETTERS[c] for c in left.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in a]
        pb = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        if b"".join(pa_) != whole or b"".join(pb) != whole:
            return [], []
        return list(zip(a, map(len, pa_))), list(zip(b, map(len, pb)))

    return both


def brute_groups(left, right):
    ends_a, ends_b = np.cumsum([n for _, n in left]), np.cumsum([n for _, n in right])
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        x, y = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        groups.append(([t for t, _ in left[i:x]], [t for t, _ in right[j:y]]))
        i, j = x, y
    return groups


def brute(rows, tokens):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every document."""
    all_groups = [(i, *map(len, both), brute_groups(*both)) for i, t in rows for both in [tokens(t)]]
    links = []
    for _, _, _, groups in all_groups:
        link = Counter()
        for a, b in groups:
            for x, n in Counter(a).items():
                for y, m in Counter(b).items():
                    link[x, y] += n * m
        links.append(link)
    holders = Counter(pair for link in links for pair in link)
    most = {}
    for (x, _), n in holders.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (i, n_a, n_b, groups), link in zip(all_groups, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(n for p, n in link.items() if holders[p] == most[p[0]])
        total = sum(n * holders[p] for p, n in link.items())
        digest = hashlib.sha256(said.encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), sum(link.values()), best, total, digest))
    return sorted(out, key=str)


def found(frame):
    names = ["doc_id", *alignment.RESULT, "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


@pytest.mark.parametrize("chunk_text", [alignment.CHUNK_TEXT, 400])
def test_odd_texts_equal_brute_force(docs, tokens, chunk_text):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "word"), (None, "no id"), (None, None)]
    frame = docs(rows).withColumns({n: F.lit("x") for n in ("id", "chunk", "n_a", "pairs", "slot", "holders", "rows")})
    assert found(alignment.align_tokenizers(frame, chunk_text=chunk_text)) == brute(rows, tokens)


def test_a_chunk_is_many_small_rows(docs, tokens, tmp_path):
    """Readers hold thousands of rows at once, so none may be as large as a chunk."""
    draw = random.Random(7)
    rows = [(i, " ".join(f"w{draw.random()}" for _ in range(40))) for i in range(200)] + [(900, "far and wide " * 3000)]
    frame = docs(rows).coalesce(1)
    paths = [str(public_tokenizers.path(n)) for n in (alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER)]
    alignment.aligned_chunks(frame, "doc_id", "text", *paths, alignment.CHUNK_TEXT).write.parquet(str(tmp_path / "chunks"))
    parts = frame.sparkSession.read.parquet(str(tmp_path / "chunks")).orderBy("part").collect()
    assert len({r.chunk for r in parts}) == 1
    assert max(len(r[n]) for r in parts for n in ("slots", "times", "pairs", "holders")) == 512
    assert max(len(r[n]) for r in parts for n in ("rows", "sizes")) == 64
    assert sum(len(r.rows) for r in parts) == len(rows) and sum(n for r in parts for n in r.sizes) == sum(len(r.slots) for r in parts)
    assert found(alignment.align_tokenizers(frame)) == brute(rows, tokens)


def test_query_equals_brute_force(spark, tokens):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op12_diagonal_alignment(spark, folder)) == brute(rows, tokens)


def test_no_documents(docs):
    assert alignment.align_tokenizers(docs([])).count() == 0
    assert found(alignment.align_tokenizers(docs([(1, None), (2, "")]))) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


@pytest.mark.parametrize("seed", range(30))
def test_common_ends_of_random_arrays(seed):
    draw = np.random.default_rng(seed)
    top = int(draw.integers(1, 400))
    ends = [np.unique(np.append(draw.integers(1, top + 1, int(draw.integers(1, top + 1))), top)) for _ in range(2)]
    if seed % 3 == 0:  # long one-to-one stretches
        ends[1] = np.unique(np.append(np.setdiff1d(ends[0], draw.choice(ends[0], len(ends[0]) // 20)), top))
    got = alignment.common_ends(*ends)
    common = np.intersect1d(*ends)
    assert [np.searchsorted(e, common).tolist() for e in ends] == [(g - 1).tolist() for g in got]


def test_wide_groups_count_every_pair():
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 9, 500).astype(np.uint32), draw.integers(0, 7, 400).astype(np.uint32)
    in_a, in_b = np.array([3, 490, 7]), np.array([2, 390, 8])
    pairs, times, rows = alignment._links(a, b, in_a, in_b)
    got, want = Counter(), Counter()
    for group, (p, t) in enumerate(zip(np.split(pairs, np.cumsum(rows)[:-1]), np.split(times, np.cumsum(rows)[:-1]))):
        for x, n in zip(p.tolist(), t.tolist()):
            got[group, x] += n
    for group, (x, y) in enumerate(zip(np.split(a, np.cumsum(in_a)[:-1]), np.split(b, np.cumsum(in_b)[:-1]))):
        for i in x.tolist():
            for j in y.tolist():
                want[group, i << 32 | j] += 1
    assert got == want and len(pairs) < 200


def test_texts_beside_each_other_do_not_matter(tokens):
    paths = [str(public_tokenizers.path(n)) for n in (alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER)]
    book = alignment.AlignedPieces(*paths)
    whole = book.align(pa.array(TEXTS, pa.string()))
    alone = [alignment.AlignedPieces(*paths).align(pa.array([t], pa.string()))["digest"][0] for t in TEXTS[:12]]
    assert whole["digest"][:12] == alone
