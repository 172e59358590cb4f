import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import docs  # noqa: F401
from paperloom.llm import decontaminate, licenses
from paperloom.llm.text import Words, grams


def plain(text):
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "")).translate({i: i + 32 for i in range(65, 91)}).split()


def brute(docs, items, threshold=0.8):
    out = set()
    for doc, text in docs:
        words = plain(text)
        for item, item_text in items:
            own = plain(item_text)
            if not own:
                continue
            width = min(5, len(own))
            shingles = lambda w: [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]
            want, best = shingles(own), None
            for at in range(len(words) - len(own) + 1):
                have = shingles(words[at : at + len(own)])
                same = sum(min(want.count(s), have.count(s)) for s in set(want))
                value = same / (2 * len(want) - same)
                if value >= threshold - 1e-12 and (best is None or value > best[0]):
                    best = (value, at)
            if best:
                out.add((doc, item, best[1], len(own), round(best[0], 9)))
    return out


def found_in(frame):
    rows = frame.select("doc_id", F.inline("leaks")).collect()
    return {(r.doc_id, r.item_id, r.start, r.words, round(r.similarity, 9)) for r in rows}


def test_leaks_equal_brute_force(spark, docs):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    prose = lambda n: draw.choices(vocabulary, k=n)
    items = [(i, prose(n)) for i, n in enumerate([15, 15, 30, 47, 60, 5, 4, 1])]
    rows = []
    for doc in range(60):
        words, (_, item) = prose(draw.randint(0, 120)), draw.choice(items)
        item = list(item)
        for _ in range(draw.randint(0, 3)):
            item[draw.randrange(len(item))] = draw.choice(vocabulary)
        at = draw.randint(0, len(words))
        rows.append((doc, " ".join(words[:at] + [w.upper() for w in item] + words[at:])))
    text_items = [(i, " ".join(w) + ".") for i, w in items if len(w) >= 5]
    rows += [(100, None), (101, ""), (102, "..."), (103, text_items[2][1]), (103, text_items[2][1]), (None, text_items[0][1])]
    text_items += [(50, text_items[0][1]), (51, None), (52, ""), (53, "only three words")]
    frame = spark.createDataFrame(text_items, "item_id long, text string")
    got = decontaminate.with_leaks(docs(rows), frame)
    assert found_in(got) == brute(rows, text_items)
    assert got.count() == len(rows)


def test_many_items_take_several_passes(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 100)
    items = [(i, " ".join(f"x{i}y{j}" for j in range(9))) for i in range(9)]
    rows = [(i, "before " + text + " after") for i, text in items]
    got = decontaminate.with_leaks(docs(rows).withColumn("leaks", F.lit(1)), spark.createDataFrame(items, "item_id long, text string"))
    assert found_in(got) == {(i, i, 1, 9, 1.0) for i in range(9)}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.leaks for r in decontaminate.with_leaks(docs([(1, "a b")]), none).collect()] == [[]]
    assert decontaminate.with_leaks(docs([]), none).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius():
    draw = np.random.default_rng(4)
    size = decontaminate.SizeIndex(9, [([i], draw.integers(1, 2**63, 9).astype(np.uint64)) for i in range(50)])
    prints = size.prints.copy()
    for i in range(50):
        for bit in draw.choice(64, decontaminate.RADIUS, replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(bit)
    windows, found = size.candidates(prints)
    assert {(i, i) for i in range(50)} <= set(zip(windows.tolist(), found.tolist()))


def test_words_and_grams_do_not_depend_on_the_slice():
    import pyarrow as pa

    texts = ["a bb  ccc\n", None, "", "\x0bÄ ß", "a bb"]
    words = Words(pa.array(texts))
    assert words.counts().tolist() == [3, 0, 0, 2, 2]
    alone = np.concatenate([Words(pa.array([t], pa.string())).hashes() for t in texts])
    assert (words.hashes() == alone).all() and alone[0] == alone[-2]
    sliced = Words(pa.array(texts).slice(3))
    assert (sliced.hashes() == alone[3:]).all()
    assert grams(alone, 9).tolist() == []


@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_every_template_is_found_whole_and_nearly_whole(name):
    import pyarrow as pa

    index = licenses.LicenseIndex(licenses.TEMPLATES)
    for template in licenses.TEMPLATES[name]:
        words = template.split()
        texts = [f"some words before {template.upper()} and after", template]
        if len(plain(template)) >= 40:
            texts.append(" ".join(["one"] * 37 + words[1:]))
        for own in index.find(pa.array(texts), 0.8):
            assert name in {f["license"] for f in own}


def test_containment_is_exact_and_clean_texts_stay_clean(docs):
    rows = [(1, None), (2, ""), (3, "plain prose about nothing in particular " * 50), (4, "Released under the MIT"), (5, "x " * 100_000 + "All rights reserved."), (6, "Licensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0."), (7, "version 3 of the GNU General Public License")]
    found = licenses.with_licenses(docs(rows).withColumn("licenses", F.lit(0)))
    got = sorted((r.doc_id, [f.license for f in r.licenses]) for r in found.collect())
    assert got == [(1, []), (2, []), (3, []), (4, []), (5, ["Proprietary"]), (6, ["CC-BY-NC-4.0"]), (6, ["CC-BY-NC-4.0"]), (7, [])]
    assert licenses.with_licenses(docs([])).count() == 0


def test_another_version_is_not_listed(docs):
    text = "This work is licensed under the GNU General Public License, version 3."
    rows = licenses.with_licenses(docs([(1, text)])).collect()
    assert [(f.license, f.containment) for f in rows[0].licenses] == [("GPL-3.0", 1.0)]
