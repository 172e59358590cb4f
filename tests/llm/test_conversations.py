import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import blocktables, conversations
from paperloom.llm.queries import op13_block_table_repair

FIELDS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(symbols):
    """(cost, audit, said) of the cheapest edits, ties ASCII-least, by plain recursion over rows and states."""
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i, state, inserted):
        options = []
        if i == len(symbols) and state in ("", "a"):
            options.append((0, "", ""))
        if inserted < 3:
            for role in "ua":
                if (state, role) in follows:
                    cost, audit, said = best(i, role, inserted + 1)
                    options.append((5 + cost, "I" + audit, role + said))
        if i < len(symbols):
            kind, truncated, must_go = symbols[i]
            cost, audit, said = best(i + 1, state, 0)
            options.append((2 + cost, "D" + audit, said))
            if not must_go:
                extra = 5 * truncated
                if (state, kind) in follows:
                    cost, audit, said = best(i + 1, kind, 0)
                    options.append((extra + cost, "K" + audit, "k" + said))
                for role in "ua":
                    if (state, role) in follows:
                        cost, audit, said = best(i + 1, role, 0)
                        options.append((1 + extra + cost, "R" + audit, role.upper() + said))
        return min(options, default=(10**9, "", ""))

    return best(0, "", 0)


def brute(rows, by_turn):
    """The contract's columns per conversation, from damaged (conv, turn, role, text) rows."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = {}
    for conv, own in groups.items():
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, *by_turn(r)))
        seen, symbols, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in own:
            bare = text.strip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
        cost, audit, said = cheapest(tuple(symbols))
        left, place, repaired = iter(own), 0, []
        words = iter(said)
        for edit in audit:
            row = next(left) if edit != "I" else None
            if edit == "D":
                continue
            word = next(words)
            role = row[2] if word == "k" else {"u": "user", "a": "assistant"}[word.lower()]
            repaired.append(f"{role}:{row[3] if row else ''}")
        kinds = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def answers(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r[n] for n in names) for r in frame.collect()}


def repaired(frame):
    found = conversations.repair_conversations(frame)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return answers(found.withColumn("repaired_sha256", F.sha2(F.array_join(said, "\n"), 256)))


def random_rows(count, longest, seed):
    draw, rows = random.Random(seed), []
    texts = ["Hi.", "Yes!", "no", "", " \t", "Really?", "cut off", "More. "]
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            rows.append((conv, 3 * turn if turn % 4 else turn, role, f"{draw.choice(texts)}" if draw.random() < 0.5 else f"Text {draw.random()}{draw.choice('.!?x')}"))
    return rows


def one_per_turn(rows):
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(damaged(rows), lambda r: ())
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert answers(op13_block_table_repair(spark, folder)) == {c: want.get(c, empty) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("bits", [13, 2, 0])
def test_chunks_of_any_size_give_the_same(spark, monkeypatch, bits):
    """Conversations cut by the edges of chunks, down to one row a chunk."""
    monkeypatch.setattr(conversations, "CHUNK_BITS", bits)
    rows = one_per_turn(random_rows(25, 14, 3) + [(99, t, "user" if t % 3 else "assistant", f"t{t % 50}.") for t in range(120)])
    frame = spark.createDataFrame(rows, FIELDS).repartition(4)
    assert repaired(frame) == brute(rows, lambda r: ())


def test_damage_follows_the_hash(spark):
    rows = random_rows(60, 8, 4) + [(None, 1, "user", "A."), (7, None, None, "B."), (None, None, "user", None)]
    frame = conversations.damage(spark.createDataFrame(rows, FIELDS).withColumn("more", F.lit(1)))
    assert sorted((tuple(r)[:4] for r in frame.collect()), key=str) == sorted(damaged(rows), key=str)


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    rows = [
        (None, None, "user", "A."), (None, None, "user", "A."), (None, 1, "assistant", "B."), (None, None, None, None),
        (1, 5, "user", "x" * 300_000 + "."), (1, 5, "user", "x" * 300_000 + "."), (1, 9, "assistant", "y." * 100_000),
        (2, None, None, None), (3, 1, "user", "A"), (4, 1, "system", "S."),
    ]
    frame = spark.createDataFrame(rows, FIELDS)
    for name in ("kind", "n", "first", "blank", "said", "cost", "audit", "turns", "text2"):
        frame = frame.withColumn(name, F.lit("clash"))
    whole = [(c, t, r or "", x or "") for c, t, r, x in rows]
    # Rows of one turn stand by role; equal ones beside each other.
    assert repaired(frame) == brute(whole, lambda r: (r[2], r[3]))
    assert conversations.repair_conversations(frame.limit(0)).count() == 0


def test_many_equal_rows_are_counted_not_listed(spark):
    frame = spark.range(5000).select(F.lit(1).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    found = conversations.repair_conversations(frame).first()
    assert (found.duplicate, found.illegal, found.cost) == (4999, 4999, 4999 * 2 + 2)
    assert found.audit == "D" * 5000 and found.turns == []


def test_block_tables_agree_with_single_steps():
    t, draw = blocktables.tables(), np.random.default_rng(2)
    for _ in range(200):
        symbols = draw.integers(0, blocktables.SYMBOLS, blocktables.BLOCK)
        start = int(draw.integers(0, len(t.vectors)))
        vector, paid = start, 0
        for symbol in symbols[::-1]:
            paid += t.offset[vector, symbol]
            vector = t.step[vector, symbol]
        code = int("".join(map(str, symbols)), blocktables.SYMBOLS)
        assert (t.block[start, code], t.paid[start, code]) == (vector, paid)


def test_every_short_row_of_symbols():
    """All rows of up to three turns against the recursion, edits and costs."""
    t = blocktables.tables()
    kinds = [("s", 0), ("s", 1), ("u", 0), ("u", 1), ("a", 0), ("a", 1), ("t", 0), ("t", 1), ("u", 2)]
    for size in (1, 2, 3):
        for code in range(blocktables.SYMBOLS**size):
            symbols = np.array([code // blocktables.SYMBOLS**i % blocktables.SYMBOLS for i in range(size)])
            starts, lengths = np.array([0]), np.array([size])
            after, vector, paid = blocktables.right_vectors(symbols, starts, lengths, np.array([0]))
            states, end = blocktables.trace(symbols, after, starts, lengths, np.array([0]))
            audit = "".join(t.edits[after, symbols, states]) + blocktables.TAILS[end[0]][0]
            want = cheapest(tuple((k, flag == 1, flag == 2) for k, flag in (kinds[s] for s in symbols)))
            assert (paid[0] + t.values[vector[0], 0], audit) == want[:2]
