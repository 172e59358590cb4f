"""Conversation structure repair with Four-Russians block tables.

Turns are marked blank, duplicate or truncated, and the cheapest edits (keep, change the role,
delete, insert) are found that leave a row of turns reading ``(s?(ua)+)?``. Costs are carried from
the end to the front as normalised vectors, a block of turns per table look-up (``blocktables``);
blocks are then expanded backward and the edits chosen front to back, so that among the cheapest
the ASCII-least ones come out.

Only symbols are put in order, equal turns as one row with a count. The ordered rows are worked on
in chunks of bounded size, whatever conversations they belong to. A conversation cut by the edge
of a chunk is summarised by one small cost matrix per chunk; these are combined, and each chunk
is then traced from every state it may begin in.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm import blocktables
from paperloom.llm.blocktables import BLOCK, END, FAR, MUST_GO, STATES, TAILS
from paperloom.session import work_folder

#: Ordered rows of a chunk, as a power of two.
CHUNK_BITS = 13
SOLID = "[^ \\t\\n\\x0B\\f\\r]"
INITIALS = "sua"
#: Pairs of kinds that may stand side by side: system-user, user-assistant, assistant-user.
GOOD_PAIRS = {(0, 1), (1, 2), (2, 1)}
_PLACED = "__conv string, __chunk long, __id long, variant int, before string, deleted long, after string, said string, cost long, illegal long, exits array<int>"
#: Columns of the ordered rows that go through to the edited ones.
_OWN = ["__turn", "__role", "__d1", "__d2", "n", "blank", "first", "truncated"]


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows as a faulty export would have them, by the CRC-32 of ``conv:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 gives it the role
    user. NULL counts as one space in the key, the role and the text. Other columns stay.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn)])
    draw = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    said = F.coalesce(F.col(text), space)
    known = rows.withColumn("__draw", draw).where("__draw <> 0")
    known = known.withColumns(
        {
            role: F.when(F.col("__draw") == 4, "user").otherwise(F.coalesce(F.col(role), space)),
            text: F.when(F.col("__draw") == 1, "").when(F.col("__draw") == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said),
            "__times": F.when(F.col("__draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))),
        }
    )
    return known.withColumn("__times", F.explode("__times")).drop("__draw", "__times")


def _named(conv: str) -> Column:
    """The conversation as a text that is never NULL."""
    return F.when(F.col(conv).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(conv).cast("string")))


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows' own columns with the role and text made whole and a digest of both."""
    both = [F.coalesce(F.col(role), F.lit("")).alias("__role"), F.coalesce(F.col(text), F.lit("")).alias("__text")]
    named = rows.select(_named(conv).alias("__conv"), F.col(turn).alias("__turn"), *both)
    size = F.char_length("__role")
    return named.withColumns(
        {"__d1": F.xxhash64("__role", "__text", size), "__d2": F.xxhash64(F.lit("second"), size, "__text", "__role")}
    )


def _ordered(turns: DataFrame, folder: str) -> DataFrame:
    """Equal turns as one row, numbered by conversation and turn (NULL first), role and digest."""
    spark, initial = turns.sparkSession, F.substring("__role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    last = F.substring(F.regexp_replace("__text", "[ \\t\\n\\x0B\\f\\r]+\\z", ""), -1, 1)
    marks = {
        "kind": kind,
        "blank": ~F.col("__text").rlike(SOLID),
        "truncated": ~last.isin(".", "!", "?"),
    }
    keys = ["__conv", "__turn", "__role", "__d1", "__d2", *marks]
    turns.withColumns(marks).groupBy(*keys).agg(F.count("*").alias("n")).write.parquet(f"{folder}/turns")
    stored = spark.read.parquet(f"{folder}/turns")
    # The first turn that holds a role and text; NULL turns come before others.
    rank = F.struct(F.col("__turn").isNotNull(), F.col("__turn"))
    firsts = stored.groupBy("__conv", "__d1", "__d2").agg(F.min(rank).alias("least"))
    first = F.col("__turn").eqNullSafe(F.col("least")["__turn"])
    marked = stored.join(firsts, ["__conv", "__d1", "__d2"]).withColumn("first", first).drop("least")
    order = ["__conv", F.col("__turn").asc_nulls_first(), "__role", "__d1", "__d2"]
    marked.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()).write.parquet(f"{folder}/ordered")
    return spark.read.parquet(f"{folder}/ordered").withColumn("__chunk", F.shiftright("__id", CHUNK_BITS))


class _Chunk:
    """Ordered rows of some conversations as steps: a turn with its symbol, then its copies that must go."""

    def __init__(self, table: pa.Table):
        self.table = table = table.sort_by("__id")
        self.conv, self.ids = table.column("__conv").combine_chunks(), table.column("__id").to_numpy()
        code = pc.dictionary_encode(self.conv).indices.to_numpy()
        self.first_row = np.flatnonzero(np.diff(code, prepend=-1))
        self.rows = np.diff(self.first_row, append=len(code))
        self.kind, self.n = (table.column(c).to_numpy() for c in ("kind", "n"))
        real = table.column("first").to_numpy() & ~table.column("blank").to_numpy()
        truncated = table.column("truncated").to_numpy()
        gone = self.n - real
        # At most two steps a row; a step for copies stands for ``gone`` of them.
        is_step = np.stack([real, gone > 0], axis=1).reshape(-1)
        symbol = np.stack([2 * self.kind + truncated, np.full(len(code), MUST_GO)], axis=1).reshape(-1)
        times = np.stack([np.ones(len(code), dtype=np.int64), gone], axis=1).reshape(-1)
        self.symbols, self.times = symbol[is_step].astype(np.int64), times[is_step]
        self.row = np.repeat(np.arange(len(code)), 2)[is_step]
        self.starts = np.searchsorted(self.row, self.first_row)
        self.lengths = np.diff(self.starts, append=len(self.row))

    def names(self) -> list[str]:
        return self.conv.take(pa.array(self.first_row)).to_pylist()


def _matrices(own: pa.Table) -> pa.Table:
    """What each run of a cut conversation costs from each state to each state, and its edge kinds."""
    chunk, t = _Chunk(own), blocktables.tables()
    out = []
    for goal in range(STATES):
        last = np.full(len(chunk.starts), 1 + goal)
        _, vector, paid = blocktables.right_vectors(chunk.symbols, chunk.starts, chunk.lengths, last)
        out.append(np.where(t.values[vector] >= FAR, FAR, t.values[vector] + paid[:, None]))
    costs = np.stack(out, axis=2).reshape(len(chunk.starts), -1)
    ends = chunk.first_row + chunk.rows - 1
    return pa.table(
        {
            "__conv": pa.array(chunk.names()),
            "__chunk": pa.array(np.full(len(costs), own.column("__chunk")[0].as_py()), pa.int64()),
            "costs": pa.array(costs.tolist(), pa.list_(pa.int32())),
            "opens": pa.array(chunk.kind[chunk.first_row], pa.int32()),
            "closes": pa.array(chunk.kind[ends], pa.int32()),
        }
    )


def _edges(runs: pa.Table) -> pa.Table:
    """For each run of one cut conversation the vector after it, and what stands before and after it."""
    runs, t = runs.sort_by("__chunk"), blocktables.tables()
    costs = np.array(runs.column("costs").to_pylist(), dtype=np.int64).reshape(-1, STATES, STATES)
    vector, right = np.array(END, dtype=np.int64), []
    for matrix in costs[::-1]:
        right.append(t.number[tuple(int(v) if v < FAR else FAR for v in vector)])
        vector = np.minimum((matrix + vector).min(axis=1), FAR)
        vector = np.where(vector >= FAR, FAR, vector - vector.min())
    count = runs.num_rows
    closes = runs.column("closes").to_pylist()
    return pa.table(
        {
            "__conv": runs.column("__conv"),
            "__chunk": runs.column("__chunk"),
            "right": pa.array(right[::-1], pa.int32()),
            "closed": pa.array([-1, *closes[:-1]], pa.int32()),
            "last": pa.array([False] * (count - 1) + [True]),
        }
    )


def _placed(own: pa.Table, edges: pa.Table) -> pa.Table:
    """The edits of each row of a chunk; for a run that begins inside a conversation, from every state."""
    chunk, t = _Chunk(own), blocktables.tables()
    names, count = chunk.names(), len(chunk.starts)
    known = {r["__conv"]: r for r in edges.to_pylist()}
    cut = [known.get(name) for name in names]
    last = np.array([e["right"] if e else 0 for e in cut])
    final = np.array([e is None or e["last"] for e in cut])
    closed = np.array([e["closed"] if e else -1 for e in cut])
    after, _, _ = blocktables.right_vectors(chunk.symbols, chunk.starts, chunk.lengths, last)
    kinds = chunk.kind
    # Pairs of neighbours: copies of a turn beside each other, and each row with the one before.
    before_kind = np.concatenate(([-1], kinds[:-1])) if len(kinds) else kinds
    before_kind[chunk.first_row] = closed
    fine = np.zeros((5, 4), dtype=bool)
    fine[-1] = True
    for a, b in GOOD_PAIRS:
        fine[a, b] = True
    illegal = (chunk.n - 1) + ~fine[before_kind, kinds]
    parts, exits = [], np.zeros((count, STATES), dtype=np.int64)
    for state in range(STATES):
        runs = np.flatnonzero((closed >= 0) | (state == 0))
        if not len(runs):
            continue
        begin = np.full(len(runs), state)
        states, end = blocktables.trace(chunk.symbols, after, chunk.starts[runs], chunk.lengths[runs], begin)
        exits[runs, state] = end
        parts.append(_edits(chunk, states, after, runs, end, final[runs], closed[runs] >= 0, state, illegal))
    if (cut_runs := [i for i in range(count) if cut[i]]):
        parts.append(_summary(names, exits, cut_runs, chunk.table.schema))
    table = pa.concat_tables(parts)
    number = pa.array(np.full(table.num_rows, own.column("__chunk")[0].as_py()), pa.int64())
    return table.add_column(1, "__chunk", number)


def _edits(chunk: _Chunk, states, after, runs, end, final, inside, state, illegal) -> pa.Table:
    """One row per ordered row of the runs: its edits with the deletions of its copies counted."""
    t = blocktables.tables()
    take = np.zeros(len(chunk.ids), dtype=bool)
    owner = np.repeat(np.arange(len(chunk.rows)), chunk.rows)
    chosen = np.zeros(len(chunk.rows), dtype=bool)
    chosen[runs] = True
    take = chosen[owner]
    key = (after, chunk.symbols, states)
    edits, said, cost = t.edits[key], t.said[key], t.cost[key]
    more = chunk.times - 1
    before, tail = np.full(len(chunk.ids), "", dtype=object), np.full(len(chunk.ids), "", dtype=object)
    words, deleted = np.full(len(chunk.ids), "", dtype=object), np.zeros(len(chunk.ids), dtype=np.int64)
    paid = np.zeros(len(chunk.ids), dtype=np.int64)
    real = chunk.symbols != MUST_GO
    at = chunk.row
    before[at[real]], words[at[real]] = edits[real], said[real]
    # Copies are deleted one after the other; what else is done there comes with the last one.
    tail[at[~real]], deleted[at[~real]] = edits[~real], more[~real]
    words[at[~real]] = words[at[~real]] + said[~real]
    np.add.at(paid, at, cost + blocktables.DELETE * more)
    ends = (chunk.first_row + chunk.rows - 1)[runs]
    for row, s, done in zip(ends.tolist(), end.tolist(), final.tolist()):
        if done and TAILS[s][0]:
            tail[row], words[row] = tail[row] + TAILS[s][0], words[row] + TAILS[s][1]
            paid[row] += END[s]
    variant = np.full(len(chunk.ids), -1)
    held = np.zeros(len(chunk.rows), dtype=bool)
    held[runs[inside]] = True
    variant[held[owner]] = state
    columns = {
        "__conv": chunk.conv.filter(pa.array(take)),
        "__id": pa.array(chunk.ids[take]),
        "variant": pa.array(variant[take], pa.int32()),
        "before": pa.array(before[take].tolist(), pa.string()),
        "deleted": pa.array(deleted[take]),
        "after": pa.array(tail[take].tolist(), pa.string()),
        "said": pa.array(words[take].tolist(), pa.string()),
        "cost": pa.array(paid[take]),
        "illegal": pa.array(illegal[take].astype(np.int64)),
    }
    columns["exits"] = pa.nulls(int(take.sum()), pa.list_(pa.int32()))
    own = chunk.table.select(_OWN).filter(pa.array(take))
    return pa.table(columns | {name: own.column(name) for name in _OWN})


def _summary(names: list[str], exits: np.ndarray, runs: list[int], schema: pa.Schema) -> pa.Table:
    """For each cut run the state it ends in, by the state it begins in."""
    empty = {"__id": pa.int64(), "variant": pa.int32(), "before": pa.string(), "deleted": pa.int64(), "after": pa.string(), "said": pa.string(), "cost": pa.int64(), "illegal": pa.int64()}
    columns = {"__conv": pa.array([names[i] for i in runs]), **{n: pa.nulls(len(runs), kind) for n, kind in empty.items()}}
    columns["exits"] = pa.array(exits[runs].tolist(), pa.list_(pa.int32()))
    return pa.table(columns | {name: pa.nulls(len(runs), schema.field(name).type) for name in _OWN})


def _entries(runs: pa.Table) -> pa.Table:
    """The state in which each run of one cut conversation begins; the first one has no choice."""
    runs, state, variant = runs.sort_by("__chunk"), 0, []
    for place, exits in enumerate(runs.column("exits").to_pylist()):
        variant.append(state if place else -1)
        state = exits[state]
    return pa.table({"__conv": runs.column("__conv"), "__chunk": runs.column("__chunk"), "variant": pa.array(variant, pa.int32())})


def _edited(ordered: DataFrame, folder: str) -> DataFrame:
    """Each ordered row's own columns with before, deleted, after, said, cost and illegal."""
    spark = ordered.sparkSession
    symbols = ordered.select("__conv", "__chunk", "__id", "kind", "blank", "truncated", "first", "n")
    kinds = dict(ordered.dtypes)
    schema = ", ".join([_PLACED, *[f"{name} {kinds[name]}" for name in _OWN]])
    spans = ordered.groupBy("__conv").agg(F.min("__chunk").alias("a"), F.max("__chunk").alias("b"))
    cut = spans.where("a < b").select("__conv")
    pieces = symbols.join(cut, "__conv", "left_semi").groupBy("__chunk")
    matrices = pieces.applyInArrow(_matrices, "__conv string, __chunk long, costs array<int>, opens int, closes int")
    edges = matrices.groupBy("__conv").applyInArrow(_edges, "__conv string, __chunk long, right int, closed int, last boolean")
    edges.write.parquet(f"{folder}/edges")
    edges = spark.read.parquet(f"{folder}/edges")
    rows = ordered.select("__conv", "__chunk", "__id", "kind", *_OWN)
    placed = rows.groupBy("__chunk").cogroup(edges.groupBy("__chunk")).applyInArrow(_placed, schema)
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    runs = placed.where("__id IS NULL").select("__conv", "__chunk", "exits")
    entries = runs.groupBy("__conv").applyInArrow(_entries, "__conv string, __chunk long, variant int")
    rows = placed.where("__id IS NOT NULL")
    right = rows.where("variant >= 0").join(entries, ["__conv", "__chunk", "variant"], "left_semi")
    return rows.where("variant < 0").unionByName(right).drop("__chunk", "variant", "exits")


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and its repaired turns.

    (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, turns), where ``turns`` is an
    array of (role, text). Rows stand by turn, NULL first, those of one turn by role and a hash
    of role and text, so repeated rows stand together. NULL is a conversation of its own; a NULL
    role or text counts as empty, and a role only by its first letter. A row's first fault counts:
    blank, duplicate (role and text seen earlier), truncated (does not end in ``.!?``). Blank and
    duplicate rows must go. Keep costs 0, a changed role 1, a deletion 2, an inserted empty turn 5
    and a truncated turn that stays 5 more. ``audit`` has the edits' initials K, R, D and I, the
    ASCII-least of the cheapest. No rows give no rows; further columns are not in the result.
    Texts are told apart by 128-bit hashes.

    The ordering, the faults and the edits work on bounded chunks of narrow rows. Texts move only
    when they stay, and a conversation is put together at the end, in one cell as its result is.
    """
    folder = work_folder(rows.sparkSession, "conversations")
    turns = _turns(rows, conv, turn, role, text)
    ordered = _ordered(turns, folder)
    edits = _edited(ordered, folder)
    n, blank, first = F.col("n"), F.col("blank"), F.col("first")
    faults = edits.withColumns(
        {
            "blank": F.when(blank, n).otherwise(0),
            "duplicate": F.when(~blank, n - first.cast("long")).otherwise(0),
            "truncated": (~blank & first & F.col("truncated")).cast("long"),
            "keeps": F.col("said").rlike("[kUA]"),
            "edits": F.concat("before", F.repeat(F.lit("D"), F.col("deleted").cast("int")), "after"),
        }
    )
    texts = turns.groupBy("__conv", "__d1", "__d2").agg(F.max("__text").alias("__text"))
    faults = faults.withColumn("__keep", F.when(F.col("keeps"), F.col("__d1")))
    whole = faults.join(
        texts.withColumnRenamed("__d1", "__keep"), ["__conv", "__keep", "__d2"], "left"
    )

    def one(letter: Column) -> Column:
        said = F.when(F.lower(letter) == letter, F.lit("")).otherwise(F.col("__text"))
        named = F.when(F.lower(letter) == "u", "user").when(F.lower(letter) == "a", "assistant")
        kept = letter == "k"
        return F.struct(
            F.when(kept, F.col("__role")).otherwise(named).alias("role"),
            F.when(kept, F.col("__text")).otherwise(said).alias("text"),
        )

    letters = F.filter(F.split("said", ""), lambda x: x != "")
    piece = F.struct("__id", "edits", F.transform(letters, one).alias("turns"))
    listed = whole.withColumn("piece", piece).groupBy("__conv").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_sort(F.collect_list("piece")).alias("pieces"),
        (F.max("__turn") - F.min("__turn") + 1 - F.count_distinct("__turn")).alias("gaps"),
    )
    kind = rows.schema[conv].dataType
    bare = F.when(F.col("__conv") != "0", F.substr("__conv", F.lit(2))).cast(kind)
    return listed.select(
        bare.alias(conv),
        F.coalesce(F.col("gaps"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join(F.transform("pieces", lambda p: p["edits"]), "").alias("audit"),
        F.flatten(F.transform("pieces", lambda p: p["turns"])).alias("turns"),
    )
