"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Every partition permutes its own rows. How many of them go to which shard is drawn before
anything moves: the matrix of partitions by shards has the partitions' sizes as row sums and
the shards' sizes as column sums, and is distributed as a uniform permutation of all rows would
make it. It is drawn by halving: a set of partitions with its shard counts is split into two
halves, each shard's count for the left half being hypergeometric. Rows are exchanged once and
permuted again inside their shard. Everything is DataFrame functions.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.session import work_folder

SEED = 20240229
#: Rows of a shard that are put in order by one task.
SLOT_ROWS = 1_000_000
#: Halvings after which the sets of partitions are dealt out to all tasks again.
SPREAD_EVERY = 6


def _let(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` with each value computed once."""
    bound = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.get(F.transform(bound, body), F.lit(0))


def _span(low: Column, high: Column) -> Column:
    """The numbers from ``low`` up to but without ``high``; none when there are none."""
    empty = F.array().cast("array<bigint>")
    return F.when(high > low, F.sequence(low, high - 1)).otherwise(empty)


def _pair(first: Column, second: Column, third: Column) -> Column:
    return F.struct(first.alias("w"), second.alias("s"), third.alias("x"))


def hypergeometric(pool: Column, marked: Column, draws: Column, uniform: Column) -> Column:
    """How many of ``draws`` from ``pool`` rows, ``marked`` of them marked, are marked.

    The inverse of the distribution at ``uniform``, with weights built up from the mode by
    their ratios; what lies ten standard deviations off is below the precision of a double.
    """
    none, zero, one = F.lit(None).cast("bigint"), F.lit(0.0), F.lit(1.0)

    def span(v: Column) -> Column:
        share = v["k"] / F.greatest(v["n"], F.lit(1))
        spread = v["d"] * share * (1 - share) * (v["n"] - v["d"]) / F.greatest(v["n"] - 1, F.lit(1))
        reach = F.ceil(10 * F.sqrt(F.greatest(spread, zero))) + 30
        low, high = F.greatest(F.lit(0), v["d"] - (v["n"] - v["k"])), F.least(v["d"], v["k"])
        top = F.floor((v["d"] + 1.0) * (v["k"] + 1.0) / (v["n"] + 2.0))
        mode = F.least(F.greatest(top, low), high).cast("bigint")
        return _let(
            lambda m: _draw(v, m),
            mode=mode,
            low=F.greatest(low, mode - reach).cast("bigint"),
            high=F.least(high, mode + reach).cast("bigint"),
        )

    def _draw(v: Column, m: Column) -> Column:
        def up(i: Column) -> Column:
            return (v["k"] - i).cast("double") * (v["d"] - i) / ((i + 1).cast("double") * (v["n"] - v["k"] - v["d"] + i + 1))

        def down(i: Column) -> Column:
            return i.cast("double") * (v["n"] - v["k"] - v["d"] + i) / ((v["k"] - i + 1).cast("double") * (v["d"] - i + 1))

        rising = _span(m["mode"], m["high"])
        falling = F.reverse(_span(m["low"] + 1, m["mode"] + 1))

        def total(numbers: Column, ratio: Callable[[Column], Column]) -> Column:
            step = lambda a, i: _pair(a["w"] * ratio(i), a["s"] + a["w"] * ratio(i), a["x"])
            return F.aggregate(numbers, _pair(one, zero, none), step)["s"]

        def find(numbers: Column, ratio: Callable[[Column], Column], left: Column, move: int, last: Column) -> Column:
            def step(a: Column, i: Column) -> Column:
                weight = a["w"] * ratio(i)
                hit = a["x"].isNull() & (weight >= a["s"])
                return _pair(weight, F.when(a["x"].isNull(), a["s"] - weight).otherwise(a["s"]), F.when(hit, i + move).otherwise(a["x"]))

            return F.coalesce(F.aggregate(numbers, _pair(one, left, none), step)["x"], last)

        def choose(t: Column) -> Column:
            point = v["u"] * (1 + t["up"] + t["down"])
            above = find(rising, up, point - 1, 1, m["high"])
            below = find(falling, down, point - 1 - t["up"], -1, m["low"])
            return F.when(point < 1, m["mode"]).when(point < 1 + t["up"], above).otherwise(below)

        return _let(choose, up=total(rising, up), down=total(falling, down))

    return _let(span, n=pool, k=marked, d=draws, u=uniform)


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def _left_counts(marked: Column, pool: Column, draws: Column, seed: int, node: Column) -> Column:
    """The shard counts of a random ``draws`` of the ``pool`` rows: one hypergeometric each."""
    start = F.struct(pool.alias("n"), draws.alias("d"), F.array().cast("array<bigint>").alias("out"))

    def step(state: Column, count: Column) -> Column:
        uniform = _uniform(F.lit(seed), node, F.size(state["out"]))
        return _let(
            lambda v: F.struct(
                (state["n"] - count).alias("n"),
                (state["d"] - v["got"]).alias("d"),
                F.concat(state["out"], F.array(v["got"])).alias("out"),
            ),
            got=hypergeometric(state["n"], count, state["d"], uniform),
        )

    return F.aggregate(marked, start, step)["out"]


def communication_matrix(sizes: DataFrame, parts: int, rows: int, shards: int, seed: int) -> DataFrame:
    """(part, counts): for each partition how many of its rows go to each shard.

    ``sizes`` is (part, n). Shard sizes differ by at most one.
    """
    total = F.array(*[F.lit(rows // shards + (s < rows % shards)).cast("bigint") for s in range(shards)])
    listed = F.array_sort(F.collect_list(F.struct("part", "n")))
    sets = sizes.agg(listed.alias("parts")).select("parts", total.alias("counts"), F.lit(1).cast("bigint").alias("node"))
    width = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    amount = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    for depth in range(math.ceil(math.log2(parts)) if parts > 1 else 0):
        if depth and depth % SPREAD_EVERY == 0:
            sets = sets.repartition(width, "node")
        half = F.ceil(F.size("parts") / 2).cast("int")
        left, right = F.slice("parts", F.lit(1), half), F.slice("parts", half + 1, F.size("parts"))
        drawn = _left_counts(F.col("counts"), amount(F.col("parts")), amount(left), seed, F.col("node"))
        halves = _let(
            lambda v: F.array(
                F.struct(v["left"].alias("parts"), v["drawn"].alias("counts"), (v["node"] * 2).alias("node")),
                F.struct(v["right"].alias("parts"), F.zip_with(v["counts"], v["drawn"], lambda a, b: a - b).alias("counts"), (v["node"] * 2 + 1).alias("node")),
            ),
            left=left, right=right, drawn=drawn, counts=F.col("counts"), node=F.col("node"),
        )
        single = F.array(F.struct("parts", "counts", (F.col("node") * 2).alias("node")))
        sets = sets.select(F.inline(F.when(F.size("parts") > 1, halves).otherwise(single)))
    return sets.select(F.get("parts", F.lit(0))["part"].alias("part"), "counts")


def shuffle_to_shards(rows: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """All columns of ``rows`` plus ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in it).

    A uniform shuffle for a given seed: shard sizes differ by at most one and every order is as
    likely as any other, whatever the values; NULLs, empty texts and repeated rows are rows like
    others, and equal rows need not stay together. No rows give no rows. Input columns named
    ``shard`` or ``slot`` are replaced.

    The locally permuted rows are kept as a table in the shared folder, so that counts and
    numbering see one order even when tasks are repeated. Inside a shard rows are numbered in
    random buckets of about ``SLOT_ROWS``, so no task has to order a whole shard.
    """
    spark, folder = rows.sparkSession, work_folder(rows.sparkSession, "shards")
    rows = rows.drop("shard", "slot")
    columns = rows.columns
    # Partition and place inside it, after the partition's rows were put in random order.
    mixed = rows.withColumn("__key", F.xxhash64(F.lit(seed), F.rand(seed))).sortWithinPartitions("__key")
    mixed.withColumn("__id", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    placed = spark.read.parquet(f"{folder}/rows").withColumns(
        {"__part": F.shiftright("__id", 33), "__rank": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = placed.groupBy(F.col("__part").alias("part")).agg(F.count("*").alias("n"))
    parts, count = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    communication_matrix(sizes, parts, count, shards, seed).write.parquet(f"{folder}/matrix")
    matrix = spark.read.parquet(f"{folder}/matrix")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda i: F.aggregate(F.slice("counts", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x),
    )
    bounds = matrix.select(F.col("part").alias("__part"), ends.alias("__ends"))
    shard = F.size(F.filter("__ends", lambda end: end <= F.col("__rank")))
    buckets = max(1, math.ceil(count / shards / SLOT_ROWS))
    draw = F.xxhash64(F.lit(seed + 1), F.col("__id"))
    sent = placed.join(bounds, "__part").withColumns(
        {"shard": shard, "__draw": draw, "__bucket": F.pmod(draw, F.lit(buckets))}
    )
    groups = sent.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    order = Window.partitionBy("shard", "__bucket").orderBy(F.shiftrightunsigned("__draw", 1), "__id")
    numbered = sent.withColumn("__place", F.row_number().over(order)).join(starts, ["shard", "__bucket"])
    slot = F.col("__start") + F.col("__place") - 1
    return numbered.select(*columns, "shard", slot.cast("long").alias("slot"))
