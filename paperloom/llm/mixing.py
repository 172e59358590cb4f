"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source is to get words in proportion to its weight, at most ``max_epochs`` times its own
size. Sources above that are clamped and what they cannot take is dealt out again to the others
by weight, until none is above. A source's target is then taken as whole repetitions of all its
documents and one fractional one: documents stand in a seeded random order, and those up to the
place where the fraction is reached are taken once more. The place is found digit by digit, from
sums per leading digits of the documents' random numbers, so no source is ever ordered by a task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.operators.lookup import lookup
from paperloom.session import work_folder

SEED = 20240311
MAX_EPOCHS = 3
#: Bits of a document's random number, and how many of them one descent settles.
DRAW_BITS, DIGIT_BITS = 60, 12
#: Sources a task puts in order at once when they are numbered.
NUMBERED_ROWS = 1_000_000
WORD = "[^ \\t\\n\\x0B\\f\\r]+"
BIG = "decimal(38,0)"


def with_sizes(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = SEED, size: str = "size", draw: str = "draw"
) -> DataFrame:
    """All columns plus the number of words and a random number of ``DRAW_BITS`` bits.

    Words are runs of characters other than ASCII white space; a NULL text has none. The number
    is a hash of the seed, the id and the text: reruns agree, and rows that agree in both are
    treated alike. Input columns with the two names are replaced.
    """
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    number = F.conv(F.substring(F.md5(named), 1, DRAW_BITS // 4), 16, 10).cast("long")
    return docs.withColumns({size: words, draw: number})


def numbered_sources(sources: DataFrame, source: str = "source") -> DataFrame:
    """The distinct sources with their ``rank`` (0, 1, ...) by code point, NULL last.

    Sources are sorted into ranges; a range's first number comes from the counts of those before
    it, so no task orders all of them.
    """
    spark, folder = sources.sparkSession, work_folder(sources.sparkSession, "sources")
    last = F.col(source).isNull()
    ordered = sources.orderBy(last, F.col(source))
    ordered.withColumn("__id", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder).withColumn("__range", F.shiftright("__id", 33))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored.groupBy("__range").agg(F.count("*").alias("__n"))
    # One row per range of the sort.
    starts = ranges.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(starts, "__range").withColumn("rank", F.col("__start") + place).drop("__id", "__range", "__start")


def cyclic_weights(sizes: DataFrame, source: str = "source", cycle: int = 3) -> DataFrame:
    """The sources with weights 1, 2, ... ``cycle``, repeating, by code point, NULL last."""
    return numbered_sources(sizes, source).withColumn("weight", (F.col("rank") % cycle + 1).cast("long")).drop("rank")


def _level(sources: DataFrame, caps: Column, total: int) -> tuple[int, int]:
    """The words per weight of the sources that are not clamped, as a fraction.

    Each round clamps the sources whose cap is below their share and deals what is left out to
    the others; the share only grows, so a clamped source stays clamped. Three sums reach the driver.
    """
    rest, weights = total, int(sources.agg(F.sum(F.col("weight").cast(BIG))).first()[0] or 0)
    while weights:
        share = F.lit(rest).cast(BIG) * F.col("weight")
        clamped = caps * F.lit(weights).cast(BIG) <= share
        sums = sources.agg(
            F.sum(F.when(clamped, caps)).alias("taken"), F.sum(F.when(~clamped, F.col("weight").cast(BIG))).alias("free")
        ).first()
        left = total - int(sums["taken"] or 0), int(sums["free"] or 0)
        if left[1] == 0 or left == (rest, weights):
            return left
        rest, weights = left
    return rest, weights


def water_filled(sources: DataFrame, max_epochs: int = MAX_EPOCHS, total: int | None = None) -> DataFrame:
    """(source columns, source_size, weight) plus ``target``, ``whole`` and ``part``.

    Targets share ``total`` words (default: all sizes) by weight, none above ``max_epochs`` times
    its source's size. ``whole`` is how many times every document is taken, ``part`` how many
    words are to be taken beside. A source without weight gets nothing; when all are clamped the
    targets stay below ``total``. ``sources`` should be a written table, one row per source.
    """
    caps = F.col("source_size").cast(BIG) * max_epochs
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0) if total is None else total
    rest, weights = _level(sources, caps, total)
    share = F.lit(rest).cast(BIG) * F.col("weight")
    clamped = F.lit(True) if not weights else caps * F.lit(weights).cast(BIG) <= share
    exact = share.cast("double") / float(max(weights, 1))
    target = F.when(F.col("weight") <= 0, 0.0).when(clamped, caps.cast("double")).otherwise(exact)
    some = F.col("source_size") > 0
    epochs = F.when(some, F.least(F.floor(target / F.col("source_size")), F.lit(max_epochs))).otherwise(0)
    filled = sources.withColumn("target", target).withColumn("whole", epochs.cast("long"))
    return filled.withColumn("part", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))


def _places(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(__source, cut, edge): draws below ``cut`` are taken, those equal to ``edge`` too.

    ``rows`` is the written (__source, draw, size) table. Each descent sums the sizes by the next
    digit inside the prefix reached so far and steps to the digit in which the wanted part ends.
    The last prefix is one whole draw; it is taken when that brings the sum nearer to the part.
    """
    at = sources.select("__source", F.lit(0).cast("long").alias("prefix"), F.col("part").alias("want"))
    for shift in range(DRAW_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        digit = F.shiftright("draw", shift)
        inside = lookup(rows, at, "__source", how="inner", spread=["draw"])
        inside = inside.where(F.shiftright("draw", shift + DIGIT_BITS) == F.col("prefix"))
        sums = inside.groupBy("__source", digit.alias("digit")).agg(F.sum("size").cast("double").alias("amount"))
        # At most one row per digit of the fan-out and source.
        upto = Window.partitionBy("__source").orderBy("digit")
        run = sums.withColumn("after", F.sum("amount").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        reached = run.join(at.select("__source", "want"), "__source").where(F.col("after") >= F.col("want"))
        first = reached.groupBy("__source").agg(F.min_by(F.struct("digit", "amount", "after", "want"), "digit").alias("r"))
        step = first.select(
            "__source", F.col("r.digit").alias("prefix"),
            (F.col("r.want") - (F.col("r.after") - F.col("r.amount"))).alias("want"), F.col("r.amount").alias("amount"),
        )
        path = work_folder(rows.sparkSession, "mixing_cut")
        step.write.parquet(path)
        at = rows.sparkSession.read.parquet(path)
        if shift:
            at = at.drop("amount")
    return at.select("__source", F.col("prefix").alias("cut"), (F.col("want") * 2 >= F.col("amount")).alias("edge"))


def mix_sources(
    rows: DataFrame,
    weights: DataFrame | None = None,
    source: str = "source",
    size: str = "size",
    draw: str = "draw",
    max_epochs: int = MAX_EPOCHS,
    total: int | None = None,
) -> DataFrame:
    """All columns plus ``source_size``, ``target``, ``repeats`` and ``taken`` (size by repeats).

    ``rows`` has sizes and draws as ``with_sizes`` adds them. ``weights`` is (source, weight) with
    each source once; a source that is not in it gets nothing. Without it the sources weigh
    1, 2, 3, repeating (``cyclic_weights``). NULL is a source of its own. A row is repeated
    ``whole`` times and, by its draw, once more, so never more than ``max_epochs`` times. A
    source misses its target by at most half of the words of the one draw at its cut; rows without words
    are never cut off and no rows give no rows. Input columns with the four names are replaced.

    The rows are written once to the shared folder; what is grouped and joined after that is
    (source, draw, size) and one row per source.
    """
    spark, folder = rows.sparkSession, work_folder(rows.sparkSession, "mixing")
    rows = rows.drop("source_size", "target", "repeats", "taken")
    # NULL gets a name no source has, so that plain joins meet it.
    named = F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))
    rows.withColumn("__source", named).write.parquet(f"{folder}/rows")
    stored = spark.read.parquet(f"{folder}/rows")
    narrow = stored.select("__source", F.col(draw).alias("draw"), F.col(size).alias("size"))
    sums = narrow.groupBy("__source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    bare = F.when(F.col("__source") != "0", F.substr("__source", F.lit(2)))
    sums.withColumn(source, bare).write.parquet(f"{folder}/sizes")
    sizes = spark.read.parquet(f"{folder}/sizes")
    if weights is None:
        weighted = cyclic_weights(sizes, source)
    else:
        given = weights.select(F.col(source).cast("string").alias("__other"), F.col("weight"))
        weighted = sizes.join(given, F.col(source).eqNullSafe(F.col("__other")), "left").drop("__other")
        weighted = weighted.withColumn("weight", F.coalesce("weight", F.lit(0)))
    weighted.select("__source", "source_size", "weight").write.parquet(f"{folder}/weighted")
    filled = water_filled(spark.read.parquet(f"{folder}/weighted"), max_epochs, total)
    filled.write.parquet(f"{folder}/targets")
    targets = spark.read.parquet(f"{folder}/targets")

    cuts = _places(narrow, targets.where("part > 0"))
    bounds = targets.join(cuts, "__source", "left").select(
        "__source", "source_size", "target", F.col("whole").alias("__whole"), F.col("cut").alias("__cut"), F.col("edge").alias("__edge")
    )
    known = lookup(stored, bounds, "__source", spread=[draw])
    more = (F.col(draw) < F.col("__cut")) | (F.col("__edge") & (F.col(draw) == F.col("__cut")))
    repeats = F.col("__whole") + F.coalesce(more.cast("long"), F.lit(0))
    mixed = known.withColumn("repeats", repeats).withColumn("taken", F.col(size) * F.col("repeats"))
    return mixed.drop("__source", "__whole", "__cut", "__edge")


def repeated_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, numbered by ``copy``."""
    some = mixed.drop("copy").where(F.col("repeats") > 0)
    return some.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
