"""Key ranges and Bloom filters of a table's insert batches, kept as a small table beside it.

A batch's distinct keys are dealt into segments by their hash. Each segment is one row: the
smallest and largest key and a Bloom filter of fixed width. A merge asks which batches may hold
one of its keys and opens only those; the exact join behind it settles the rest.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: Keys meant for one segment, filter bits for each of them, and bits that one key sets.
SEGMENT_KEYS = 4096
BITS_PER_KEY = 24
HASHES = 8
WORDS = SEGMENT_KEYS * BITS_PER_KEY // 64
#: Segments written to one file.
FILE_SEGMENTS = 1024
PART = "batch"


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}.keys"


def _schema(kind: str) -> str:
    return f"key_name string, segments int, segment int, low {kind}, high {kind}, words array<bigint>"


def _number(key: str, seed: int) -> Column:
    """31 bits of a seeded hash of the key."""
    return F.xxhash64(F.lit(seed), F.col(key)).bitwiseAND(F.lit((1 << 31) - 1))


def _spots(key: str) -> Column:
    """The filter bits of a key."""
    first, step = _number(key, 1), _number(key, 2)
    steps = F.sequence(F.lit(0).cast("long"), F.lit(HASHES - 1).cast("long"))
    return F.transform(steps, lambda i: F.pmod(first + i * step, F.lit(64 * WORDS)))


def _segment(key: str, segments: Column) -> Column:
    return F.pmod(_number(key, 3), segments).cast("int")


def segments_for(keys: int) -> int:
    """A power of two, so that few different numbers occur."""
    return 1 << max(0, (keys - 1) // SEGMENT_KEYS).bit_length()


def key_filters(keys: DataFrame, key: str, segments: int | None = None) -> DataFrame:
    """The segments of the keys that are not NULL; those without a key have no range.

    The keys alone are dealt out by segment; their filter bits are made and joined where they land.
    """
    known = keys.select(F.col(key).alias("key")).where("key IS NOT NULL")
    segments = segments or segments_for(known.count())
    placed = known.select(_segment("key", F.lit(segments)).alias("segment"), "key")
    # One row without a key stands for every word of a segment, so that the filters have one width.
    none = F.lit(None).cast(keys.schema[key].dataType).alias("key")
    blank = keys.sparkSession.range(segments).select(F.col("id").cast("int").alias("segment"), none)
    dealt = placed.unionByName(blank).repartition("segment")
    words = F.sequence(F.lit(0).cast("long"), F.lit(64 * (WORDS - 1)).cast("long"), F.lit(64).cast("long"))
    spots = dealt.select("segment", "key", F.explode(F.when(F.col("key").isNull(), words).otherwise(_spots("key"))).alias("spot"))
    bit = F.when(F.col("key").isNull(), F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, cast(spot & 63 as int))"))
    merged = spots.select("segment", "key", F.shiftright("spot", 6).alias("word"), bit.alias("bits")).groupBy("segment", "word").agg(
        F.bit_or("bits").alias("bits"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # A segment's words: a list of fixed length.
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"]
    filters = merged.groupBy("segment").agg(F.min("low").alias("low"), F.max("high").alias("high"), listed.alias("words"))
    return filters.select(F.lit(key).alias("key_name"), F.lit(segments).alias("segments"), "segment", "low", "high", "words")


def _folder(path: str, batch: str) -> str:
    return f"{index_path(path)}/{PART}={batch}"


def open_batch(spark: SparkSession, path: str, batch: str, kind: str) -> None:
    """Enter a batch that may hold any key; written before its data, so no data is ever unlisted."""
    row = [(None, 0, 0, None, None, None)]
    spark.createDataFrame(row, _schema(kind)).coalesce(1).write.mode("overwrite").parquet(_folder(path, batch))


def close_batch(keys: DataFrame, path: str, batch: str, key: str, rows: int | None = None) -> None:
    """Replace a batch's entry by the ranges and filters of its keys, ``rows`` of them at most.

    A batch without keys has segments that no key matches, so it stays listed.
    """
    segments = segments_for(keys.count() if rows is None else rows)
    files = max(1, segments // FILE_SEGMENTS)
    key_filters(keys, key, segments).repartition(files, "segment").write.mode("overwrite").parquet(_folder(path, batch))


def read_index(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """All entries with their ``batch``; None when the table has no index yet."""
    try:
        return spark.read.schema(f"{_schema(kind)}, {PART} string").parquet(index_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def batches_holding(
    keys: DataFrame, index: DataFrame, key: str, small: bool = False, bounds: tuple | None = None
) -> list[str]:
    """Names of the batches that may hold one of the keys; every batch that does is among them.

    Entries outside the keys' range are pruned by the scan. Each key meets the one segment of a
    batch it would lie in; ``small`` keys are broadcast to the entries. ``bounds``, the smallest and
    largest key, are looked for where the caller does not know them. One name per batch that is
    to be opened reaches the driver, as a listing of the table's folders would.
    """
    known = keys.select(key).where(F.col(key).isNotNull())
    low, high = bounds or known.agg(F.min(key), F.max(key)).first()
    other = F.coalesce(F.col("key_name") != key, F.lit(True)) | (F.col("segments") == 0)
    near = ~other & (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    seen = index.where(other if low is None else other | near)
    names, sizes = seen.agg(F.collect_set(F.when(other, F.col(PART))), F.collect_set(F.when(~other, F.col("segments")))).first()
    if low is None or not sizes:
        return sorted(names)
    near, known = index.where(near), known.distinct()
    asked = known.select(
        F.col(key).alias("__key"), _spots(key).alias("__spots"), F.explode(F.array(*[F.lit(s) for s in sizes])).alias("segments"), key
    )
    asked = asked.withColumn("segment", _segment(key, F.col("segments"))).drop(key)
    met = near.join(F.broadcast(asked) if small else asked, ["segments", "segment"])
    held = F.forall("__spots", lambda s: F.getbit(F.get("words", F.shiftright(s, 6).cast("int")), F.pmod(s, F.lit(64)).cast("int")) == 1)
    found = met.where((F.col("__key") >= F.col("low")) & (F.col("__key") <= F.col("high")) & held)
    return sorted({*names, *[r[0] for r in found.select(PART).distinct().collect()]})
