"""Staging, insert-only merge and the main table's layout."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from paperloom import schemas
from paperloom.functions.text import render_list
from paperloom.operators import keyindex
from paperloom.operators.lookup import BROADCAST_BYTES, attach

PART = "batch"
# Room for one key of an id type in a broadcast table.
KEY_BYTES = 48
#: How staged and landed rows are compressed.
STAGED = "zstd"


def stage(df: DataFrame, path: str, schema: str | None = None) -> DataFrame:
    """Replace the staging table with this batch and read it back.

    With ``schema`` the batch must have exactly those columns and types. Staged rows are read
    once or twice and kept for that, so they are packed more tightly than a table for readers.
    """
    if schema is not None:
        expected = T.StructType.fromDDL(schema)
        if [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in expected]:
            raise ValueError(f"batch schema differs: {df.schema.simpleString()}")
    df.write.mode("overwrite").option("compression", STAGED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_new(
    source: DataFrame,
    target: DataFrame,
    key: str = "pmid",
    dedupe_by: Sequence[str] | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Source rows whose key is not in the target; nothing is updated or deleted.

    Repeats inside the source are all kept unless ``dedupe_by`` names columns, of which
    the largest picks one row per key. A NULL key matches nothing and is kept.

    The target's keys are first reduced to those in the source; the second join then
    meets few keys. When the caller counted the batch, ``batch_rows``, and its keys are
    small, they are broadcast: the table's key column is scanned but never shuffled.
    """
    batch_keys = source.select(key).where(F.col(key).isNotNull()).distinct()
    if batch_rows is not None and batch_rows * KEY_BYTES <= BROADCAST_BYTES:
        batch_keys = F.broadcast(batch_keys)
    if dedupe_by is not None:
        source = newest_per_key(source, key, dedupe_by)
    seen = target.select(key).join(batch_keys, key, "left_semi").distinct()
    return attach(source, seen, key, "left_anti").select(source.columns)


def newest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the largest by ``order``; ties go to the larger row. NULL keys stay.

    The aggregate merges, so a key with very many rows is reduced in the map tasks.
    """
    order_columns = [F.col(c) for c in order]
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*order_columns, F.xxhash64(row))
    known = df.where(F.col(key).isNotNull())
    picked = known.groupBy(key).agg(F.max_by(row, rank).alias("__row")).select("__row.*")
    return picked.unionByName(df.where(F.col(key).isNull()))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path`` with each row's ``batch``, or an empty one when it does not exist yet.

    A table is a root with one ``batch=...`` folder per insert. Data files of another layout
    below the root would hide rows from readers and are refused.
    """
    try:
        found = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(path)
        stray = [f for f in found.inputFiles() if f"/{PART}=" not in f.replace("%3D", "=")]
        if stray:
            raise ValueError(f"{path} holds data outside its {PART} folders, such as {stray[0]}")
        return spark.read.schema(f"{schema}, {PART} string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], f"{schema}, {PART} string")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one when it does not exist yet."""
    return read_batches(spark, path, schema).drop(PART)


def _indexed(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame | None:
    """The table's key index; None for a new table.

    A table from before it had an index gets one entry per batch that may hold any key, so its
    batches are opened by every merge until ``index_batches`` has read them.
    """
    index = keyindex.read_index(spark, path, kind)
    if index is None:
        for row in read_batches(spark, path, schema).select(PART).distinct().collect():
            keyindex.open_batch(spark, path, row[0], kind)
        index = keyindex.read_index(spark, path, kind)
    return index


def index_batches(spark: SparkSession, path: str, schema: str, key: str = "pmid") -> None:
    """Read the keys of all batches once and enter their ranges and filters."""
    rows = read_batches(spark, path, schema)
    for row in rows.select(PART).distinct().collect():
        keyindex.close_batch(rows.where(F.col(PART) == row[0]), path, row[0], key)


def may_hold(
    keys: DataFrame, path: str, schema: str, key: str, batch: str, batch_rows: int | None, bounds: tuple | None = None
) -> tuple[DataFrame, list[str]]:
    """The table's rows in the batches that may hold one of the keys, and these batches' names.

    ``batch`` itself is left out. Other batches are neither listed nor opened.
    """
    spark, kind = keys.sparkSession, keys.schema[key].dataType.simpleString()
    index = _indexed(spark, path, schema, kind)
    small = batch_rows is not None and batch_rows * KEY_BYTES <= BROADCAST_BYTES
    names = [] if index is None else keyindex.batches_holding(keys, index.where(F.col(PART) != batch), key, small, bounds)
    root = path.rstrip("/")
    folders = [f"{root}/{PART}={name}" for name in names]
    try:
        found = spark.read.schema(f"{schema}, {PART} string").option("basePath", root).parquet(*folders) if folders else None
    except AnalysisException as error:
        # A batch that was entered and never written.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = read_batches(spark, path, schema).where(F.col(PART).isin(names))
    if found is None:
        found = spark.createDataFrame([], f"{schema}, {PART} string")
    return found, names


def write_batch(
    rows: DataFrame,
    path: str,
    schema: str,
    batch: str,
    key: str = "pmid",
    dedupe_by: Sequence[str] | None = None,
) -> list[str]:
    """Insert-only merge of ``rows`` as the folder ``batch`` of the table at ``path``.

    The batch owns its folder and replaces it; what it wrote before is not counted as seen, so
    a repeated batch writes the same rows once more. ``rows`` is read more than once and should
    be staged. Assumes a single writer, as plain Parquet has no transactions.

    Only the batches whose key ranges and filters admit one of the new keys are opened; their
    names are returned. The batch is entered as one that may hold any key before its data are
    written, and with its own filters after that, so a run that fails in between loses nothing.
    """
    rows = rows.select(*T.StructType.fromDDL(schema).fieldNames())
    spark = rows.sparkSession
    counted, low, high = rows.agg(F.count("*"), F.min(key), F.max(key)).first()
    counted = counted if _fixed_width(rows, key) else None
    others, opened = may_hold(rows.select(key), path, schema, key, batch, counted, (low, high))
    if opened:
        fresh = insert_new(rows, others, key, dedupe_by, counted)
    else:
        # No batch holds any of the keys, so no row has to be moved to be compared.
        fresh = rows if dedupe_by is None else newest_per_key(rows, key, dedupe_by).select(rows.columns)
    folder = f"{path.rstrip('/')}/{PART}={batch}"
    keyindex.open_batch(spark, path, batch, rows.schema[key].dataType.simpleString())
    written = Observation()
    fresh.observe(written, F.count("*").alias("rows")).write.mode("overwrite").parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder).select(key)
    keyindex.close_batch(stored, path, batch, key, written.get["rows"])
    return opened


def _fixed_width(source: DataFrame, key: str) -> bool:
    return isinstance(source.schema[key].dataType, (T.IntegralType, T.DateType))


def countable(source: DataFrame, key: str) -> int | None:
    """Rows of a written batch, or None when its keys have no bounded width."""
    return source.count() if _fixed_width(source, key) else None


def append_new(
    source: DataFrame,
    path: str,
    schema: str,
    key: str = "pmid",
    dedupe_by: Sequence[str] | None = None,
    batch: str | None = None,
) -> str:
    """Insert-only merge into the table at ``path``; returns the batch's name when it is written.

    Streaming runs and such batches share one layout and see each other's rows. With the
    ``batch`` named by an earlier call that call is repeated.
    """
    batch = batch or uuid.uuid4().hex
    write_batch(source, path, schema, batch, key, dedupe_by)
    return batch


def to_main_layout(df: DataFrame) -> DataFrame:
    """The main table's 84 columns in order and type; anything else is dropped."""
    kinds = dict(df.dtypes)

    def column(name: str, kind: str):
        value = F.col(name)
        if kind == "string" and kinds[name].startswith("array"):
            value = render_list(value)
        return value.cast(kind).alias(name)

    return df.select(*[column(name, kind) for name, kind in schemas.MAIN_TYPES.items()])
