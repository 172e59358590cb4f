"""Corpus-wide line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

Documents come in batches, the largest ids first. A batch's line keys are reduced to one row
each and compared with the runs so far; keys that no run holds (merge anti-join) name their
keeper, the largest id of the batch. The batch then becomes a sorted run of its own, and runs
of one level are compacted into one of the next level as soon as there are ``FAN_OUT`` of them.
"""

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import work_folder

MIN_CHARS = 40
MIN_DOCS = 5
#: Batches of one call; runs of a level that are compacted into one.
BATCHES = 4
FAN_OUT = 2
#: Rows meant for one bucket of a run.
BUCKET_ROWS = 2_000_000
KEY = ["__h1", "__h2"]
ROW = ["__r1", "__r2"]
BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """The lines of a text; a NULL or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def _digest(*columns: Column) -> tuple[Column, Column]:
    """128 bits from two hashes with different seeds."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


class LineRuns:
    """Levelled sorted runs (key, docs, keeper), bucketed tables below one shared folder.

    All runs share their buckets, so a batch is merged with them without moving them.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.levels: list[list[str]] = []
        self.made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.made.append(name)
        return name

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of the batch whose key no run holds."""
        return reduce(lambda rows, run: rows.join(run.select(*KEY), KEY, "left_anti"), self._runs(), batch)

    def add(self, batch: DataFrame) -> None:
        """Add (key, docs, top), one row per key, as a run and compact full levels."""
        staged = self.spark.table(self._write(batch))
        new = self.unseen(staged).select(*KEY, F.col("top").alias("keeper"))
        run = staged.join(new, KEY, "left").select(*KEY, "docs", "keeper")
        self._push(self._write(run), 0)

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == FAN_OUT:
            merged = self._merge([self.spark.table(n) for n in self.levels[level]])
            self.levels[level] = []
            self._push(self._write(merged), level + 1)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        """The runs as one, by merge joins; a key names at most one keeper."""

        def both(left: DataFrame, right: DataFrame) -> DataFrame:
            other = right.select(*KEY, F.col("docs").alias("__docs"), F.col("keeper").alias("__keeper"))
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("__docs", F.lit(0))
            return left.join(other, KEY, "full_outer").select(
                *KEY, docs.alias("docs"), F.coalesce("keeper", "__keeper").alias("keeper")
            )

        return reduce(both, runs)

    def totals(self) -> DataFrame:
        """(key, docs, keeper) over everything added."""
        return self._merge(self._runs())

    def forget(self) -> None:
        """Take the tables' names out of the catalog; their files stay in the shared folder."""
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def repeated_lines(lines: DataFrame, min_docs: int, folder: str, batches: int = BATCHES) -> DataFrame:
    """(key, keeper) of the keys that at least ``min_docs`` documents hold.

    ``lines`` is a stored table with the key and ``__doc``, the document's number.
    """
    spark = lines.sparkSession
    shares = [i / batches for i in range(1, batches)]
    count, cuts = lines.agg(F.count("*"), F.percentile_approx("__doc", shares, 1000)).first()
    cuts = sorted(set(cuts or []))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // BUCKET_ROWS)
    runs = LineRuns(spark, folder, buckets)
    doc = F.col("__doc")
    spans = zip([None, *cuts], [*cuts, None])
    for low, high in reversed(list(spans)):
        batch = lines if low is None else lines.where(doc > low)
        batch = batch if high is None else batch.where(doc <= high)
        keys = batch.groupBy(*KEY).agg(F.count_distinct("__doc").alias("docs"), F.max("__doc").alias("top"))
        runs.add(keys)
    path = f"{folder}/repeated"
    runs.totals().where(F.col("docs") >= min_docs).select(*KEY, "keeper").write.parquet(path)
    runs.forget()
    return spark.read.parquet(path)


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """The documents with repeated lines taken out, plus ``n_lines`` and ``n_dropped``.

    Lines whose key (``line_key``) has at least ``min_chars`` code points and is found in at
    least ``min_docs`` documents stay only in the largest id that holds them, with all their
    places there. A NULL or empty text is one empty line. Rows with one id are one document; a
    NULL id is a document below all others. Repeated rows are treated alike and stay repeated.
    A text without dropped lines is returned as it is, NULL as an empty text. Input columns
    named ``n_lines`` or ``n_dropped`` are replaced, others are kept. Ids are whole numbers; a text
    that is no number is refused. Keys are compared by 128-bit hashes.

    Only key hashes are grouped and joined; whole texts move at most once, when the numbers of
    the dropped lines come back to their rows.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "lines")
    r1, r2 = _digest(F.col(id_column), F.coalesce(F.col(text), F.lit("")))
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63)))
    line = F.posexplode(lines_of(F.col(text))).alias("__place", "__line")
    long_lines = docs.select(doc.alias("__doc"), r1.alias("__r1"), r2.alias("__r2"), line)
    key = line_key(F.col("__line"))
    long_lines = long_lines.where(F.char_length("__line") >= min_chars).withColumn("__key", key)
    h1, h2 = _digest(F.col("__key"))
    keyed = long_lines.where(F.char_length("__key") >= min_chars)
    keyed.select("__doc", *ROW, "__place", h1.alias("__h1"), h2.alias("__h2")).write.parquet(f"{folder}/keys")
    keys = spark.read.parquet(f"{folder}/keys")

    repeated = repeated_lines(keys, min_docs, folder, batches)
    lost = keys.join(repeated, KEY).where("__doc <> keeper")
    places = lost.groupBy(*ROW).agg(F.collect_set("__place").alias("__drop"))

    rows = docs.withColumns({"__r1": r1, "__r2": r2}).join(places, ROW, "left")
    # The lines and the places that stay are made once per row and then looked up.
    lines = lines_of(F.col(text))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop"))
    kept = F.transform(
        F.array(F.struct(lines.alias("all"), stay.alias("stay"))),
        lambda row: F.array_join(F.transform(row["stay"], lambda i: F.get(row["all"], i)), "\n"),
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    return rows.withColumns(
        {
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
            text: F.when(F.col("__drop").isNull(), whole).otherwise(F.get(kept, F.lit(0))),
        }
    ).drop("__drop", *ROW)
