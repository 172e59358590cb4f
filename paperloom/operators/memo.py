"""Country resolutions kept between runs.

A table text -> countries stands beside a copy of the names it was made with. A run resolves only
texts the table does not hold. When the names change, only texts that mention a name that came,
went or got another address are resolved anew; what a text resolves to depends on the names in it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from paperloom.operators.merge import stage
from paperloom.operators.nametrie import find_names
from paperloom.operators.places import Gazetteers, countries_of_texts
from paperloom.session import work_folder

_NAMES = "kind string, name string, address string"
_MEMO = "text string, countries array<string>"


def gazetteer_names(spark: SparkSession, gazetteers: Gazetteers) -> DataFrame:
    """All names of the gazetteers with what they stand for, as one table."""
    countries = list(gazetteers.countries.items())
    rows = spark.createDataFrame(countries or [(None, None)], "name string, address string").where("name IS NOT NULL")
    names = rows.select(F.lit("country").alias("kind"), "name", "address")
    for kind, table, column in (("city", gazetteers.cities, "city"), ("place", gazetteers.places, "place")):
        if table is not None:
            names = names.unionByName(table.select(F.lit(kind).alias("kind"), F.col(column).alias("name"), "address"))
    return names.where("name IS NOT NULL")


def changed_names(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name): those that only one side has, or with another address."""
    gone, come = old.exceptAll(new), new.exceptAll(old)
    return gone.union(come).select("name").distinct()


def _behind(names: DataFrame, changed: DataFrame) -> DataFrame:
    """(name): those whose address mentions a changed name."""
    held = find_names(names.where("kind <> 'country'"), "address", changed, "name").select("address")
    return names.join(held, "address", "left_semi").select("name")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _version(spark: SparkSession, path: str) -> int:
    """The last finished version; -1 before the first one."""
    done = _read(spark, f"{path}/finished", "version int")
    return -1 if done is None else done.agg(F.max("version")).first()[0]


class Resolutions:
    """The kept resolutions below ``path``; each run that changes them writes a new version.

    A version is named as finished after all of it is written, so a run that fails leaves the one
    before. Runs that only add texts append to the version at hand.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def table(self) -> DataFrame:
        """(text, countries) of everything kept."""
        version = _version(self.spark, self.path)
        kept = _read(self.spark, f"{self._folder(version)}/texts", _MEMO) if version >= 0 else None
        # A run that failed after its append and was repeated may have left a text twice, alike.
        empty = self.spark.createDataFrame([], _MEMO)
        return empty if kept is None else kept.groupBy("text").agg(F.first("countries").alias("countries"))

    def resolve(self, texts: DataFrame, text: str, gazetteers: Gazetteers) -> dict[str, int]:
        """Make sure that every distinct text is kept; returns how many were resolved anew, and why.

        ``new`` texts were not kept, ``touched`` ones hold a changed name. NULL texts are left out.
        """
        spark, version = self.spark, _version(self.spark, self.path)
        names = stage(gazetteer_names(spark, gazetteers), work_folder(spark, "names"))
        kept, touched = self.table(), None
        if version >= 0:
            old = _read(spark, f"{self._folder(version)}/names", _NAMES)
            changed = stage(changed_names(old, names), work_folder(spark, "changed"))
            changed = stage(changed.union(_behind(names, changed)).distinct(), work_folder(spark, "changed"))
            if changed.limit(1).count():
                touched = find_names(kept, "text", changed, "name").select("text")
                touched = stage(touched, work_folder(spark, "touched"))
        asked = texts.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
        new = stage(asked.join(kept, "text", "left_anti").select("text"), work_folder(spark, "asked"))
        again = new if touched is None else new.unionByName(touched)
        found = countries_of_texts(again, "text", gazetteers).select("text", "countries")
        if touched is None and version >= 0:
            found.write.mode("append").parquet(f"{self._folder(version)}/texts")
        else:
            if touched is not None:
                found = kept.join(touched, "text", "left_anti").unionByName(found)
            target = self._folder(version + 1)
            found.write.mode("overwrite").parquet(f"{target}/texts")
            names.write.mode("overwrite").parquet(f"{target}/names")
            done = spark.createDataFrame([(version + 1,)], "version int").coalesce(1)
            done.write.mode("append").parquet(f"{self.path}/finished")
        return {"new": new.count(), "touched": 0 if touched is None else touched.count()}

    def countries(self, df: DataFrame, text: str, gazetteers: Gazetteers) -> DataFrame:
        """Add ``countries`` to the rows, resolving only what is not kept yet."""
        self.resolve(df, text, gazetteers)
        known = self.table().withColumnRenamed("text", text)
        unknown = F.array(F.lit(None).cast("string"))
        return df.join(known, text, "left").withColumn("countries", F.coalesce("countries", F.when(F.col(text).isNotNull(), unknown)))
