"""Session settings and the shared working folder."""

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", app: str = "paperloom", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Where that setting is absent the folder lies below the warehouse, which all executors
    share as well; a machine's own temporary folder is never used. A warehouse on a local disk
    serves a single machine only, so elsewhere it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        alone = re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "local"))
        if not alone and (":" not in base or base.startswith("file:")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {base} is local")
    return f"{base.rstrip('/')}/paperloom/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, path: str) -> DataFrame:
    """The frame, written to ``path`` and read from there; its schema is known, so no job looks for it."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def counted(frame: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and what gives the number of its rows once it has been written."""
    seen = Observation()
    return frame.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def spread(scan: DataFrame) -> DataFrame:
    """Spread a small scan over all cores ahead of costly expressions.

    Only a scan with fewer partitions than cores is shuffled, so a large table stays as
    it was read.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
