"""Objects of bounded size that every task needs."""

import pickle
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import SparkSession

T = TypeVar("T")


def share(spark: SparkSession, value: T) -> Callable[[], T]:
    """Broadcast ``value`` with its class; the returned function gives it back inside a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
