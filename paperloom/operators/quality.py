"""Batch counts, quarantine and the failure gate."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class TooManyFailures(RuntimeError):
    """Raised before the sink when a batch holds too many unusable rows."""


def batch_stats(
    date_column: str | None = None, flags: tuple[str, ...] = ()
) -> dict[str, Column]:
    """The batch's metrics: row count, latest date and the sum of each flag."""
    stats = {"row_count": F.count("*")}
    if date_column:
        stats["latest_date"] = F.max(F.col(date_column).cast("date"))
    for flag in flags:
        stats[f"{flag}_count"] = F.count_if(F.col(flag) == 1)
    return stats


def observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Collect the metrics while ``df`` is written, without a pass of its own."""
    observation = Observation(name)
    return df.observe(observation, *[m.alias(k) for k, m in metrics.items()]), observation


def country_problem(where: Column, affils: Column, countries: Column) -> Column:
    """Why a selected article got no country list; NULL when it did."""
    wanted = F.coalesce(where, F.lit(False))
    return (
        F.when(wanted & (F.size(affils) == 0), F.lit("empty affiliation list"))
        .when(wanted & countries.isNull(), F.lit("no country list"))
    )


def quarantine(df: DataFrame, problem: str) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and the rows whose ``problem`` (text or list) says otherwise."""
    is_list = dict(df.dtypes)[problem].startswith("array")
    failed = F.size(problem) > 0 if is_list else F.col(problem).isNotNull()
    return df.where(~failed).drop(problem), df.where(failed)


def problem_counts(df: DataFrame, problem: str) -> DataFrame:
    """Failed rows per kind of problem."""
    kinds = F.explode(problem) if dict(df.dtypes)[problem].startswith("array") else F.col(problem)
    listed = df.select(kinds.alias("problem")).where(F.col("problem").isNotNull())
    return listed.groupBy("problem").agg(F.count("*").alias("failed"))


def failure_metrics(problem: str) -> dict[str, Column]:
    failed = F.col(problem).isNotNull()
    return {"row_count": F.count("*"), "failed_count": F.count_if(failed)}


def gate(
    counts: Observation | Mapping[str, int],
    max_ratio: float = 0.05,
    max_failed: int | None = None,
) -> None:
    """Stop before the sink when the staged batch failed too often."""
    counts = counts.get if isinstance(counts, Observation) else counts
    failed, rows = counts["failed_count"], counts["row_count"]
    if max_failed is not None and failed > max_failed:
        raise TooManyFailures(f"{failed} rows failed, {max_failed} allowed")
    if rows and failed / rows > max_ratio:
        raise TooManyFailures(f"{failed} of {rows} rows failed, ratio {max_ratio} allowed")
