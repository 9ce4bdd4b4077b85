"""Counts and totals for the reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_exports(exports: Sequence[DataFrame], *, from_year: int = 1402, index_column: str = "Unnamed: 0") -> DataFrame:
    """Label exports stacked without their index column, from one year on, ordered by
    (year, month, day): a range-partitioned sort."""
    stacked = reduce(lambda a, b: a.unionByName(b), [e.drop(index_column) for e in exports])
    return stacked.filter(F.col("year") >= from_year).orderBy("year", "month", "day")


def sentiment_by_month(labels: DataFrame) -> DataFrame:
    """Number of rated comments by year, month and label."""
    return labels.groupBy("year", "month", "sentiment").agg(F.count("rating").alias("rating_count"))


def sentiment_by_year(monthly: DataFrame) -> DataFrame:
    """Mean (the height of a bar) and sum of the monthly counts by year and label."""
    return monthly.groupBy("year", "sentiment").agg(
        F.avg("rating_count").alias("mean_count"), F.sum("rating_count").alias("sum_count")
    )


def run_totals(outcomes: DataFrame, *, status: str = "status", flag: str = "is_repetitive") -> DataFrame:
    """Processed, failed and flagged rows of a run, as one row."""
    return outcomes.agg(
        F.count_if(F.col(status) == "ok").alias("processed"),
        F.count_if(F.col(status) != "ok").alias("failed"),
        F.count_if(F.col(flag)).alias("flagged"),
    )


def stack_reports(reports: dict[str, DataFrame], label: str = "type") -> DataFrame:
    """Reports of equal columns under one another with their name in ``label``."""
    return reduce(lambda a, b: a.unionByName(b), [r.withColumn(label, F.lit(name)) for name, r in reports.items()])
