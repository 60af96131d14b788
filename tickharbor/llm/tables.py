"""Reading the given tables, and settings of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickharbor.session import ship


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; the workers of its jobs get this package with it."""
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents")


def tasks_of(spark: SparkSession) -> int:
    """Number of tasks for a shuffle that adaptive execution must not change, as the session sets it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drop_shuffles(spark: SparkSession) -> None:
    """Let every job delete its shuffle files when it ends, for operators that write a table after each large shuffle."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def vocabulary(name: str) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)
