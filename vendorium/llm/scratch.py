"""Intermediate tables in the shared scratch folder, and column names that clash with no given column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from vendorium.session import delete_folder, scratch_path


class Scratch:
    """Tables written to the folder that `spark.checkpoint.dir` names, so that lost executors cost a task only."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.drop(label)
        self._paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        """Delete tables that nothing later reads."""
        for label in labels:
            if label in self._paths:
                delete_folder(self.spark, self._paths.pop(label))


def fresh_name(wanted: str, taken: Iterable[str]) -> str:
    """`wanted`, or with underscores after it until no given column has that name in any case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted
