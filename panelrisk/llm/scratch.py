"""Stored steps of one operator in the shared folder, dropped once they are consumed."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from panelrisk.storage import new_path


class Scratch:
    """Tables of one run. A stored step cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder = spark, new_path(spark, label)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        schema = df.schema
        df.write.parquet(path)
        del df
        # shuffle files go when the driver no longer refers to them; a collection says so now
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
