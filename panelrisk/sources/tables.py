"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from panelrisk.functions.columns import finite, to_number


FILES_PER_VALUE = 8


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table; NaN and infinity are null."""
    return clear_nan(spark.read.parquet(f"{folder}/{name}.parquet"))


def parquet_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: parquet_table(spark, folder, n) for n in names}


def clear_nan(df: DataFrame) -> DataFrame:
    """NaN and infinity to null in every floating column."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(*[finite(c).alias(c) if c in floating else F.col(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header and declared types; columns are matched by header name.

    The files are read as text and cast, so that a bad number becomes null. All
    files of a folder must have the same header; another one is an error, never a
    shift of values.
    """
    header = spark.read.option("header", True).csv(path).columns
    names = [c.strip() for c in header]
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError("columns missing in the file: " + ", ".join(missing))
    text = StructType([StructField(n, StringType()) for n in header])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    raw = raw.toDF(*names)
    return raw.select(*[_typed(f).alias(f.name) for f in schema])


def _typed(field: StructField):
    if isinstance(field.dataType, (DoubleType, FloatType)):
        return to_number(field.name)
    if isinstance(field.dataType, StringType):
        return F.col(field.name)
    return F.trim(F.col(field.name)).try_cast(field.dataType)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet; with ``partition_by``, few files per value: rows of one value are dealt to
    ``FILES_PER_VALUE`` tasks at most."""
    if partition_by:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(FILES_PER_VALUE))
        df = df.repartition(*partition_by, salt)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; NaN never reaches the file, null is an empty field."""
    clear_nan(df).write.mode("overwrite").option("header", True).csv(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}.parquet")


def save_catalog_tables(tables: Mapping[str, DataFrame], database: str = "default") -> None:
    """Replace catalog tables, one per entry."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where it was never written or is unreadable."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[SparkSession], DataFrame]
) -> DataFrame:
    """The stored table; built and written on first use."""
    stored = read_or_none(spark, path)
    if stored is None:
        write_table(build(spark), path)
        stored = spark.read.parquet(path)
    return stored
