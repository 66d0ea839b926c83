"""Parquet tables in, new table states out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

Tables = Mapping[str, DataFrame]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """One lazy DataFrame per named table."""
    return {name: read_table(spark, folder, name) for name in names}


def project_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, or all of them when none is named."""
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_tables(tables: Tables, folder: str) -> None:
    """Write each table as Parquet under ``folder``, which must not be the
    folder the tables are read from."""
    for name, df in tables.items():
        write_table(df, folder, name)
