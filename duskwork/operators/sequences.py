"""Key sequences: a table that holds the last key handed out, so that no target is scanned for it.

A job takes a block of keys behind the last one and returns the table with the block
reserved. Old and new table are states like any other: a job that is run again
from the same state hands out the same keys, and a failed one reserves nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwork.operators.keys import highest

SEQUENCES = "key_sequence"
SEQUENCE_SCHEMA = "name string, last_id bigint"

Tables = Mapping[str, DataFrame]


def sequence_name(table: str, key: str) -> str:
    return f"{table}.{key}"


def sequence_table(spark: SparkSession, tables: Tables, keys: Iterable[tuple[str, str]]) -> DataFrame:
    """The first state: for each (table, key) the greatest key in use. Scans each table once."""
    rows = spark.createDataFrame([], SEQUENCE_SCHEMA)
    for table, key in keys:
        rows = rows.unionByName(tables[table].agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("last_id")).select(
            F.lit(sequence_name(table, key)).alias("name"), "last_id"))
    return rows


def last_key(tables: Tables, table: str, key: str) -> Column:
    """Last key handed out for a table, as a scalar subquery.

    Read from the sequence table where there is one, which must then list the key; else
    the greatest key in use.
    """
    if SEQUENCES not in tables:
        return highest(tables[table], key)
    name = sequence_name(table, key)
    held = tables[SEQUENCES].where(F.col("name") == name).select("last_id").scalar()
    return F.coalesce(held, F.raise_error(F.lit(f"no sequence {name}")).cast("bigint"))


def reserved(tables: Tables, used: Mapping[tuple[str, str], DataFrame]) -> dict[str, DataFrame]:
    """The sequence table with one key per row of each frame reserved; nothing where there is no sequence table."""
    if SEQUENCES not in tables:
        return {}
    last = F.col("last_id")
    for (table, key), rows in used.items():
        count = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
        last = F.when(F.col("name") == sequence_name(table, key), F.col("last_id") + count).otherwise(last)
    return {SEQUENCES: tables[SEQUENCES].select("name", last.alias("last_id"))}


def moved_to(tables: Tables, table: str, key: str, rows: DataFrame) -> dict[str, DataFrame]:
    """The sequence table with the greatest key of ``rows`` as the last one, for keys with gaps."""
    if SEQUENCES not in tables:
        return {}
    top = rows.agg(F.max(key).alias("top")).scalar()
    moved = F.when(F.col("name") == sequence_name(table, key), F.greatest(F.col("last_id"), top)).otherwise(F.col("last_id"))
    return {SEQUENCES: tables[SEQUENCES].select("name", moved.alias("last_id"))}
