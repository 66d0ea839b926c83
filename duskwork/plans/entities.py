"""Entity lookup for a set of owner pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from duskwork.functions.text import code
from duskwork.operators.durable import reuse_keys
from duskwork.operators.entities import resolve_entities
from duskwork.plans.job import Tables


def get_entities(tables: Tables, pairs: DataFrame) -> DataFrame:
    """``entity_id`` of each (main, joint) pair of client numbers, or -999."""
    users = tables["r_user_info"].select("user_info_id", code("clntnum").alias("clntnum"))
    wanted = pairs.select(code("main").alias("main"), code("joint").alias("joint"))
    return resolve_entities(wanted, tables["r_custuser_matrix"], users, reuse_keys)
