"""Which customer entity stands for an owner, or for a pair of owners."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.operators.filters import drop_matching, join_side, keep_matching
from duskwork.sources.codes import FIRST_OWNER, NO_ENTITY, SECOND_OWNER

HEAVY_GROUP = 32

Settle = Callable[[DataFrame], DataFrame]


def unsettled(df: DataFrame) -> DataFrame:
    return df


def sole_member_group(members: DataFrame, group: str, member: str) -> DataFrame:
    """For each member, the latest group that has no other member.

    A group with one member has the same least and greatest member, which is
    combined map-side; no group is brought together.
    """
    spread = members.groupBy(group).agg(F.min(member).alias("__low"), F.max(member).alias("__high"))
    return (
        spread.where(F.col("__low") == F.col("__high"))
        .groupBy(F.col("__low").alias(member)).agg(F.max(group).alias(group))
    )


def joint_group(
    members: DataFrame, wanted: DataFrame, group: str, member: str, role: str, first: str, second: str,
    first_role: str = FIRST_OWNER, second_role: str = SECOND_OWNER, heavy: int = HEAVY_GROUP,
    settle: Settle = unsettled,
) -> DataFrame:
    """For each wanted (first, second) pair, the latest group with ``first`` as
    its first and ``second`` as its second owner. Pairs without one are absent.

    Ordinary groups are expanded into their pairs. A group with more than
    ``heavy`` first or second owners is not: there each wanted pair is checked
    against the group's members by equality joins. Both ways are exact.
    ``settle`` may write out the (few) crowded groups and mark them for broadcast.
    """
    wanted = wanted.select(first, second).dropna().distinct()
    firsts = members.where(F.col(role) == first_role).select(group, F.col(member).alias(first))
    seconds = members.where(F.col(role) == second_role).select(group, F.col(member).alias(second))
    firsts = keep_matching(firsts.dropna().distinct(), wanted, first)
    seconds = keep_matching(seconds.dropna().distinct(), wanted, second)

    sizes = (
        firsts.groupBy(group).agg(F.count(F.lit(1)).alias("__owners"))
        .unionByName(seconds.groupBy(group).agg(F.count(F.lit(1)).alias("__owners")))
        .where(F.col("__owners") > heavy).select(group).distinct()
    )
    big = settle(sizes)
    light = drop_matching(firsts, big, group).join(drop_matching(seconds, big, group), group)
    crowded = keep_matching(firsts, big, group).join(wanted, first).join(seconds, [group, second], "left_semi")
    found = (
        light.select(first, second, group).unionByName(crowded.select(first, second, group))
        .groupBy(first, second).agg(F.max(group).alias(group))
    )
    return keep_matching(found, wanted, [first, second])


def resolve_entities(pairs: DataFrame, matrix: DataFrame, users: DataFrame, settle: Settle = unsettled) -> DataFrame:
    """``main``, ``joint`` pairs with their ``entity_id``, or -999.

    A NULL ``joint`` asks for the main owner's own entity. ``users`` links
    ``user_info_id`` to the client number.
    """
    members = matrix.join(users.select("user_info_id", "clntnum"), "user_info_id").select(
        "entity_id", "relationship", "clntnum"
    )
    pairs = pairs.select("main", "joint").distinct()
    single = sole_member_group(members, "entity_id", "clntnum").select(
        F.col("clntnum").alias("main"), "entity_id"
    )
    alone = pairs.where(F.col("joint").isNull()).join(join_side(single, "main"), "main", "left")
    both = pairs.where(F.col("joint").isNotNull())
    together = both.join(
        joint_group(members, both, "entity_id", "clntnum", "relationship", "main", "joint", settle=settle),
        ["main", "joint"], "left",
    )
    return alone.select("main", "joint", "entity_id").unionByName(
        together.select("main", "joint", "entity_id")
    ).withColumn("entity_id", F.coalesce("entity_id", F.lit(NO_ENTITY)))
