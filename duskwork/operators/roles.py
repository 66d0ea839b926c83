"""Classifying users by the exact set of roles they hold, and status rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.operators.filters import Keys, key_list


def role_set(assignments: DataFrame, user: Keys, role: str, required: Sequence[str], exact: bool = True) -> DataFrame:
    """Users who hold every required role and, if ``exact``, no other.

    Roles become one flag each, so only flags are combined per user.
    """
    flags = [F.max(F.col(role).eqNullSafe(F.lit(r))).alias(f"__has_{i}") for i, r in enumerate(required)]
    other = F.max(F.coalesce(~F.col(role).isin(list(required)), F.lit(False))).alias("__other")
    per_user = assignments.groupBy(*key_list(user)).agg(*flags, other)
    held = reduce(lambda a, b: a & b, [F.col(f"__has_{i}") for i in range(len(required))])
    return per_user.where(held & ~F.col("__other") if exact else held).select(*key_list(user))


def roles_held(assignments: DataFrame, user: Keys, role: str, count: int) -> DataFrame:
    """Users who hold exactly ``count`` different roles."""
    held = assignments.groupBy(*key_list(user)).agg(F.countDistinct(role).alias("__roles"))
    return held.where(F.col("__roles") == count).select(*key_list(user))


def minus(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Distinct rows of the first frame that are in none of the others, taken
    off one after the other. NULL equals NULL.

    Each side is made distinct before the join, so repeated rows are combined
    where they are read.
    """
    return reduce(lambda left, right: left.subtract(right.distinct()), rest, first.distinct())


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Rows of any of the frames, each once."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def activity_actions(status: Column, in_group: Column, active: Column) -> tuple[Column, Column]:
    """(ask for a reset, set inactive) under the activity rule.

    A group member with activity who is inactive gets a reset; one without
    activity who is not inactive becomes inactive. An unknown status matches
    neither side.
    """
    member = F.coalesce(in_group, F.lit(False))
    busy = F.coalesce(active, F.lit(False))
    reset = member & busy & F.coalesce(status == "I", F.lit(False))
    stop = member & ~busy & F.coalesce(status != "I", F.lit(False))
    return reset, stop


# Bits of a long that hold roles; the sign bit is left out.
WORD_BITS = 63


def role_sets(
    assignments: DataFrame, user: Keys, role: str, sets: Mapping[str, Sequence[str]], exact: bool = True, name: str = "role_set"
) -> DataFrame:
    """(user, name of the set) for each set whose roles a user holds: exactly these, or at least these.

    One aggregate answers any number of sets: each role has a bit, a user's roles are
    the bitwise OR over the rows, combined map-side, and sets are compared with it as
    numbers. Roles of no set share one further bit. A NULL role counts as none.
    """
    numbers = {r: i for i, r in enumerate(sorted({r for required in sets.values() for r in required}))}
    other = len(numbers)
    words = other // WORD_BITS + 1

    def masks(ordinals: Iterable[int]) -> list[int]:
        out = [0] * words
        for i in ordinals:
            out[i // WORD_BITS] |= 1 << (i % WORD_BITS)
        return out

    known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]) if numbers else None
    ordinal = F.coalesce(known[F.col(role)], F.lit(other)) if numbers else F.lit(other)
    bit = F.when(F.col(role).isNotNull(), ordinal)
    # two to the power of a bit's place, exact for the 63 places of a word
    value = F.pow(F.lit(2.0), F.pmod(bit, F.lit(WORD_BITS))).cast("bigint")
    none = F.lit(0).cast("bigint")
    held = [F.bit_or(F.when(F.floor(bit / WORD_BITS) == w, value).otherwise(none)).alias(f"__held_{w}") for w in range(words)]
    per_user = assignments.groupBy(*key_list(user)).agg(*held)
    wanted = F.array(*[
        F.struct(F.lit(n).alias("name"), F.array(*[F.lit(m).cast("bigint") for m in masks({numbers[r] for r in required})]).alias("masks"))
        for n, required in sets.items()
    ])
    mine = [F.col(f"__held_{w}") for w in range(words)]

    def fits(s: Column) -> Column:
        pairs = [(mine[w], s["masks"][w]) for w in range(words)]
        return reduce(lambda a, b: a & b, [h == m if exact else h.bitwiseAND(m) == m for h, m in pairs])

    found = per_user.withColumn("__set", F.explode(F.filter(wanted, fits)))
    return found.select(*key_list(user), F.col("__set.name").alias(name))
