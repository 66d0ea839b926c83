"""Lookups by pattern, with fallbacks, and text cut into segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.text import segments
from duskwork.operators.filters import join_side, with_match
from duskwork.operators.joins import pattern_matches


def first_by(value: Column, order: Sequence[Column | str]) -> Column:
    """Aggregate: ``value`` of the first row in ``order``, as a struct that is
    present even when the value itself is NULL."""
    return F.min_by(F.struct(value.alias("value")), F.struct(*order))


def choose_pattern(
    keys: DataFrame, specific: str, generic: str, texts: DataFrame, text: str, chosen: str, *, prefix: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Specific pattern where it matches some text, otherwise the generic one.

    Returns the keys with the ``chosen`` pattern, and the (chosen, text) pairs
    that match.
    """
    both = keys.select(F.col(specific).alias(chosen)).union(keys.select(generic)).distinct()
    pairs = pattern_matches(both, chosen, texts, text, prefix=prefix)
    found = pairs.select(F.col(chosen).alias(specific))
    marked = with_match(keys, found, specific, "__specific")
    picked = F.when(F.col("__specific"), F.col(specific)).otherwise(F.col(generic))
    return marked.withColumn(chosen, picked).drop("__specific"), pairs


def fallback_pattern(
    keys: DataFrame, specific: str, generic: str, lookup: DataFrame, text: str, *, prefix: bool = False
) -> DataFrame:
    """Each key with every lookup row its chosen pattern matches."""
    chosen, pairs = choose_pattern(keys, specific, generic, lookup, text, "__chosen", prefix=prefix)
    return chosen.join(pairs, "__chosen").join(lookup, text).drop("__chosen")


@dataclass(frozen=True)
class Step:
    """One attempt of a cascade: lookup rows are found by equality on ``on``;
    the first in ``order`` supplies ``value``."""

    lookup: DataFrame
    on: tuple[str, ...]
    value: Column
    order: tuple[Column | str, ...]


def cascade_lookup(keys: DataFrame, steps: Sequence[Step], value: str, step: str | None = None) -> DataFrame:
    """The value of the first step that finds a row, NULL when none does.

    A row found with a NULL value ends the search. ``step`` names an optional
    column with the number of the successful step.
    """
    out = keys
    for i, attempt in enumerate(steps):
        names = list(attempt.on)
        best = attempt.lookup.groupBy(*names).agg(first_by(attempt.value, attempt.order).alias(f"__found_{i}"))
        out = out.join(join_side(best, names), names, "left")
    hits = [F.col(f"__found_{i}") for i in range(len(steps))]
    number = F.coalesce(*[F.when(h.isNotNull(), F.lit(i + 1)) for i, h in enumerate(hits)])
    columns = [*keys.columns, F.coalesce(*hits)["value"].alias(value)]
    return out.select(*columns, *([number.alias(step)] if step else []))


def chunk_scan(
    df: DataFrame, text: str, needle: Column | str, *, width: int = 78, count: int | None = None, head: int = 8,
    position: str = "segment", found: str = "code",
) -> DataFrame:
    """Segments of a text that contain ``needle``, with their first characters.

    The text is cut at fixed positions, all of it unless ``count`` fixes the
    number of segments; the needle is taken literally.
    """
    needle = F.lit(needle) if isinstance(needle, str) else needle
    numbered = df.select(*df.columns, F.posexplode(segments(text, width, count)).alias("__pos", "__segment"))
    return numbered.where(F.contains(F.col("__segment"), needle)).select(
        *df.columns,
        (F.col("__pos") + 1).alias(position),
        F.substring(F.col("__segment"), 1, head).alias(found),
    )
