"""DELETE, UPDATE, MERGE and archive moves as functions of the old state.

Plain Parquet tables cannot be changed in place; each function returns the new
state of its table, with the columns of the old one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.operators.filters import Keys, drop_matching, join_side, keep_matching, key_list, keys_of, with_match

Sets = Mapping[str, Column]


def is_true(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    return target.where(~is_true(condition))


def delete_keys(target: DataFrame, keys: DataFrame, on: Keys) -> DataFrame:
    return drop_matching(target, keys, on)


def cascade_delete(
    tables: Mapping[str, DataFrame],
    root: str,
    root_keys: DataFrame,
    root_on: Keys,
    children: Sequence[tuple[str, str, Keys, Keys]] = (),
    settle: Callable[[DataFrame], DataFrame] = lambda keys: keys,
) -> dict[str, DataFrame]:
    """Delete root rows and everything below them.

    ``children`` lists (child table, parent table, key in child, key in
    parent), parents first. Returns the new state of every table named.
    ``settle`` is applied to the keys looked up in a parent table, for example
    to write them out before several tables use them.
    """
    return cascade(tables, root, root_keys, root_on, children, settle)[0]


def cascade(
    tables: Mapping[str, DataFrame],
    root: str,
    root_keys: DataFrame,
    root_on: Keys,
    children: Sequence[tuple[str, str, Keys, Keys]] = (),
    settle: Callable[[DataFrame], DataFrame] = lambda keys: keys,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(new states, rows deleted) of a :func:`cascade_delete`; of the root, its keys are given."""
    doomed: dict[str, DataFrame] = {}
    out = {root: delete_keys(tables[root], root_keys, root_on)}
    for child, parent, child_on, parent_on in children:
        renamed = dict(zip(key_list(parent_on), key_list(child_on)))
        columns = [F.col(p).alias(c) for p, c in renamed.items()]
        if parent == root and set(renamed) <= set(key_list(root_on)):
            keys = root_keys.select(*columns)
        else:
            rows = keep_matching(tables[root], root_keys, root_on) if parent == root else doomed[parent]
            keys = settle(keys_of(rows.select(*columns), child_on))
        doomed[child] = keep_matching(tables[child], keys, child_on)
        out[child] = delete_keys(tables[child], keys, child_on)
    return out, {root: root_keys, **doomed}


def update_where(target: DataFrame, condition: Column, sets: Sets) -> DataFrame:
    """Set columns where a condition on the row itself holds; needs no join."""
    hit = is_true(condition)
    return target.select(
        *[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in target.columns]
    )


def update_keys(target: DataFrame, keys: DataFrame, on: Keys, sets: Sets) -> DataFrame:
    """Set columns where the row's key occurs in ``keys``."""
    marked = with_match(target, keys, on, "__hit")
    return update_where(marked, F.col("__hit"), sets).drop("__hit")


def once_per_key(joined: DataFrame, names: Sequence[str], what: str) -> DataFrame:
    """Fail where a row has met a key with several source rows (``__rows``).

    A filter above the join, so it runs whatever columns are read afterwards.
    """
    twice = F.raise_error(F.concat(F.lit(f"{what} rows for key "), F.to_json(F.struct(*names))))
    return joined.where(F.when(F.col("__rows") > 1, twice.cast("boolean")).otherwise(F.lit(True)))


def update_from(target: DataFrame, source: DataFrame, on: Keys, copies: Mapping[str, str], sets: Sets | None = None) -> DataFrame:
    """Overwrite columns with those of the matching source row.

    ``copies`` maps target column to source column; ``sets`` adds fixed values
    for matched rows. A source value of NULL overwrites too. A target row matched by
    two source rows is an error.
    """
    names = key_list(on)
    wanted = sorted(set(copies.values()))
    rest = F.struct(*[F.col(c).alias(f"__src_{c}") for c in wanted]) if wanted else F.lit(1)
    packed = source.dropna(how="any", subset=names).groupBy(*names).agg(
        F.count(F.lit(1)).alias("__rows"), F.first(rest).alias("__row")
    )
    src = join_side(packed.withColumn("__hit", F.lit(True)), names)
    values: dict[str, Column] = {t: F.col("__row")[f"__src_{s}"] for t, s in copies.items()}
    values.update(sets or {})
    merged = once_per_key(target.join(src, names, "left"), names, "update: several")
    return update_where(merged, F.col("__hit"), values).select(*target.columns)


def merge_upsert(
    target: DataFrame, source: DataFrame, on: Keys, update: Sets, insert: Sets, null_safe: bool = False
) -> DataFrame:
    """Update target rows that have a source row, append source rows that have none.

    ``update`` and ``insert`` are expressions over source columns; columns
    left out of ``insert`` become NULL. A target row matched by two source rows
    is an error; unmatched source rows are all inserted. NULL keys never match,
    unless ``null_safe``: then a NULL in a key equals another NULL, so that running a
    merge again changes nothing.
    """
    names = key_list(on)
    if null_safe:
        packed_key = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
        keyed = merge_upsert(
            target.withColumn("__key", packed_key), source.withColumn("__key", packed_key), "__key", update,
            {**insert, "__key": F.col("__key")},
        )
        return keyed.drop("__key")
    new_values = F.struct(*[expression.alias(c) for c, expression in update.items()])
    packed = source.dropna(how="any", subset=names).select(*names, new_values.alias("__new")).groupBy(*names).agg(
        F.count(F.lit(1)).alias("__rows"), F.first("__new").alias("__new")
    )
    present = target.join(join_side(packed, names), names, "left")
    present = once_per_key(present, names, "merge: several source")
    updated = update_where(present, F.col("__rows").isNotNull(), {c: F.col("__new")[c] for c in update}).select(*target.columns)
    fresh = drop_matching(source, target, names)
    inserted = fresh.select(
        *[
            (insert[f.name] if f.name in insert else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return updated.unionByName(inserted)


def rows_for(
    target: DataFrame, source: DataFrame, mapping: Mapping[str, Column | str] | None = None
) -> DataFrame:
    """Source rows in the target's columns and types; unmapped ones are NULL.

    Without a mapping, source columns go to target columns of the same name.
    """
    if mapping is None:
        extra = set(source.columns) - set(target.columns)
        if extra:
            raise ValueError(f"columns not in the target: {sorted(extra)}")
        mapping = {c: c for c in source.columns}
    cells = []
    for field in target.schema.fields:
        value = mapping.get(field.name)
        value = F.col(value) if isinstance(value, str) else F.lit(None) if value is None else value
        cells.append(value.cast(field.dataType).alias(field.name))
    return source.select(*cells)


def append_select(target: DataFrame, source: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Append source rows, target column by target column."""
    return target.unionByName(rows_for(target, source, mapping))


def same_shape(target: DataFrame, source: DataFrame) -> None:
    """Raise unless both tables have the same columns and types in the same order."""
    shapes = [[(f.name, f.dataType) for f in df.schema.fields] for df in (target, source)]
    if shapes[0] != shapes[1]:
        raise ValueError(f"shapes differ: {target.columns} and {source.columns}")


def append_same_shape(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append rows of an identically shaped table."""
    same_shape(target, source)
    return target.unionByName(source)


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows that fill some of the target's columns."""
    return target.unionByName(rows_for(target, rows))


def move_where(source: DataFrame, archive: DataFrame, condition: Column, mapping: Mapping[str, Column | str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Move rows to the archive by a condition on the row itself (no join)."""
    moved = source.where(is_true(condition))
    return delete_where(source, condition), _archived(archive, moved, mapping)


def move_rows(source: DataFrame, archive: DataFrame, keys: DataFrame, on: Keys, mapping: Mapping[str, Column | str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Move rows whose key occurs in ``keys``: (kept source, grown archive)."""
    return delete_keys(source, keys, on), _archived(archive, keep_matching(source, keys, on), mapping)


def _archived(archive: DataFrame, moved: DataFrame, mapping: Mapping[str, Column | str] | None) -> DataFrame:
    return append_same_shape(archive, moved) if mapping is None else append_select(archive, moved, mapping)
