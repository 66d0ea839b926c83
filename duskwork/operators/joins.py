"""Joins that need more than a plain equality of two columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.text import matches
from duskwork.operators.filters import Keys, join_side, key_list

GRAM = 3
PREFIX_GRAM = 8
# Rows of either side in a cell of a product.
CELL_ROWS = 2048
# (escaped in a pattern, literal, stand-in from the private use area), backslash first
ESCAPES = (("\\\\", "\\", "\ue001"), ("\\%", "%", "\ue002"), ("\\_", "_", "\ue003"))


def derived_key_join(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner"
) -> DataFrame:
    """Equality join on computed keys, for example trimmed or converted codes.

    The keys become columns first, so the join stays a hash or merge join.
    """
    a = left.withColumn("__key", left_key)
    b = right.withColumn("__key", right_key)
    return a.join(b, "__key", how).drop("__key")


def owners_of(df: DataFrame, owners: Sequence[str], owner: str) -> DataFrame:
    """One row per row of ``df`` and distinct non-NULL owner among ``owners``."""
    everyone = F.array_distinct(F.array_compact(F.array(*[F.col(c) for c in owners])))
    return df.withColumn(owner, F.explode(everyone))


def either_owner_join(
    df: DataFrame, parties: DataFrame, owners: Sequence[str], party: str, how: str = "inner"
) -> DataFrame:
    """Rows joined to a party that is any one of their ``owners``.

    "party = main OR party = joint" cannot be hashed; one row per owner can. A
    party named twice in a row is joined once.
    """
    return owners_of(df, owners, "__owner").join(
        parties, F.col("__owner") == parties[party], how
    ).drop("__owner")


def block_count(df: DataFrame, rows: int) -> Column:
    """Blocks of ``rows`` rows that a frame is dealt into, at least one, as a scalar subquery."""
    return df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(rows))).cast("int").alias("n")).scalar()


def all_combinations(left: DataFrame, right: DataFrame, cell: int = CELL_ROWS) -> DataFrame:
    """Every row of ``left`` with every row of ``right``.

    The full product is the result asked for here (code tables crossed with
    code tables). It is computed on a grid: left rows are dealt into as many bands as they
    need at ``cell`` rows each, right rows into as many columns, each row is copied along its
    band or column, and an equality join on both numbers makes the cells. So no task
    gets more than ``cell`` by ``cell`` pairs, and cells grow in number with the product. Both
    sides are counted first: hand in written frames if they are costly.
    """
    bands, columns = block_count(left, cell), block_count(right, cell)

    def dealt(df: DataFrame, number: str, count: Column, copied: str, copies: Column) -> DataFrame:
        own = df.withColumn(number, F.pmod(F.xxhash64(*df.columns), count).cast("int"))
        return own.withColumn(copied, F.explode(F.sequence(F.lit(0), copies - 1)))

    a = dealt(left, "__band", bands, "__column", columns)
    b = dealt(right, "__column", columns, "__band", bands)
    return a.join(b, ["__band", "__column"]).drop("__band", "__column")


def _runs(pattern: Column) -> Column:
    """The literal runs of a LIKE pattern, none of them empty.

    Escaped characters are literal: they're swapped for stand-ins while the
    pattern is cut at its wildcards. A pattern that holds such a stand-in itself
    counts as one without runs.
    """
    swapped = pattern
    for escaped, _, stand_in in ESCAPES:
        swapped = F.replace(swapped, F.lit(escaped), F.lit(stand_in))

    def plain(run: Column) -> Column:
        for _, literal, stand_in in ESCAPES:
            run = F.replace(run, F.lit(stand_in), F.lit(literal))
        return run

    runs = F.transform(F.filter(F.split(swapped, "[%_]"), lambda r: F.length(r) > 0), plain)
    taken = F.rlike(pattern, F.lit("[" + "".join(s for _, _, s in ESCAPES) + "]"))
    return F.when(taken, F.array().cast("array<string>")).otherwise(runs)


def _pieces(run: Column, gram: int) -> Column:
    """All pieces of ``gram`` characters of a run, or the run itself if it is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(run) - gram + 1))
    return F.transform(starts, lambda i: F.substring(run, i, F.lit(gram)))


def _grams(text: Column, gram: int) -> Column:
    """All pieces of ``text`` of one to ``gram`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text)))
    pieces = F.transform(starts, lambda i: F.array(*[F.substring(text, i, F.lit(n)) for n in range(1, gram + 1)]))
    return F.filter(F.array_distinct(F.flatten(pieces)), lambda g: g != "")


def rarest_grams(patterns: DataFrame, pattern: str, grams: DataFrame, gram: int) -> DataFrame:
    """(pattern, __gram): of a pattern's pieces the one that fewest texts have.

    ``grams`` has a row per text and gram (column ``__gram``); its counts are combined
    map-side. A pattern with a piece that no text has matches nothing and is left out.
    """
    counts = grams.groupBy("__gram").agg(F.count(F.lit(1)).alias("__texts"))
    pieces = patterns.withColumn("__gram", F.explode(F.flatten(F.transform(_runs(F.col(pattern)), lambda r: _pieces(r, gram)))))
    counted = pieces.distinct().join(join_side(counts, "__gram"), "__gram", "left")
    rarest = F.min(F.struct(F.coalesce("__texts", F.lit(0)).alias("texts"), "__gram")).alias("__rarest")
    return counted.groupBy(pattern).agg(rarest).where(F.col("__rarest.texts") > 0).select(pattern, F.col("__rarest.__gram").alias("__gram"))


def pattern_matches(
    patterns: DataFrame, pattern: str, texts: DataFrame, text: str, *, prefix: bool = False, gram: int | None = None
) -> DataFrame:
    """Distinct (pattern, text) pairs with ``text LIKE pattern``.

    A LIKE condition alone would compare every pattern with every text. Here
    texts are indexed by their pieces of up to ``gram`` characters, each pattern is looked
    up by the piece of its literal runs that fewest texts have, and the texts found are
    checked with the real LIKE. ``prefix=True`` is for patterns that mostly start with a literal
    run: that run (at most ``gram`` characters) is the key, and a text has only as many
    pieces as that. Patterns of wildcards alone (or starting with one, under ``prefix``) are
    compared with every text, as a product in blocks.
    """
    gram = gram or (PREFIX_GRAM if prefix else GRAM)
    p = patterns.select(pattern).where(F.col(pattern).isNotNull()).distinct()
    t = texts.select(text).where(F.col(text).isNotNull()).distinct()
    if prefix:
        led = F.rlike(F.col(pattern), F.lit("^[^%_]")) & (F.size(_runs(F.col(pattern))) > 0)
        keyed = p.where(led).withColumn("__gram", F.substring(_runs(F.col(pattern))[0], 1, gram))
        heads = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(gram)), lambda n: F.substring(F.col(text), F.lit(1), n)))
        grams = t.withColumn("__gram", F.explode(F.filter(heads, lambda g: g != "")))
    else:
        led = F.size(_runs(F.col(pattern))) > 0
        grams = t.withColumn("__gram", F.explode(_grams(F.col(text), gram)))
        keyed = rarest_grams(p.where(led), pattern, grams, gram)
    found = join_side(keyed, "__gram").join(grams, "__gram").select(pattern, text)
    rest = all_combinations(p.where(~led), t).select(pattern, text)
    return found.unionByName(rest).where(matches(text, pattern))


def unique_rows(df: DataFrame, key: Keys, what: str) -> DataFrame:
    """``df`` as one row per key; running it fails if a key has several rows.

    The check is a filter, so it runs whatever columns are read afterwards.
    """
    names = key_list(key)
    rest = [c for c in df.columns if c not in names]
    packed = df.groupBy(*names).agg(
        F.count(F.lit(1)).alias("__rows"), F.first(F.struct(*rest) if rest else F.lit(1)).alias("__row")
    )
    twice = F.raise_error(F.concat(F.lit(f"{what}: several rows for key "), F.to_json(F.struct(*names))))
    checked = packed.where(F.when(F.col("__rows") > 1, twice.cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*names, *[F.col("__row")[c].alias(c) for c in rest])
