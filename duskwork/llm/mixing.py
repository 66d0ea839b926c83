"""Sources mixed to target weights by Poisson replication, in DataFrame operations only.

A document of source ``s`` is repeated Poisson(rate) times, rate = wanted rows of the
source / its rows, by inverting the distribution at a uniform number hashed from
seed, doc_id and piece. Rates above ``PIECE`` are split into equal pieces with numbers of their
own, whose counts add up to the same distribution, so tables of cumulative
probabilities stay short. All copies are shuffled globally by a hash.

Without given weights a source gets its row count to the power of ``power``. Rows with a null source form a
source of their own; repeated rows and rows that share a ``doc_id`` get the same
count; a null ``doc_id`` hashes like the word null. Null texts stay null. All
columns of the input are kept, added ones are named ``copy`` and ``position``, with an
underscore behind a name that the input has already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.operators.durable import reuse_keys

SEED = "mix-1"
PIECE = 8.0
# P(Poisson(8) > 60) is below 1e-30, far under the 2^-52 steps of the numbers.
TERMS = 60
POWER = 0.5


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) in steps of 2^-52 from the digest of ``parts``."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: DataFrame | None, power: float, total: int | None) -> DataFrame:
    """mix_source, pieces, cdf: cumulative probabilities of a piece's count per source.

    ``weights`` has columns source and weight; sources without a weight are left out.
    """
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count("*").alias("rows"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(power)))
    else:
        given = weights.select(F.col("source").alias("given_source"), F.col("weight").cast("double"))
        sizes = sizes.join(given, F.col("mix_source").eqNullSafe(F.col("given_source"))).drop("given_source")
    all_weight, all_rows = sizes.agg(F.sum("weight"), F.sum("rows")).first()
    share = F.col("weight") / F.lit(float(all_weight or 1))
    rate = share * F.lit(float(total if total is not None else all_rows or 0)) / F.col("rows")
    split = sizes.withColumn("rate", rate).withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("long"))
    piece = split.withColumn("mean", F.col("rate") / F.col("pieces"))
    first = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * F.col("mean") / k.cast("double")
        return F.struct(p.alias("p"), F.array_append(state["cdf"], F.element_at(state["cdf"], -1) + p).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), first, step)["cdf"]
    return piece.select("mix_source", "pieces", cdf.alias("cdf"))


def mixed(
    docs: DataFrame, weights: DataFrame | None = None, power: float = POWER, total: int | None = None, seed: str = SEED
) -> DataFrame:
    """All columns of ``docs`` plus copy (from 0) and position (hash that orders the mix).

    ``total`` is the expected number of rows; the input's own by default. Rates are
    one row per source, written out and counted; up to a million sources they are
    broadcast, so documents move once, in the final shuffle.
    """
    rates = reuse_keys(source_rates(docs, weights, power, total))
    # The input's columns travel in one struct, so none of their names meets one used here.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].alias("source"))
    key = F.coalesce(F.col("row")[doc_id_of(docs)].cast("string"), F.lit("null"))
    numbers = F.transform(F.sequence(F.lit(1).cast("long"), F.col("pieces")), lambda piece: uniform(F.lit(seed), key, piece.cast("string")))
    count = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u)))
    counted = rows.join(rates, rows["source"].eqNullSafe(rates["mix_source"])).select("row", count.alias("count"))
    copies = counted.filter(F.col("count") > 0).select("row", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("copy"))
    placed = copies.withColumn("position", F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), key, F.col("copy").cast("string"))))
    added = [F.col(c).alias(free_name(c, docs.columns)) for c in ("copy", "position")]
    return placed.orderBy("position", F.col("row")[doc_id_of(docs)]).select(*[F.col("row")[c].alias(c) for c in docs.columns], *added)


def doc_id_of(docs: DataFrame) -> str:
    return next(c for c in docs.columns if c.lower() == "doc_id")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores behind it until no column of the input is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name
