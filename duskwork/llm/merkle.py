"""A manifest of a dataset as Merkle trees of fixed fanout, one per group and one over the groups.

Rows become leaves, leaves ascend by ``doc_id`` within their ``lang`` (nulls first, ties
by digest), and every ``FANOUT`` consecutive nodes become the digest of their
concatenation until one is left: the group's subroot. Subroots in order of ``lang``
(null first, bytewise) form the top tree in the same way.

A level is one aggregate: a node's place gives its parent and its slot, and one
conditional aggregate per slot spreads the children into columns. Concatenated, these
columns hash to the parent; without the own column they are a child's siblings. Going
down again, each parent hands its path to its children, so a proof costs one join of
nodes with their own children per level and texts are read once.

Places come from a range partitioning of the leaves (digests only, no texts) and one
running count per partition and group. Keys of all joins and aggregates are places,
which are unique: no hot groups. ``proof`` is an array of (left, right) from the leaf
up: digests of the siblings before and behind the own slot.

A null field counts as ``-``, an empty text as ``0:``; repeated rows are leaves of their
own; a null ``doc_id`` is never tampered with in ``verified``; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwork.llm.frames import written

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = [f"c{i}" for i in range(FANOUT)]
STEP = "struct<left: string, right: string>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, lang, leaf, shown: each row's digest, and the digest of the row as presented later.

    ``tampered`` is the text as presented, null where it is the original one.
    """
    own = digest(*[field(docs[c]) for c in FIELDS])
    shown = own if tampered is None else F.when(
        tampered.isNotNull(), digest(*[field(docs[c]) for c in FIELDS[:-1]], field(tampered))
    ).otherwise(own)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"], own.alias("leaf"), shown.alias("shown"))


def laid_out(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` written in ranges of ``order``, with ``at``: partition and row number in ascending order.

    Rows alike in everything are dealt over partitions too.
    """
    order = [*order, F.col("tie")]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.drop("tie").withColumn("at", F.monotonically_increasing_id()), name)


def part_of(at: str) -> Column:
    return F.shiftright(at, 33)


def spans(placed: DataFrame, key: list[str]) -> DataFrame:
    """part, key, shift, n: what takes ``at`` to the place in the group, and the group's rows.

    One row per partition and group found in it: at most as many as partitions and
    groups together.
    """
    found = placed.groupBy(part_of("at").alias("part"), *key).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(*key)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")
    return found.select("part", *key, shift.alias("shift"), F.sum("rows").over(whole).alias("n"))


def runs_of(nodes: DataFrame) -> DataFrame:
    """Runs of up to ``FANOUT`` nodes as one row: tree, n and place of the parent, slot columns c0, c1, ... and its hash."""
    up_n, up = F.ceil(F.col("n") / FANOUT).cast("long"), parent("place")
    spread = [F.max(F.when(F.col("place") % FANOUT == i, F.col("hash"))).alias(f"c{i}") for i in range(FANOUT)]
    runs = nodes.filter("n > 1").groupBy("tree", up_n.alias("up_n"), up.alias("up")).agg(*spread)
    return runs.select(
        "tree", F.col("up_n").alias("n"), F.col("up").alias("place"), *SLOTS,
        digest(*[F.coalesce(F.col(c), F.lit("")) for c in SLOTS]).alias("hash"),
    )


def parent(place: str) -> Column:
    return F.floor(F.col(place) / FANOUT).cast("long")


def levels_over(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Levels of pivoted runs above ``nodes`` (tree, n, place, hash), lowest first."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while most > 1:
        nodes = written(runs_of(nodes), f"{name}-{len(levels)}")
        levels.append(nodes)
        most = -(-most // FANOUT)
    return levels


def sibling_step(place: str) -> Column:
    """All slot columns but the own one, as the text before and the text behind it."""
    def side(numbers):
        return F.concat(F.lit(""), *[F.coalesce(F.col(f"c{j}"), F.lit("")) for j in numbers])

    cases = F.lit(None)
    for i in range(FANOUT):
        cases = F.when(F.col(place) % FANOUT == i, F.struct(side(range(i)).alias("left"), side(range(i + 1, FANOUT)).alias("right"))).otherwise(cases)
    return cases


def with_paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """``nodes`` plus path (steps from the node up) and subroot.

    ``tops`` has tree, path, subroot: the way on from the root of each tree. From the
    highest level down, each run's path goes to the nodes below it by one join.
    """
    above = None
    for number, below in reversed(list(enumerate([nodes, *levels]))):
        columns = below.columns
        carried = below.filter("n = 1").join(tops, "tree").select(*columns, "path", "subroot")
        if above is not None:
            up = above.select(F.col("tree").alias("up_tree"), F.col("place").alias("up_place"), *SLOTS, F.col("path").alias("up_path"), "subroot")
            rest = below.filter("n > 1").select(*[F.col(c).alias(f"own_{c}") for c in columns])
            joined = rest.join(up, (F.col("own_tree") == F.col("up_tree")) & (parent("own_place") == F.col("up_place")))
            path = F.concat(F.array(sibling_step("own_place")), "up_path").alias("path")
            carried = carried.unionByName(joined.select(*[F.col(f"own_{c}").alias(c) for c in columns], path, "subroot"))
        above = written(carried, f"{name}-{number}") if number else carried
    return above


def manifest(docs: DataFrame, tampered: Column | None = None) -> tuple[DataFrame, str | None]:
    """doc_id, lang, leaf, shown, subroot, proof of every row, and the root over all (null without rows)."""
    spark = docs.sparkSession
    ascending = F.col("lang").asc_nulls_first()
    made = written(leaves(docs, tampered), "leaves")
    placed = laid_out(made, [ascending, F.col("doc_id").asc_nulls_first(), F.col("leaf")], "placed")
    found = written(spans(placed, ["lang"]), "spans")
    groups = laid_out(found.select("lang").distinct(), [ascending], "groups")
    trees = groups.join(spans(groups, []), part_of("at") == F.col("part")).select(
        "lang", (F.col("at") + F.col("shift")).alias("tree"), F.col("n").alias("trees"))
    trees = written(trees, "trees")
    held = found.join(trees.withColumnRenamed("lang", "tree_lang"), F.col("lang").eqNullSafe(F.col("tree_lang")))
    held = held.select("part", F.col("lang").alias("span_lang"), "shift", "n", "tree")
    nodes = written(
        placed.join(held, (part_of("at") == F.col("part")) & F.col("lang").eqNullSafe(F.col("span_lang"))).select(
            "tree", "n", (F.col("at") + F.col("shift")).alias("place"), F.col("leaf").alias("hash"), "doc_id", "lang", "shown"),
        "nodes",
    )
    levels = levels_over(nodes, "level")
    subroots = reduce(DataFrame.unionByName, [p.filter("n = 1").select("tree", "hash") for p in (nodes, *levels)])
    subroots = written(subroots.join(trees, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("trees").alias("n"), F.col("tree").alias("place"), "hash"), "subroots")
    upper = levels_over(subroots, "top")
    root = (upper[-1] if upper else subroots).select("hash").first()
    start = spark.range(1).select(F.col("id").alias("tree"), F.array().cast(f"array<{STEP}>").alias("path"), F.lit("").alias("subroot"))
    ways = with_paths(subroots, upper, start, "top-path")
    ways = written(ways.select(F.col("place").alias("tree"), "path", F.col("hash").alias("subroot")), "ways")
    rows = with_paths(nodes, levels, ways, "path")
    return rows.select("doc_id", "lang", F.col("hash").alias("leaf"), "shown", "subroot", F.col("path").alias("proof")), root[0] if root else None


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def verified(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root and digest of its proof, and whether it still leads to the root.

    Rows whose ``doc_id`` has a crc32 divisible by three are presented with lower-cased
    text (A-Z only), the others as they are.
    """
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    rows, root = manifest(docs, F.when(chosen, F.translate(docs["text"], UPPER, LOWER)))
    joined = F.aggregate("proof", F.lit(""), lambda a, s: F.concat(a, s["left"], s["right"]))
    folded = rows.select(
        "doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), F.sha2(joined, 256).alias("proof_sha256"),
        fold(F.col("shown"), F.col("proof")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
