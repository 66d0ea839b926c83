"""Jaccard join on word shingles with prefix filters under several token orders.

Two sets with Jaccard similarity t or more share tokens among the first
n - ceil(t n) + 1 of each, whatever global order tokens are put in, and at least
``needed`` of them. Postings of those prefixes are grouped by token under two orders (both put
frequent tokens last, then go by different hashes). A candidate pair shares a prefix token under the first
order at ranks that leave room for the overlap, both its documents have enough shared
prefix tokens under both orders, its sizes fit, and its prefixes overlap enough under further orders;
then the sets themselves are intersected, so every link is exact.

What is wanted is linked groups, so pairs inside a group already found aren't
verified: after some rounds in which each token's documents are compared with one
pivot, all remaining candidate pairs across groups are. No link between different
groups can be missed, and no group is expanded into all its pairs.

Frequent tokens are those repeated within the documents of single tasks, summed over
all tasks; the list is cut at ``FREQUENT_MOST`` by raising the count it takes. Any order
gives the same links: the list only decides how many candidates there are.

Equal sets are folded per task before postings are made, and linked by set hash. Null or
blank texts have no shingles and link with nothing. Rows without ``doc_id`` can't be named by a
link: they stay alone with a null component. Rows that share a ``doc_id`` are one node, linked by any of
their texts. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.llm.components import components
from duskwork.llm.frames import map_slices, texts_of, written
from duskwork.operators.durable import reuse_keys

WORDS = 5
PERCENT = 75
FLUSH_TOKENS = 4_000_000
FLUSH_DOCS = 60_000
LOCAL_COUNT = 3
FREQUENT_COUNT = 6
FREQUENT_MOST = 2_000_000
BUCKET_POSTINGS = 1_000_000
HEAVY = 64
STAR_ROUNDS = 2
SEEDS = tuple(np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
MULTIPLIERS = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))
TOP = np.uint64(1 << 63)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(hashed.tobytes(), seed=len(words))], np.uint64)
    last = len(words) - WORDS + 1
    total = hashed[:last] * MULTIPLIERS[0]
    for k in range(1, WORDS):
        total = total + hashed[k : last + k] * MULTIPLIERS[k]
    return np.unique(mix(total))


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def overlap(na, nb):
    """Smallest intersection that makes two sets of these sizes similar."""
    return -(-PERCENT * (na + nb) // (100 + PERCENT))


def needed(na: int, nb: int) -> int:
    """Tokens that the prefixes of two similar sets share at least."""
    o = overlap(na, nb)
    return max(1, min(o - na + prefix_length(na), o - nb + prefix_length(nb)))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Prefix filters under every order, then the exact check."""
    na, nb = len(a), len(b)
    if not na or not nb or 100 * min(na, nb) < PERCENT * max(na, nb):
        return False
    least = needed(na, nb)
    for seed in SEEDS[2:]:
        heads = [np.partition(key, p - 1)[:p] if (p := prefix_length(len(key))) < len(key) else key for key in (mix(a + seed), mix(b + seed))]
        if len(np.intersect1d(*heads, assume_unique=True)) < least:
            return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (na + nb - both)


def flushes(parts, with_rows=False):
    """Documents in bounded groups: ids and sets, equal sets folded into their smallest id."""
    held: dict[bytes, list] = {}
    rows, size = [], 0
    for part in parts:
        for doc, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
            tokens = shingles(text)
            digest = xxhash.xxh3_128_digest(tokens.tobytes())
            if with_rows:
                rows.append((doc, len(tokens), digest))
            if doc is None or not len(tokens):
                continue
            if digest in held:
                held[digest][0] = min(held[digest][0], doc)
            else:
                held[digest] = [doc, tokens]
                size += len(tokens)
        if size > FLUSH_TOKENS or len(held) > FLUSH_DOCS:
            yield list(held.values()), rows
            held, rows, size = {}, [], 0
    if held or rows:
        yield list(held.values()), rows


def facts(docs: DataFrame) -> DataFrame:
    """One pass: kind 0 rows (doc_id, size, set hash), kind 1 rows (token, count in a flush)."""

    def find(parts):
        for nodes, rows in flushes(parts, with_rows=True):
            pairs = np.frombuffer(b"".join(r[2] for r in rows), "<i8").reshape(-1, 2)
            yield [0] * len(rows), [r[0] for r in rows], [r[1] for r in rows], np_array(pairs[:, 0]), np_array(pairs[:, 1])
            if nodes:
                tokens, counts = np.unique(np.concatenate([t for _, t in nodes]), return_counts=True)
                often = counts >= LOCAL_COUNT
                zeros = pa.array(np.zeros(int(often.sum()), np.int64))
                yield [1] * len(zeros), np_array(tokens[often].view("<i8")), np_array(counts[often]), zeros, zeros

    return map_slices(docs, find, "kind int, a long, b long, c long, d long")


def np_array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.int64))


def frequent_tokens(found: DataFrame) -> np.ndarray:
    """Sorted tokens to put last; at most ``FREQUENT_MOST`` by the count from which they are taken."""
    counts = found.filter("kind = 1").groupBy(F.col("a").alias("token")).agg(F.sum("b").alias("times"))
    counts = written(counts.filter(F.col("times") >= FREQUENT_COUNT), "frequent")
    levels = counts.groupBy(F.floor(F.log2("times")).alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for level, n in levels:
        if total + n > FREQUENT_MOST:
            break
        total, least = total + n, 1 << int(level)
    if least is None:
        return np.zeros(0, np.uint64)
    chosen = counts.filter(F.col("times") >= least).select("token").toPandas()["token"].to_numpy(np.int64)
    return np.sort(chosen.view(np.uint64))


POSTING = np.dtype([("token", "<u4"), ("ref", "<u2"), ("rank", "<u2")])
DOC = np.dtype([("doc", "<i8"), ("n", "<u4")])


def postings(docs: DataFrame, frequent, buckets: int) -> DataFrame:
    """kind (order), bucket, docs, light, heavy: prefix postings of a flush, packed by bucket.

    Heavy ones belong to tokens that ``HEAVY`` documents of the flush share.
    """

    def post(parts):
        often = frequent.value
        for nodes, _ in flushes(parts):
            facts_ = np.array([(doc, len(t)) for doc, t in nodes], DOC)
            sizes = facts_["n"].astype(np.int64)
            tokens = np.concatenate([t for _, t in nodes])
            last = np.zeros(len(tokens), bool)
            if len(often):
                last = often[np.minimum(np.searchsorted(often, tokens), len(often) - 1)] == tokens
            ends = np.cumsum(sizes)
            for order in (0, 1):
                key = (mix(tokens + SEEDS[order]) >> np.uint64(1)) | np.where(last, TOP, np.uint64(0))
                chosen, ranks = [], []
                for end, n in zip(ends.tolist(), sizes.tolist()):
                    p = prefix_length(n)
                    first = np.argsort(key[end - n : end])[:p]
                    chosen.append(first + (end - n))
                    ranks.append(np.arange(p))
                chosen = np.concatenate(chosen)
                made = np.empty(len(chosen), POSTING)
                picked = tokens[chosen]
                made["token"] = picked >> np.uint64(32)
                made["ref"] = np.repeat(np.arange(len(nodes)), [len(r) for r in ranks])
                made["rank"] = np.minimum(np.concatenate(ranks), 65535)
                place = ((picked & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
                by = np.lexsort((made["token"], place))
                made, place = made[by], place[by]
                cuts = np.flatnonzero(np.diff(place)) + 1
                for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(place)]):
                    if end > start:
                        yield packed_bucket(order, int(place[start]), made[start:end], facts_)

    def packed_bucket(order, bucket, made, facts_):
        refs, made = np.unique(made["ref"], return_inverse=True)[0], made.copy()
        made["ref"] = np.searchsorted(refs, made["ref"])
        begins = np.flatnonzero(np.r_[True, made["token"][1:] != made["token"][:-1]])
        counts = np.diff(np.r_[begins, len(made)])
        heavy = np.repeat(counts >= HEAVY, counts)
        return [order], [bucket], [facts_[refs].tobytes()], [made[~heavy].tobytes()], [made[heavy].tobytes()]

    return map_slices(docs, post, "kind int, bucket long, docs binary, light binary, heavy binary")


ROW = np.dtype([("token", "<u4"), ("rank", "<u2"), ("told", "?"), ("doc", "<i8"), ("n", "<u4")])


def shared_tokens(packed: DataFrame) -> DataFrame:
    """kind, token, doc_id, n, rank: prefix postings of tokens that two or more nodes share.

    Under the second order only the number per document counts: token null, rank = number.
    Heavy postings are handed on at once; only one of them per token and flush waits
    with the light ones for the rest of the bucket.
    """

    def unpack(data, docs, told):
        postings_ = np.frombuffer(data, POSTING)
        rows = np.empty(len(postings_), ROW)
        rows["token"], rows["rank"], rows["told"] = postings_["token"], postings_["rank"], told
        rows["doc"], rows["n"] = docs["doc"][postings_["ref"]], docs["n"][postings_["ref"]]
        return rows

    def told_rows(kind, bucket, rows):
        if kind == 0:
            token = np.int64(bucket) << np.int64(32) | rows["token"].astype(np.int64)
            return [0] * len(rows), np_array(token), np_array(rows["doc"]), np_array(rows["n"]), np_array(rows["rank"])
        ids, place, counts = np.unique(rows["doc"], return_index=True, return_counts=True)
        return [1] * len(ids), pa.nulls(len(ids), pa.int64()), np_array(ids), np_array(rows["n"][place]), np_array(counts)

    def close(kind, bucket, held):
        rows = np.concatenate(held)
        rows = rows[np.argsort(rows["token"], kind="stable")]
        begins = np.flatnonzero(np.r_[True, rows["token"][1:] != rows["token"][:-1]])
        counts = np.diff(np.r_[begins, len(rows)])
        rows = rows[np.repeat(counts >= 2, counts) & ~rows["told"]]
        return told_rows(kind, bucket, rows)

    def share(parts):
        at, held = None, []
        for part in parts:
            columns = [part.column(c).to_pylist() for c in ("kind", "bucket", "docs", "light", "heavy")]
            for kind, bucket, docs, light, heavy in zip(*columns):
                if at is not None and at != (kind, bucket):
                    yield close(*at, held)
                    held = []
                at, docs = (kind, bucket), np.frombuffer(docs, DOC)
                held.append(unpack(light, docs, False))
                if heavy:
                    rows = unpack(heavy, docs, True)
                    yield told_rows(kind, bucket, rows)
                    held.append(rows[np.r_[True, rows["token"][1:] != rows["token"][:-1]]])
        if held:
            yield close(*at, held)

    dealt = packed.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    return map_slices(dealt, share, "kind int, token long, doc_id long, n long, rank long")


def feasible(a: str, b: str) -> Column:
    """Whether two postings of one token, with prefixes a and b of column names, can be a pair's first shared token."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    o = F.expr(f"({PERCENT} * ({a}n + {b}n) + {99 + PERCENT}) div {100 + PERCENT}")
    least = F.greatest(F.lit(1), *[F.least(o - F.expr(f"({PERCENT} * {a}n + 99) div 100") + 1, o - F.expr(f"({PERCENT} * {b}n + 99) div 100") + 1)])
    return (
        (F.col(f"{a}doc_id") != F.col(f"{b}doc_id"))
        & (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb))
        & (1 + F.least(na - 1 - F.col(f"{a}rank"), nb - 1 - F.col(f"{b}rank")) >= o)
        & (F.least(f"{a}s0", f"{b}s0") >= least) & (F.least(f"{a}s1", f"{b}s1") >= least)
    )


FIELDS = ("doc_id", "n", "rank", "s0", "s1")


def pair() -> tuple:
    """Columns a and b of a frame of two sides, the smaller id first."""
    return F.least("x_doc_id", "y_doc_id").alias("a"), F.greatest("x_doc_id", "y_doc_id").alias("b")


def star_pairs(rows: DataFrame) -> DataFrame:
    """turn, a, b: each token's nodes paired with a pivot of the token; another pivot in each turn.

    Pivots and pairs use one shuffle of the rows by token.
    """
    dealt = rows.repartition("token")
    firsts = [F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", F.lit(turn)) for turn in range(STAR_ROUNDS)]
    pivots = dealt.groupBy("token").agg(*[F.min(F.struct(first.alias("first"), *FIELDS)).alias(f"p{t}") for t, first in enumerate(firsts)])
    sides = dealt.select("token", *[F.col(c).alias(f"x_{c}") for c in FIELDS]).join(pivots, "token")
    paired = sides.select("*", F.posexplode(F.array(*[f"p{t}" for t in range(STAR_ROUNDS)])).alias("turn", "pivot"))
    paired = paired.select("turn", *[f"x_{c}" for c in FIELDS], *[F.col(f"pivot.{c}").alias(f"y_{c}") for c in FIELDS])
    return paired.filter(feasible("x_", "y_")).groupBy(*pair()).agg(F.min("turn").alias("turn"))


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose documents aren't in one group yet."""
    for side in "ab":
        named = labels.select(F.col("node").alias(side), F.col("component").alias(f"group_{side}"))
        pairs = pairs.join(named, side, "left").withColumn(f"group_{side}", F.coalesce(f"group_{side}", side))
    return pairs.filter("group_a <> group_b").drop("group_a", "group_b")


def cross_pairs(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """a, b: all candidate pairs across groups; per token, nodes outside its largest group with all nodes."""
    placed = rows.join(reuse_keys(labels.withColumnRenamed("node", "doc_id")), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    dealt = placed.repartition("token")
    counts = dealt.groupBy("token", "comp").count()
    largest = counts.groupBy("token").agg(F.max(F.struct("count", "comp")).alias("most"), F.count("*").alias("groups"))
    mixed = largest.filter("groups > 1").select("token", F.col("most.comp").alias("major"))
    inside = written(dealt.join(mixed, "token"), "mixed-tokens")
    outside = inside.filter("comp <> major").select("token", *[F.col(c).alias(f"x_{c}") for c in (*FIELDS, "comp")])
    joined = outside.join(inside.select("token", *[F.col(c).alias(f"y_{c}") for c in (*FIELDS, "comp")]), "token")
    return joined.filter("x_comp <> y_comp").filter(feasible("x_", "y_")).select(*pair()).distinct()


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, found on the whole texts of both."""
    wanted = reuse_keys(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text")
    left = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = left.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def check(parts):
        known: tuple = (None, None, None)
        for part in parts:
            out_a, out_b = [], []
            columns = [part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")]
            for a, b, text_a, text_b in zip(*columns):
                if known[:2] != (a, text_a):
                    known = (a, text_a, shingles(text_a or ""))
                if linked(known[2], shingles(text_b or "")):
                    out_a.append(a)
                    out_b.append(b)
            yield out_a, out_b

    return map_slices(both.select("a", "b", "text_a", "text_b"), check, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    context = docs.sparkSession.sparkContext
    found = written(facts(docs), "shingle-facts")
    sets = found.filter("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), "c", "d")
    copies = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("c", "d").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    many = copies.filter("first <> last").select("c", "d", F.col("first").alias("a"))
    links = sets.filter("n > 0").join(many, ["c", "d"]).select("a", F.col("doc_id").alias("b")).filter("b IS NOT NULL")

    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(total * (100 - PERCENT) // 100 // BUCKET_POSTINGS) + 1)
    frequent = context.broadcast(frequent_tokens(found))
    shared = written(shared_tokens(postings(docs, frequent, buckets)), "shared-tokens")
    per_doc = shared.groupBy("doc_id").agg(
        F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).alias("s0"), F.sum(F.when(F.col("kind") == 1, F.col("rank")).otherwise(0)).alias("s1")
    ).filter("s0 > 0 AND s1 > 0")
    rows = written(shared.filter("kind = 0").drop("kind").join(reuse_keys(per_doc), "doc_id"), "candidate-tokens")

    # Between star rounds one step of smallest neighbours is enough: equal labels mean linked documents.
    labels = one_step(links)
    stars = written(star_pairs(rows), "star-pairs")
    for turn in range(STAR_ROUNDS):
        pairs = written(across(stars.filter(F.col("turn") == turn).select("a", "b"), labels), "pairs")
        links = links.unionByName(written(verified(docs, pairs), "links"))
        labels = one_step(links) if turn < STAR_ROUNDS - 1 else components(links)
    rest = written(cross_pairs(rows, labels).join(stars, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        stars = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
        labels = components(stars.unionByName(verified(docs, rest)))
    return sets.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_step(links: DataFrame) -> DataFrame:
    """node, component: every node under its smallest neighbour or itself."""
    ends = links.unionByName(links.select(F.col("a").alias("b"), F.col("a")))
    return ends.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))


def representatives(docs: DataFrame) -> DataFrame:
    """All columns and rows of ``docs`` but those of documents in a group with a smaller id.

    Documents without shingles or without ``doc_id`` stay, and rows that share a
    ``doc_id`` stay or go together.
    """
    gone = groups(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(reuse_keys(gone), "doc_id", "left_anti").select(*docs.columns)
