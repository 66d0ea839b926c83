"""Repeated lines dropped by probing sharded minimal perfect hashes.

Hashes of distinct lines (128 bits) are counted with map-side combining; those of
lines found in two or more documents are dealt to shards by hash, and each shard
becomes one minimal perfect hash with three arrays behind it: a 64-bit fingerprint,
the number of documents and the smallest document holding the line. Documents then
probe the arrays: their line hashes travel, packed, to the shard, which streams by
the index row once and answers per document; lines themselves are never joined.
A shard that many documents probe is served by several tasks, each with its own copy
of the arrays (``PROBES`` lines each at most, by exact counts), so one line found in every
document is no hot task.

Null or empty text is one empty line. A row without ``doc_id`` counts as one more
document that sorts after all others; rows that share a ``doc_id`` are one document.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import map_slices, texts_of, written

# Rows without an id count as part of the document with the largest id there is.
NO_ID = (1 << 63) - 1
SHARD_KEYS = 50_000
# The list of shards is broadcast: 16 bytes each. Shards get larger beyond.
MOST_SHARDS = 1_000_000
PROBES = 400_000
FOLD_LINES = 200_000
PACK = np.dtype([("low", "<u8"), ("high", "<u8"), ("owner", "<i8"), ("docs", "<i8")])
BLANKS = b" \t\n\x0b\x0c\r"
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def line_keys(text: str) -> list[bytes]:
    """Key of every line: blanks stripped at both ends, A-Z lower-cased."""
    return [line.strip(BLANKS).lower() for line in text.encode("utf-8").split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    """At least ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8")) >= least)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash by levels of bit arrays; a key's slot is its rank.

    On each level a key that is alone at its position gets the bit; the others go
    to the next, smaller level. ``slots`` gives ranks, or -1 for keys no level holds.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [int(level.sum()) for level in levels]
        self.starts = np.concatenate([[0], np.cumsum(ones)]).astype(np.int64)
        self.ranks = [np.cumsum(level) - 1 for level in levels]

    @staticmethod
    def places(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(low ^ mix(high + seed)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray) -> PerfectHash:
        levels = []
        while len(low):
            size = max(64, 2 * len(low))
            at = cls.places(low, high, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = ~alone[at]
            low, high = low[rest], high[rest]
        return cls(levels)

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.full(len(low), -1, np.int64)
        left = np.arange(len(low))
        for k, level in enumerate(self.levels):
            if not len(left):
                break
            at = self.places(low[left], high[left], k, len(level))
            hit = level[at]
            out[left[hit]] = self.starts[k] + self.ranks[k][at[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(level) for level in self.levels], "<u4")
        return np.uint32(len(sizes)).tobytes() + sizes.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        count = int(np.frombuffer(data, "<u4", 1)[0])
        at, levels = 4 + 4 * count, []
        for size in np.frombuffer(data, "<u4", count, 4):
            used = (int(size) + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, used, at), count=int(size)).astype(bool))
            at += used
        return cls(levels)


class Index:
    """One shard: perfect hash, fingerprints, document counts and owners."""

    def __init__(self, hashes: PerfectHash, prints: np.ndarray, docs: np.ndarray, owners: np.ndarray):
        self.hashes, self.prints, self.docs, self.owners = hashes, prints, docs, owners

    @classmethod
    def build(cls, keys: np.ndarray) -> Index:
        hashes = PerfectHash.build(keys["low"], keys["high"])
        slot = hashes.slots(keys["low"], keys["high"])
        prints, docs, owners = np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<i8")
        prints[slot], owners[slot] = keys["high"], keys["owner"]
        docs[slot] = np.minimum(keys["docs"], (1 << 32) - 1)
        return cls(hashes, prints, docs, owners)

    def drops(self, low: np.ndarray, high: np.ndarray, doc: int) -> np.ndarray:
        """Which lines of ``doc`` another, smaller document owns."""
        if not len(self.prints):
            return np.zeros(len(low), bool)
        slot = self.hashes.slots(low, high)
        safe = np.maximum(slot, 0)
        return (slot >= 0) & (self.prints[safe] == high) & (self.docs[safe] >= 2) & (self.owners[safe] != doc)

    def dump(self) -> bytes:
        head = self.hashes.dump()
        return np.array([len(head), len(self.prints)], "<u8").tobytes() + head + self.prints.tobytes() + self.docs.tobytes() + self.owners.tobytes()

    @classmethod
    def load(cls, data: bytes) -> Index:
        head, count = (int(x) for x in np.frombuffer(data, "<u8", 2))
        at = 16 + head
        return cls(
            PerfectHash.load(data[16:at]), np.frombuffer(data, "<u8", count, at),
            np.frombuffer(data, "<u4", count, at + 8 * count), np.frombuffer(data, "<i8", count, at + 12 * count),
        )


def hashes_of(keys: list[bytes], least: int) -> np.ndarray:
    """Distinct 128-bit hashes of the keys that are long enough: rows (low, high)."""
    found = {xxhash.xxh3_128_digest(k) for k in set(keys) if long_enough(k, least)}
    return np.frombuffer(b"".join(sorted(found)), "<u8").reshape(-1, 2)


def line_counts(docs: DataFrame, least: int) -> DataFrame:
    """low, high, docs, owner of the lines found in two or more documents."""

    def count(parts):
        held: dict[bytes, list] = {}
        for part in parts:
            for doc, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                for digest in {xxhash.xxh3_128_digest(k) for k in set(line_keys(text)) if long_enough(k, least)}:
                    entry = held.get(digest)
                    if entry is None:
                        held[digest] = [doc, doc, 1]
                    else:
                        entry[0], entry[1], entry[2] = min(entry[0], doc), max(entry[1], doc), entry[2] + 1
            if len(held) > FOLD_LINES:
                yield counted(held)
                held = {}
        if held:
            yield counted(held)

    def counted(held):
        pairs = np.frombuffer(b"".join(held), "<i8").reshape(-1, 2)
        facts = np.array(list(held.values()), np.int64)
        return [pa.array(np.ascontiguousarray(x)) for x in (pairs[:, 0], pairs[:, 1], facts[:, 0], facts[:, 1], facts[:, 2])]

    # Smallest and largest document differ exactly when there are two or more.
    return (
        map_slices(docs, count, "low long, high long, first long, last long, rows long")
        .groupBy("low", "high").agg(F.min("first").alias("owner"), F.max("last").alias("last"), F.sum("rows").alias("docs"))
        .filter("owner <> last").drop("last")
    )


def shard_of(low, shards: int):
    return F.pmod(F.col(low), F.lit(shards))


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """shard, index (bytes), served: one row per shard that has lines.

    A shard gets about ``SHARD_KEYS`` distinct lines whatever the size of the input.
    """

    def build(parts):
        shard, held = None, []

        def made():
            keys = np.concatenate(held)
            return [shard], [Index.build(keys).dump()], [int(keys["docs"].sum())]

        for part in parts:
            columns = {name: part.column(name).to_numpy() for name in ("shard", "low", "high", "owner", "docs")}
            cuts = np.flatnonzero(np.diff(columns["shard"])) + 1
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, part.num_rows]):
                if shard is not None and columns["shard"][start] != shard:
                    yield made()
                    held = []
                shard = int(columns["shard"][start])
                keys = np.empty(end - start, PACK)
                for name in PACK.names:
                    keys[name] = columns[name][start:end].view(PACK[name])
                held.append(keys)
        if held:
            yield made()

    dealt = lines.select(shard_of("low", shards).alias("shard"), "low", "high", "owner", "docs").repartition("shard").sortWithinPartitions("shard")
    return map_slices(dealt, build, "shard long, index binary, served long")


def probes(docs: DataFrame, shards: int, least: int) -> DataFrame:
    """doc_id, shard, hashes: each document's line hashes, packed by shard."""

    def probe(parts):
        for part in parts:
            ids, places, packed = [], [], []
            for doc, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                pairs = hashes_of(line_keys(text), least)
                if not len(pairs):
                    continue
                shard = np.mod(pairs[:, 0].view("<i8"), shards)
                order = np.argsort(shard, kind="stable")
                shard, pairs = shard[order], pairs[order]
                cuts = np.flatnonzero(np.diff(shard)) + 1
                for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(shard)]):
                    ids.append(doc)
                    places.append(int(shard[start]))
                    packed.append(pairs[start:end].tobytes())
            yield ids, places, packed

    return map_slices(docs, probe, "doc_id long, shard long, hashes binary")


def answers(index: DataFrame, asked: DataFrame, least_copies: int) -> DataFrame:
    """doc_id, hashes: of every probed document, the lines that it loses.

    Index rows are repeated once for each ``PROBES`` lines known to ask the shard, and
    ``least_copies`` times at least (unique lines ask too, spread evenly over shards);
    documents spread over the copies by id. A task sorts its shard's index row before
    the probes and streams them past it.
    """
    copies = F.greatest(F.lit(least_copies), F.ceil(F.col("served") / PROBES)).cast("long")
    sizes = F.broadcast(index.select("shard", copies.alias("copies")))
    indexed = index.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"), F.lit(None).cast("long").alias("doc_id"), F.col("index").alias("data"))
    asking = asked.join(sizes, "shard").select("shard", F.pmod(F.xxhash64("doc_id"), F.col("copies")).alias("copy"), "doc_id", F.col("hashes").alias("data"))

    def answer(parts):
        index = None
        for part in parts:
            ids, lost = [], []
            for doc, data in zip(part.column("doc_id").to_pylist(), part.column("data").to_pylist()):
                if doc is None:
                    index = Index.load(data)
                    continue
                pairs = np.frombuffer(data, "<u8").reshape(-1, 2)
                gone = index.drops(pairs[:, 0], pairs[:, 1], doc)
                if gone.any():
                    ids.append(doc)
                    lost.append(pairs[gone].tobytes())
            yield ids, lost

    dealt = indexed.unionByName(asking).repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("doc_id").asc_nulls_first())
    return map_slices(dealt, answer, "doc_id long, hashes binary")


def deduplicated(docs: DataFrame, least: int = 10) -> DataFrame:
    """doc_id, text, n_lines, n_dropped: every row with its repeated lines left out.

    ``least`` is the number of code points from which a line's key counts.
    """
    given = docs["doc_id"].cast("long")
    docs = docs.select(F.coalesce(given, F.lit(NO_ID)).alias("doc_id"), docs["text"], given.isNull().alias("without"))
    lines = written(line_counts(docs, least), "lines")
    shards = min(MOST_SHARDS, max(1, -(-lines.count() // SHARD_KEYS)))
    index = written(build_index(lines, shards), "line-index")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lost = answers(index, probes(docs, shards, least), -(-2 * tasks // shards)).groupBy("doc_id").agg(F.collect_list("hashes").alias("hashes"))
    joined = docs.join(lost, "doc_id", "left")

    def drop(parts):
        for part in parts:
            kept, counts, gone = [], [], []
            for text, found in zip(texts_of(part), part.column("hashes").to_pylist()):
                lines = text.split("\n")
                counts.append(len(lines))
                if found:
                    packed = b"".join(found)
                    away = {packed[i : i + 16] for i in range(0, len(packed), 16)}
                    lines = [
                        line for line, key in zip(lines, line_keys(text))
                        if not (long_enough(key, least) and xxhash.xxh3_128_digest(key) in away)
                    ]
                gone.append(counts[-1] - len(lines))
                kept.append("\n".join(lines))
            ids = [None if without else doc for doc, without in zip(part.column("doc_id").to_pylist(), part.column("without").to_pylist())]
            yield ids, kept, counts, gone

    return map_slices(joined, drop, "doc_id long, text string, n_lines long, n_dropped long")
