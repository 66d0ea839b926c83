"""Benchmark passages in documents, by SimHash of item-sized windows.

A window has as many words as the item it is compared with (the whole text where
that is shorter). Its fingerprint is the 64-bit SimHash of its five-word shingles, weighted by their
letters. Fingerprints of items are indexed in eight blocks with all neighbours that
a block may have: within ``RADIUS`` bits some block differs by at most a share of it, so
none is missed. Candidates are verified by weighted Jaccard similarity of the shingles (sum of smaller
over sum of larger weights), which has to reach ``THRESHOLD``.

A window that shares no shingle with an item of its size has similarity 0 with all of them; it gets no
fingerprint, which changes nothing in the result. Items with fewer than five words,
empty or null ones match nothing, and neither do null or empty texts. Items are sent to the
tasks in blocks of at most ``ITEM_BYTES`` of text; each block is one pass over the documents.
Several rows of an item are compared each; repeated documents are all answered. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import pickle

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import map_slices, texts_of
from duskwork.llm.ngram_join import MULTIPLIERS, mix

WORDS = 5
THRESHOLD = 0.75
RADIUS = 23
BLOCKS = 8
ITEM_BYTES = 32 << 20
RUN = 8192
# ASCII letters and digits and all other characters' bytes make words; the rest divides them.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BITS = np.arange(64, dtype=np.uint64)


def shingle_arrays(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight (letters) of every five-word shingle, in order."""
    words = text.lower().encode("utf-8").translate(WORD_BYTES).split()
    last = len(words) - WORDS + 1
    if last < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    letters = np.fromiter(map(len, words), np.int64, len(words))
    total, weight = hashed[:last] * MULTIPLIERS[0], letters[:last].copy()
    for k in range(1, WORDS):
        total = total + hashed[k : last + k] * MULTIPLIERS[k]
        weight += letters[k : last + k]
    return mix(total), weight


def fingerprints(hashes: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` shingles."""
    signs = ((hashes[:, None] >> BITS) & np.uint64(1)).astype(np.int64) * 2 - 1
    sums = np.vstack([np.zeros((1, 64), np.int64), np.cumsum(signs * weights[:, None], axis=0)])
    votes = sums[size:] - sums[:-size]
    return ((votes > 0).astype(np.uint64) << BITS).sum(axis=1, dtype=np.uint64)


@functools.cache
def neighbours(bits: int, radius: int) -> np.ndarray:
    """All masks of ``bits`` bits with at most ``radius`` ones."""
    masks = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in itertools.combinations(range(bits), r)]
    return np.array(sorted(masks), np.uint64)


class HammingIndex:
    """Fingerprints found by blocks: exact for all within ``radius`` bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.prints, self.radius, self.blocks, self.bits = prints, radius, blocks, 64 // blocks
        masks = neighbours(self.bits, radius // blocks)
        self.tables = []
        for b in range(blocks):
            near = self.block(prints, b)[:, None] ^ masks
            order = np.argsort(near.ravel(), kind="stable")
            values = near.ravel()[order].astype(np.int64)
            starts = np.searchsorted(values, np.arange((1 << self.bits) + 1))
            self.tables.append((starts, np.repeat(np.arange(len(prints)), len(masks))[order]))

    def block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(b * self.bits)) & np.uint64((1 << self.bits) - 1)

    def search(self, queries: np.ndarray) -> list[tuple[int, int]]:
        """(query, print) numbers of all pairs within the radius."""
        found = []
        for q, query in enumerate(queries):
            near = [items[starts[v] : starts[v + 1]] for (starts, items), v in ((t, int(self.block(query, b))) for b, t in enumerate(self.tables))]
            candidates = np.unique(np.concatenate(near))
            away = np.bitwise_count(self.prints[candidates] ^ query)
            found.extend((q, int(c)) for c in candidates[away <= self.radius])
        return found


def similarity(a: dict[int, int], hashes: np.ndarray, weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of an item's shingle weights and a window's."""
    kinds, place = np.unique(hashes, return_inverse=True)
    sums = np.zeros(len(kinds), np.int64)
    np.add.at(sums, place, weights)
    both = sum(min(a[k], s) for k, s in zip(kinds.tolist(), sums.tolist()) if k in a)
    return both / (sum(a.values()) + int(sums.sum()) - both)


class Items:
    """One block of benchmark items, ready for search."""

    def __init__(self, rows: list[tuple[int, str]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.ids: dict[int, list[int]] = {}
        self.bags: dict[int, list[dict[int, int]]] = {}
        prints: dict[int, list[np.uint64]] = {}
        known, sizes = [], []
        for item, text in rows:
            hashes, weights = shingle_arrays(text or "")
            if not len(hashes):
                continue
            size, bag = len(hashes), {}
            for h, w in zip(hashes.tolist(), weights.tolist()):
                bag[h] = bag.get(h, 0) + w
            self.ids.setdefault(size, []).append(item)
            self.bags.setdefault(size, []).append(bag)
            prints.setdefault(size, []).append(fingerprints(hashes, weights, size)[0])
            known.append(np.unique(hashes))
            sizes.append(np.full(len(known[-1]), size))
        pairs = np.unique(np.rec.fromarrays([np.concatenate(known), np.concatenate(sizes)], names="hash,size")) if known else None
        self.hashes = pairs["hash"].copy() if known else np.zeros(0, np.uint64)
        self.sizes = pairs["size"].copy() if known else np.zeros(0, np.int64)
        self.indexes = {size: HammingIndex(np.array(p, np.uint64)) for size, p in prints.items()}

    def windows(self, hashes: np.ndarray):
        """(size, starts): windows that share a shingle with an item of that size."""
        first = np.searchsorted(self.hashes, hashes)
        hit = np.flatnonzero(self.hashes[np.minimum(first, len(self.hashes) - 1)] == hashes)
        wanted: dict[int, list[int]] = {}
        for place in hit.tolist():
            k = int(first[place])
            while k < len(self.hashes) and self.hashes[k] == hashes[place]:
                wanted.setdefault(int(self.sizes[k]), []).append(place)
                k += 1
        n = len(hashes)
        for size, places in wanted.items():
            width = min(size, n)
            mark = np.zeros(n + 1, np.int64)
            at = np.array(places)
            np.add.at(mark, np.maximum(at - width + 1, 0), 1)
            np.add.at(mark, np.minimum(at, n - width) + 1, -1)
            yield size, width, np.flatnonzero(np.cumsum(mark)[: n - width + 1])

    def find(self, text: str) -> list[tuple[int, float, int]]:
        """(item, best similarity, word where that window starts) of all items in a text."""
        if not len(self.hashes):
            return []
        hashes, weights = shingle_arrays(text)
        if not len(hashes):
            return []
        best: dict[int, tuple[float, int]] = {}
        for size, width, starts in self.windows(hashes):
            runs = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
            for run in (part for r in runs for part in np.array_split(r, -(-len(r) // RUN))):
                low, high = int(run[0]), int(run[-1]) + width
                for q, place in self.indexes[size].search(fingerprints(hashes[low:high], weights[low:high], width)):
                    start = low + q
                    value = similarity(self.bags[size][place], hashes[start : start + width], weights[start : start + width])
                    item = self.ids[size][place]
                    if value >= self.threshold and (-value, start) < (lambda b: (-b[0], b[1]))(best.get(item, (-1.0, 0))):
                        best[item] = (value, start)
        return sorted((item, value, start) for item, (value, start) in best.items())


def item_blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The items, a block of bounded size at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL AND item_id IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // ITEM_BYTES)) if size > ITEM_BYTES else 1
    return [
        lambda b=b: [tuple(r) for r in (rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)).collect()]
        for b in range(blocks)
    ]


@functools.lru_cache(maxsize=2)
def loaded(data: bytes) -> Items:
    return pickle.loads(data)


def best_of(found: list) -> list[tuple[int, float, int]]:
    """One finding per item, the most similar window, the first of equals; an item may have rows in several blocks."""
    best: dict[int, tuple[float, int]] = {}
    for item, value, start in found:
        if item not in best or (-value, start) < (-best[item][0], best[item][1]):
            best[item] = (value, start)
    return sorted((item, *kept) for item, kept in best.items())


FINDINGS = "doc_id long, contaminated boolean, n_items long, item_ids string, best_item long, best_similarity double, best_start long"


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, best_item, best_similarity, best_start for every row.

    ``item_ids`` are sorted and comma-joined; the best item is the most similar one,
    the smallest of equals.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    blocks = item_blocks(benchmark)
    # Each block's findings are added to the row, so a row is told from others of the same id, or of none.
    rows = docs.withColumn("found", F.lit("[]"))
    for number, block in enumerate(blocks, 1):
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(Items(block(), threshold)))

        def search(parts, shared=shared, last=number == len(blocks)):
            items = loaded(shared.value)
            for part in parts:
                texts = texts_of(part)
                found = [json.loads(f) + items.find(text) for f, text in zip(part.column("found").to_pylist(), texts)]
                if not last:
                    yield part.column("doc_id"), texts, list(map(json.dumps, found))
                    continue
                found = [best_of(f) for f in found]
                yield (
                    part.column("doc_id"), [bool(f) for f in found], [len(f) for f in found], [",".join(str(i) for i, _, _ in f) for f in found],
                    *map(list, zip(*[min(f, key=lambda x: (-x[1], x[0])) if f else (None, None, None) for f in found])),
                )

        rows = map_slices(rows, search, FINDINGS if number == len(blocks) else "doc_id long, text string, found string")
    return rows


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the rows that hold no benchmark item."""
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(Items(block(), threshold)))

        def free_of(shared):
            @F.pandas_udf("boolean")
            def free(texts: pd.Series) -> pd.Series:
                items = loaded(shared.value)
                return pd.Series([not items.find(text or "") for text in texts], dtype="bool")

            return free

        docs = docs.filter(free_of(shared)(docs["text"]))
    return docs
