"""Exact duplicates by Patricia tries over whole texts.

Tasks first fold equal texts of their own rows, then texts are dealt out by
(length, content hash), so a group of copies arrives as a few rows per task
however many rows it has. Each partition is sorted by bytes and inserted, whole
byte strings, into a compressed radix trie whose terminal nodes hold the owner
and the number of rows. Sorted input means every subtree left of the current path
is complete: when the trie exceeds its budget those subtrees are handed out and
dropped (Spark's external sort does the spilling to disk), so memory is bounded by
the budget plus one path.

Nulls count as empty text. Rows without ``doc_id`` never own a group unless no row
of it has one; then ``keep_id`` is null and they all stay. Rows that repeat both id
and text are the same document: they stay or go together. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import map_slices, texts_of

FOLD_BYTES = 16 << 20
TRIE_BYTES = 32 << 20
OUT_ROWS = 4096


def normal_bytes(text: str) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and nothing else changed."""
    return text.encode("utf-8").lower()


class Node:
    __slots__ = ("label", "children", "entry")

    def __init__(self, label: bytes, entry=None):
        self.label, self.entry = label, entry
        self.children: dict[int, Node] = {}


def shared_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of ``a`` and ``b[start:]``, by halving."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Compressed radix trie; terminal nodes hold ``[key facts, owner, rows]``."""

    def __init__(self, better):
        self.better, self.root, self.bytes = better, Node(b""), 0

    def insert(self, key: bytes, facts, owner: int | None, rows: int) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                if node.entry is None:
                    node.entry = [facts, owner, rows]
                else:
                    node.entry[1] = self.better(node.entry[1], owner)
                    node.entry[2] += rows
                return
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], [facts, owner, rows])
                self.bytes += len(key) - at + 200
                return
            same = shared_prefix(child.label, key, at)
            if same < len(child.label):
                middle = Node(child.label[:same])
                child.label = child.label[same:]
                middle.children[child.label[0]] = child
                node.children[key[at]] = middle
                child = middle
                self.bytes += 200
            node, at = child, at + same

    def spill(self, last: bytes | None = None) -> Iterator[list]:
        """Hand out and drop all subtrees off the path of ``last`` (all of them for None)."""
        node, at = self.root, 0
        while node is not None:
            onward = None if last is None or at >= len(last) else node.children.get(last[at])
            for first, child in list(node.children.items()):
                if child is not onward:
                    yield from entries(child)
                    del node.children[first]
            if onward is None:
                break
            node, at = onward, at + len(onward.label)
        if last is None:
            if self.root.entry is not None:
                yield self.root.entry
            self.root = Node(b"")
        self.bytes = 200 + len(last or b"")


def entries(top: Node) -> Iterator[list]:
    stack = [top]
    while stack:
        node = stack.pop()
        if node.entry is not None:
            yield node.entry
        stack.extend(node.children.values())


def larger(a, b):
    return b if a is None else a if b is None else max(a, b)


def smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


def exact_groups(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per distinct text: length, text_sha256, owner, group_size.

    ``keep`` says whether the largest or the smallest ``doc_id`` owns a group.
    """
    better = larger if keep == "largest" else smaller

    def fold(parts):
        held: dict[bytes, list] = {}
        size = 0
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                key = normal_bytes(text)
                entry = held.get(key)
                if entry is None:
                    held[key] = [doc_id, 1]
                    size += len(key)
                else:
                    entry[0], entry[1] = better(entry[0], doc_id), entry[1] + 1
            if size > FOLD_BYTES:
                yield folded(held)
                held, size = {}, 0
        if held:
            yield folded(held)

    def folded(held):
        keys = list(held)
        return (
            [len(k) for k in keys], [hashlib.sha256(k).hexdigest() for k in keys], keys,
            [held[k][0] for k in keys], [held[k][1] for k in keys],
        )

    def own(parts):
        trie, out = PatriciaTrie(better), []
        for part in parts:
            columns = [part.column(i).to_pylist() for i in range(5)]
            for length, digest, key, owner, rows in zip(*columns):
                trie.insert(key, (length, digest), owner, rows)
                if trie.bytes > TRIE_BYTES:
                    out.extend(trie.spill(key))
                if len(out) >= OUT_ROWS:
                    yield listed(out)
                    out = []
        out.extend(trie.spill())
        if out:
            yield listed(out)

    def listed(out):
        return [e[0][0] for e in out], [e[0][1] for e in out], [e[1] for e in out], [e[2] for e in out]

    texts = map_slices(
        docs.select("doc_id", "text"), fold,
        "length long, text_sha256 string, key binary, owner long, rows long",
    )
    dealt = texts.repartition("length", "text_sha256").sortWithinPartitions("key")
    return map_slices(dealt, own, "length long, text_sha256 string, owner long, group_size long")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, length and digest of every row's normalised text."""

    def digest(parts):
        for part in parts:
            keys = [normal_bytes(text) for text in texts_of(part)]
            yield part.column("doc_id"), [len(k) for k in keys], [hashlib.sha256(k).hexdigest() for k in keys]

    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), digest, "doc_id long, length long, text_sha256 string")


def exact_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Only ids and digests are joined; a hot group is split by adaptive execution,
    since its side of owners has one row per text.
    """
    owners = exact_groups(docs.select(F.col("doc_id").cast("long"), "text"), keep)
    return digests(docs).join(owners, ["length", "text_sha256"]).select(
        "doc_id", F.col("owner").alias("keep_id"), "group_size",
        F.col("doc_id").eqNullSafe(F.col("owner")).alias("kept"), "text_sha256",
    )
