"""Token ids in patched frame-of-reference blocks.

A shard is one byte string: header, document table, block index, blocks. Ids of
the shard's documents stand one after the other in blocks of ``BLOCK`` ids. A block
stores its minimum, the other ids minus that minimum packed at a width chosen by
percentile, and what doesn't fit that width as exceptions (place and high bits). The
index holds where each block begins, so a document is read without the others.

    header   magic "PFR1", documents, ids, blocks          4 x uint32
    table    documents + 1 id offsets                      uint32
    index    blocks + 1 byte offsets into the block area   uint32
    block    minimum uint32, width uint8, exceptions uint16, packed bits,
             exception places uint16, exception high parts uint32

Shards are rows of a Parquet table, so Spark's own commit protocol covers lost
executors and any store works. Documents are range-partitioned by ``doc_id`` (nulls
last, ties by text), tokenised where they arrive and streamed into shards; offsets
over all documents are running sums of one total per partition.

Null text counts as empty: just the end id. Repeated rows are all written.
Extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from duskwork.llm.frames import map_slices, texts_of, written

MAGIC = b"PFR1"
BLOCK = 1024
PERCENTILE = 0.9
SHARD_IDS = 1 << 16
END_ID = 2
# Bytes of pieces and their ids kept by a worker; longer pieces are never kept.
CACHE_BYTES = 32 << 20
KEPT_CHARS = 64
# Characters of new pieces encoded at once, and how many times as many of texts are looked up at once.
LEARN_CHARS = 1 << 16
LOOKUP_TIMES = 64
HEAD = struct.Struct("<IBH")


def pack_bits(values: np.ndarray, width: int) -> bytes:
    if width in (0, 8, 16):
        return values.astype(f"<u{width // 8}").tobytes() if width else b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data, count: int, width: int) -> np.ndarray:
    if width in (0, 8, 16):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32) if width else np.zeros(count, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    padded = np.zeros((count, 32), np.uint8)
    padded[:, :width] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u4").ravel()


def width_for(rest: np.ndarray) -> int:
    """Bits that hold ``PERCENTILE`` of the values, or all if that costs no more."""
    ordered = np.sort(rest)
    chosen = int(ordered[int(PERCENTILE * (len(rest) - 1))]).bit_length()
    most = int(ordered[-1]).bit_length()
    beyond = len(rest) - int(np.searchsorted(ordered, 1 << chosen)) if chosen < 32 else 0
    return chosen if len(rest) * chosen + 48 * beyond < len(rest) * most else most


def encode_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    width = width_for(rest)
    high = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
    places = np.flatnonzero(high)
    mask = np.uint32((1 << width) - 1)
    return (
        HEAD.pack(low, width, len(places)) + pack_bits(rest & mask, width)
        + places.astype("<u2").tobytes() + high[places].astype("<u4").tobytes()
    )


def decode_block(data, count: int) -> np.ndarray:
    low, width, exceptions = HEAD.unpack_from(data, 0)
    at = HEAD.size
    used = (count * width + 7) // 8
    rest = unpack_bits(data[at : at + used], count, width)
    at += used
    if exceptions:
        places = np.frombuffer(data, "<u2", exceptions, at)
        high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
        rest[places] |= high << np.uint32(width)
    return rest + np.uint32(low)


def encode_shard(documents: list[np.ndarray]) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    blocks = [encode_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
    head = MAGIC + struct.pack("<III", len(documents), len(ids), len(blocks))
    return head + offsets.astype("<u4").tobytes() + starts.astype("<u4").tobytes() + b"".join(blocks)


class Shard:
    """Reads documents of one shard by number."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        documents, self.size, blocks = struct.unpack_from("<III", data, 4)
        self.offsets = np.frombuffer(data, "<u4", documents + 1, 16).astype(np.int64)
        at = 16 + 4 * (documents + 1)
        self.starts = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
        self.blocks = memoryview(data)[at + 4 * (blocks + 1) :]

    def block(self, number: int) -> np.ndarray:
        return decode_block(self.blocks[self.starts[number] : self.starts[number + 1]], min(BLOCK, self.size - number * BLOCK))

    def document(self, number: int) -> np.ndarray:
        start, end = self.offsets[number], self.offsets[number + 1]
        first, last = start // BLOCK, -(-end // BLOCK)
        ids = np.concatenate([self.block(b) for b in range(first, last)]) if last > first else np.zeros(0, np.uint32)
        return ids[start - first * BLOCK : end - first * BLOCK]

    def documents(self):
        ids = np.concatenate([self.block(b) for b in range(len(self.starts) - 1)]) if self.size else np.zeros(0, np.uint32)
        for start, end in zip(self.offsets[:-1], self.offsets[1:]):
            yield ids[start:end]


class Pieces:
    """Pieces of text and their ids, in columns: about 40 bytes a piece."""

    def __init__(self):
        self.texts = pa.array([], pa.string())
        self.bounds = np.zeros(1, np.int64)
        self.ids = np.zeros(0, "<u4")

    def __iter__(self):
        return iter(self.texts.to_pylist())

    @property
    def held(self) -> int:
        return self.texts.nbytes + self.bounds.nbytes + self.ids.nbytes

    def find(self, wanted: pa.StringArray) -> np.ndarray:
        """The number of each wanted piece, -1 for those that aren't here."""
        numbers = np.full(len(wanted), -1)
        places = pc.index_in(self.texts, value_set=wanted).fill_null(-1).to_numpy()
        here = np.flatnonzero(places >= 0)
        numbers[places[here]] = here
        return numbers

    def add(self, texts: pa.StringArray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.texts = pa.concat_arrays([self.texts, texts])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])


# What a byte is for ``piece_starts``: bytes of other blanks and of controls are ODD.
ODD, SPACE, LINE, LETTER, MARK, OTHER = range(6)
BYTES = np.full(256, OTHER, np.uint8)
BYTES[:32], BYTES[127], BYTES[9:14], BYTES[32] = ODD, ODD, LINE, SPACE
for byte in range(33, 127):
    BYTES[byte] = LETTER if chr(byte).isalpha() else OTHER if chr(byte).isdigit() else MARK
# Blanks and controls beyond ASCII, and what some Unicode versions or regex dialects count as such.
ODD_BYTES = re.compile(
    rb"\xc2[\x80-\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2(?:\x80[\x80-\x8b\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80|\xef\xbb\xbf"
)
# What two bytes after each other mean, by 8 times the first one's kind plus the second one's.
CUT, BLANKS = 1, 2
PAIRS = np.zeros(64, np.uint8)
for solid in (LETTER, MARK, OTHER):
    PAIRS[[8 * solid + SPACE, 8 * solid + LINE, 8 * LINE + solid]] = CUT
PAIRS[8 * LETTER + MARK] = CUT
PAIRS[[8 * SPACE + SPACE, 8 * SPACE + LINE, 8 * LINE + SPACE, 8 * LINE + LINE]] = BLANKS


def piece_starts(text: bytes, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, that stand one after the other in ``text`` from ``starts`` on.

    The byte-level split has no look-behind, never crosses from a non-blank to a blank or
    from a letter to a mark, gives a word only a space before it, and keeps the last of
    several blanks before a non-blank apart. So a piece begins at an ASCII blank behind a
    non-blank, at a non-blank behind a line break or tab, at the last of several ASCII
    blanks before a non-blank, and at an ASCII mark behind a Latin letter. Nothing is cut
    next to other blanks and controls.
    """
    data = np.frombuffer(text, np.uint8)
    kinds = BYTES[data]
    accented = np.flatnonzero(data[:-1] == 0xC3) + 1
    kinds[accented[(data[accented] != 0x97) & (data[accented] != 0xB7)]] = LETTER
    for odd in ODD_BYTES.finditer(text):
        kinds[odd.start() : odd.end()] = ODD
    pairs = PAIRS[kinds[:-1] << 3 | kinds[1:]]
    cut = np.zeros(len(data) + 2, bool)
    cut[1 : len(data)] = pairs == CUT
    # A break behind an odd character may belong to it when nothing follows.
    strange = np.flatnonzero(kinds[:-1] == ODD)
    cut[strange[kinds[strange + 1] == LINE] + 2] = False
    last = np.flatnonzero(pairs == BLANKS) + 1
    last = last[last + 1 < len(data)]
    last = last[kinds[last + 1] >= LETTER]
    cut[last[~np.isin(last + 1, starts)]] = True
    cut[starts] = True
    return np.flatnonzero(cut[: len(data)])


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """A byte-level tokenizer with its results kept by piece.

    A text's ids are those of its pieces (``piece_starts``). Each distinct piece of a
    group of texts is looked up once and, if new, encoded once by the library. Texts
    holding an added token are encoded whole.
    """

    # Pieces that the byte-level split leaves whole, whatever its version of Unicode.
    WORD = r"\A ?[A-Za-zÀ-ÖØ-öø-ɏ]+\z"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # The same without the split, for words.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known, self.before = Pieces(), Pieces()
        # In byte-level vocabularies each character of a token stands for one byte.
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.lengths[number] = len(token)

    @property
    def held(self) -> int:
        return self.known.held

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian uint32."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; pieces of all of them are looked up and learnt together, up to some size."""
        out: list[bytes] = []
        for group in grouped(texts, LEARN_CHARS * LOOKUP_TIMES):
            out += self.encode_group(group)
        return out

    def encode_group(self, texts: list[str]) -> list[bytes]:
        if self.held > CACHE_BYTES // 2:
            # Pieces that come up again are taken over; the others go with the next change.
            self.before, self.known = self.known, Pieces()
        whole = [bool(self.added and self.added.search(t)) for t in texts]
        encoded = ["" if w else t for t, w in zip(texts, whole)]
        ids, bounds = self.joined(encoded)
        packed = ids.tobytes()
        return [
            self.plain(t) if w else packed[4 * start : 4 * end]
            for t, w, start, end in zip(texts, whole, bounds[:-1].tolist(), bounds[1:].tolist())
        ]

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each begin, with the end."""
        parts = [t.encode() for t in texts]
        places = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        data = b"".join(parts)
        if not data:
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        begin = piece_starts(data, places[places < len(data)])
        offsets = np.append(begin, len(data)).astype(np.int32)
        dealt = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        starts, sizes, pool = self.looked_up(dealt.dictionary)
        codes = dealt.indices.to_numpy()
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return pool[stretches(starts[codes], counts)], ends[np.searchsorted(begin, places)]

    def looked_up(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each distinct piece's ids begin, how many they are, and the ids."""
        starts, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        missing, pool, fresh, taken = np.arange(len(pieces)), [], 0, 0
        for kept in (self.known, self.before):
            numbers = kept.find(pieces.take(pa.array(missing)))
            found, numbers, missing = missing[numbers >= 0], numbers[numbers >= 0], missing[numbers < 0]
            starts[found] = taken + kept.bounds[numbers]
            sizes[found] = kept.bounds[numbers + 1] - kept.bounds[numbers]
            pool.append(kept.ids)
            taken += len(kept.ids)
            fresh = found
        unseen = pieces.take(pa.array(missing))
        word = pc.match_substring_regex(unseen, self.WORD).to_numpy(zero_copy_only=False)
        for places, learn in ((missing[word], self.learn_words), (missing[~word], self.learn)):
            at = 0
            for group in grouped(pieces.take(pa.array(places)).to_pylist(), LEARN_CHARS):
                counts, ids = learn(group)
                here = places[at : at + len(group)]
                sizes[here], starts[here] = counts, taken + np.cumsum(counts) - counts
                pool.append(ids)
                taken += len(ids)
                at += len(group)
        ids = np.concatenate(pool)
        fresh = np.concatenate([fresh, missing])
        fresh = fresh[pc.utf8_length(pieces.take(pa.array(fresh))).to_numpy() <= KEPT_CHARS]
        self.known.add(pieces.take(pa.array(fresh)), sizes[fresh], ids[stretches(starts[fresh], sizes[fresh])])
        return starts, sizes, ids

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and the ids of all."""
        found = [entry.ids for entry in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([len(ids) for ids in found], np.int64), np.concatenate([np.array(ids, "<u4") for ids in found])

    def learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words, encoded as one text and cut by byte lengths."""
        ids = np.array(self.words.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(w.encode()) for w in words])
        return np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1, prepend=0), ids


def grouped(texts: list[str], most: int):
    """``texts`` in order, in groups of about ``most`` characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def gathered(parts):
    """doc_ids and texts of slices, so many together as are looked up at once: short texts make small slices."""
    docs, texts, size = [], [], 0
    for part in parts:
        docs += part.column("doc_id").to_pylist()
        texts += (more := texts_of(part))
        size += sum(map(len, more))
        if size >= LEARN_CHARS * LOOKUP_TIMES:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shards(docs: DataFrame, path: str | None = None) -> DataFrame:
    """part, shard, inside, size, doc_ids, data: the written token shards, in ascending order of doc_id.

    (part, shard) is the order of the shards, ``inside`` the number of ids before a shard
    in its part, ``size`` its own number; ``doc_ids`` lists a shard's documents.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def encode(parts):
        own, number = encoder(path), 0
        part_id, end = TaskContext.get().partitionId(), np.uint32(END_ID).tobytes()
        ids, held, size, inside = [], [], 0, 0
        for docs, texts in gathered(parts):
            for doc, packed in zip(docs, own.encode_all(texts)):
                tokens = np.frombuffer(packed + end, "<u4")
                ids.append(doc)
                held.append(tokens)
                size += len(tokens)
                if size >= SHARD_IDS:
                    yield [part_id], [number], [inside], [size], [ids], [encode_shard(held)]
                    ids, held, size, inside, number = [], [], 0, inside + size, number + 1
        if held:
            yield [part_id], [number], [inside], [size], [ids], [encode_shard(held)]

    # Ties are dealt by content, so a repeated id is no hot range.
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc(), F.col("text").asc_nulls_first()]
    dealt = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).drop("tie")
    return written(map_slices(dealt, encode, "part long, shard long, inside long, size long, doc_ids array<long>, data binary"), "tokens")


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shards.

    Only the sums of parts are broadcast, one row per task that wrote.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = shards.groupBy("part").agg(F.sum("size").alias("size"))
    bases = totals.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("inside")).alias("begin"), "doc_ids", "data")

    def decode(parts):
        for part in parts:
            rows = zip(part.column("begin").to_pylist(), part.column("doc_ids").to_pylist(), part.column("data").to_pylist())
            for begin, ids, data in rows:
                starts, counts, sums = [], [], []
                for tokens in Shard(data).documents():
                    starts.append(begin)
                    counts.append(len(tokens))
                    sums.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                    begin += len(tokens)
                yield ids, starts, counts, sums

    return map_slices(placed, decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
