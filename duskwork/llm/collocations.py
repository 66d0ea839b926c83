"""Phrases whose words come together more often than chance, by Rabin-Karp fingerprints.

A text is lower-cased (A-Z), cut into pieces at ``PIECE_ENDS`` and these into words at blanks. Per
language, phrases of two to ``LONGEST`` words seen at least ``LEAST`` times are scored
against the counts of their two parts.

Numpy prefix polynomials fingerprint every word (over its bytes) and from these every
n-gram (over its words): a difference of two prefix values, scaled back, is the value of
the stretch between. Counting goes from one length to the next: only an n-gram whose two
(n-1)-grams were frequent can be frequent, so only these are shuffled, as fingerprint and
count, added up in the task first. Which fingerprints were frequent is told to the next
pass by a bitmap of at most ``MOST_BITS`` bits. A collision, there or in a fingerprint, can
only let an n-gram through, never lose one.

Counts from fingerprints only choose. The last pass materialises the words of the
chosen n-grams alone: each task holds words, count and an occurrence pointer per
fingerprint, compares every other occurrence with them word by word, and keeps what
differs as a phrase of its own; pointers and counts then meet by language and text. So
counts are those of texts.

Long texts are cut into segments of about ``SEGMENT`` bytes that also see the next words
up to the longest phrase, so phrases across a cut count once and memory stays bounded.
Null text counts as empty, a null language as ``und``; repeated rows all count. A language
with few or no phrases has few or no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwork.llm.frames import arrow_schema, map_slices, written

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANG = "und"
PIECE_ENDS = ".,;:!?\n\v\f\r"
BLANKS = " \t"
SEGMENT = 1 << 20
# Distinct fingerprints (16 bytes each) or phrases (100 bytes each) a task adds up before it hands them on.
HELD_PRINTS = 1 << 20
HELD_PHRASES = 1 << 19
MOST_BITS = 1 << 28
# Phrases whose counts are brought together in one place.
BUCKET_PHRASES = 2_000
# Dealing languages to sub-groups before their best rows are ranked in one place.
SALTS = 64

WORD, BLANK, END = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[ord(c) for c in BLANKS]] = BLANK
KIND[[ord(c) for c in PIECE_ENDS]] = END
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1


_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least ``count`` of them; kept for the worker's next blocks."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        known = np.full(1 << max(16, (count - 1).bit_length()), base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.cumprod(known, dtype=np.uint64)
    return known


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def prefix_values(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix polynomial: entry i is the sum of ``values[j] * base**j`` for j < i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[: len(values)], out=out[1:])
    return out


def stretch(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Fingerprints of the stretches from ``starts`` to ``ends``, whatever their place."""
    return (prefix[ends] - prefix[starts]) * powers(pow(base, -1, 1 << 64), len(prefix))[starts]


@dataclass
class Words:
    """Words of some texts one after the other, and which of them may begin a phrase."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    prints: np.ndarray
    piece: np.ndarray
    owner: np.ndarray
    langs: list[str]
    salt: np.ndarray
    counted: np.ndarray

    def grams(self, n: int, chosen: np.ndarray) -> np.ndarray:
        """Fingerprints of the n-grams that begin at ``chosen`` words, told apart by language."""
        prefix = self.prefix
        return mixed(stretch(prefix, chosen, chosen + n, WORD_BASE) + self.salt[chosen] * np.uint64(n))

    @functools.cached_property
    def prefix(self) -> np.ndarray:
        return prefix_values(self.prints, WORD_BASE)

    def phrase(self, at: int, n: int) -> str:
        return " ".join(self.text[s:e].tobytes().decode() for s, e in zip(self.starts[at : at + n], self.ends[at : at + n]))


def salt_of(lang: str) -> int:
    """A number for a language from its bytes."""
    value = 1
    for byte in lang.encode():
        value = (value * BYTE_BASE + byte + 1) & MASK
    return value | 1


def words_of(text: bytes, bounds: np.ndarray, limits: np.ndarray, langs: list[str]) -> Words:
    """Words of segments joined by line ends.

    ``bounds`` holds where each segment begins, ``limits`` from where on a word is only
    seen as the rest of a phrase.
    """
    low = LOWER[np.frombuffer(text, np.uint8)]
    kind = KIND[low]
    edge = np.diff((kind == WORD).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    prefix = prefix_values(low.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    prints = mixed(stretch(prefix, starts, ends, BYTE_BASE))
    owner = np.searchsorted(bounds, starts, side="right") - 1
    salts = np.array([salt_of(lang) for lang in langs], np.uint64)
    piece = np.searchsorted(np.flatnonzero(kind == END), starts)
    return Words(low, starts, ends, prints, piece, owner, langs, salts[owner], starts < limits[owner])


def segments(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """``text`` in segments of about ``size`` bytes with the next words behind, and how many bytes are the segment's own."""
    if len(text) <= size:
        yield text, len(text)
        return
    kind = KIND[np.frombuffer(text, np.uint8)]
    start = 0
    while start < len(text):
        cut = after_word(kind, start + size)
        end = cut
        for _ in range(LONGEST - 1):
            end = after_word(kind, end)
        yield text[start:end], cut - start
        start = cut


def after_word(kind: np.ndarray, at: int) -> int:
    """The end of the first word that ends behind ``at``, or of the text."""
    inside = False
    while at < len(kind):
        near = kind[at : at + 4096] == WORD
        if not inside:
            first = int(near.argmax())
            if not near[first]:
                at += len(near)
                continue
            at, inside, near = at + first, True, near[first:]
        stop = int(near.argmin())
        if not near[stop]:
            return at + stop
        at += len(near)
    return len(kind)


def blocks(parts, size: int) -> Iterator[tuple[Words, list, np.ndarray]]:
    """Words of a task's texts, about ``size`` bytes at a time, with doc_ids and word numbers before each segment."""
    held, total = [], 0
    for part in parts:
        ids, langs, texts = (part.column(c).to_pylist() for c in ("doc_id", "lang", "text"))
        for doc, lang, text in zip(ids, langs, texts):
            before = 0
            for own, limit in segments((text or "").encode(), size):
                if held and total + len(own) > size:
                    yield block(held)
                    held, total = [], 0
                held.append((own, limit, doc, NO_LANG if lang is None else lang, before))
                total += len(own) + 1
                before += count_words(own[:limit]) if limit < len(own) else 0
    if held:
        yield block(held)


def count_words(text: bytes) -> int:
    kind = KIND[np.frombuffer(text, np.uint8)] == WORD
    return int(kind[0]) + int(np.count_nonzero(kind[1:] & ~kind[:-1])) if len(kind) else 0


def block(held: list) -> tuple[Words, list, np.ndarray]:
    # By id, so that the first occurrence of a phrase is that of the smallest one.
    held = sorted(held, key=lambda h: (h[2] is None, h[2] or 0, h[4]))
    sizes = np.array([len(own) + 1 for own, *_ in held], np.int64)
    bounds = np.cumsum(sizes) - sizes
    limits = bounds + np.array([limit for _, limit, *_ in held], np.int64)
    words = words_of(b"\n".join(own for own, *_ in held), bounds, limits, [lang for *_, lang, _ in held])
    firsts = np.searchsorted(words.owner, np.arange(len(held)))
    numbers = np.array([before for *_, before in held], np.int64) - firsts
    return words, [doc for _, _, doc, _, _ in held], numbers


@dataclass
class Frequent:
    """Fingerprints that may be frequent, as a bitmap with two bits for each."""

    bits: np.ndarray

    def has(self, prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), bool)
        for at in places(prints, len(self.bits) * 8):
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def places(prints: np.ndarray, size: int) -> list[np.ndarray]:
    """The two bits of each fingerprint in a bitmap of ``size`` bits, a power of two."""
    mask = np.uint64(size - 1)
    return [(prints & mask).astype(np.int64), ((prints >> np.uint64(32)) & mask).astype(np.int64)]


def passing(words: Words, filters: list[Frequent]) -> Iterator[tuple[int, np.ndarray]]:
    """For n from 1 on: the words that begin an n-gram which may be frequent, as all its parts may."""
    at = np.arange(len(words.starts))
    for n, known in enumerate(filters, start=1):
        at = extended(words, at, n)
        at = at[known.has(words.grams(n, at))]
        yield n, at


def candidates(words: Words, filters: list[Frequent]) -> np.ndarray:
    """Words that begin an n-gram one word longer than the last filter's, whose parts may all be frequent."""
    at = np.arange(len(words.starts))
    for _, at in passing(words, filters):
        pass
    at = extended(words, at, len(filters) + 1)
    return at[words.counted[at]]


def extended(words: Words, at: np.ndarray, n: int) -> np.ndarray:
    """Those of ``at``, which begin (n-1)-grams that passed, whose next word begins one too and that stay in their piece."""
    if n == 1:
        return at
    passed = np.zeros(len(words.starts) + 1, bool)
    passed[at] = True
    at = at[passed[at + 1]]
    at = at[at + n <= len(words.starts)]
    return at[words.piece[at] == words.piece[at + n - 1]]


def counts_of(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in ascending order with the sum of their counts."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, np.int64)
    return prints[first], np.add.reduceat(counts, first) if len(prints) else counts


def gram_counts(docs: DataFrame, filters: list[Frequent]) -> DataFrame:
    """print, count: candidates one word longer than the last filter's, added up in each task before the shuffle."""
    size, n = SEGMENT, len(filters) + 1

    def count(parts):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for words, _, _ in blocks(parts, size):
            found, times = np.unique(words.grams(n, candidates(words, filters)), return_counts=True)
            held.append((found, times))
            total += len(found)
            if total >= HELD_PRINTS:
                held = [counts_of(*map(np.concatenate, zip(*held)))]
                total = len(held[0][0])
                if total >= HELD_PRINTS // 2:
                    yield held[0][0].view(np.int64), held[0][1]
                    held, total = [], 0
        if held:
            found, times = counts_of(*map(np.concatenate, zip(*held)))
            yield found.view(np.int64), times

    rows = map_slices(docs, count, "print long, count long")
    return rows.groupBy("print").agg(F.sum("count").alias("count"))


def bitmap(frequent: DataFrame, many: int, name: str) -> Frequent:
    """The bitmap of a written frame of ``many`` fingerprints: 128 bits or more for each of them, up to ``MOST_BITS``.

    Its parts are set in tasks; only they reach the driver, whatever the number of fingerprints.
    """
    size = min(MOST_BITS, 1 << max(16, (128 * many - 1).bit_length()))
    block_bits = min(size, 1 << 16)

    def bits(parts):
        for part in parts:
            prints = part.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(places(prints, size)))
            yield at // 64, (np.uint64(1) << (at % 64).astype(np.uint64)).view(np.int64)

    words = map_slices(frequent.select("print"), bits, "at long, bits long")
    joined = words.groupBy("at").agg(F.bit_or("bits").alias("bits")).groupBy(
        F.floor(F.col("at") * 64 / block_bits).cast("long").alias("block")
    ).agg(F.collect_list("at").alias("at"), F.collect_list("bits").alias("bits"))

    def packed(parts):
        for part in parts:
            blocks_found = part.column("block").to_pylist()
            data = []
            for number, ats, values in zip(blocks_found, part.column("at"), part.column("bits")):
                whole = np.zeros(block_bits // 64, np.int64)
                whole[np.array(ats.values, np.int64) - number * (block_bits // 64)] = np.array(values.values, np.int64)
                data.append(whole.tobytes())
            yield blocks_found, data

    out = np.zeros(size // 8, np.uint8)
    for row in written(map_slices(joined, packed, "block long, data binary"), name).toLocalIterator():
        out[row.block * (block_bits // 8) : (row.block + 1) * (block_bits // 8)] = np.frombuffer(row.data, np.uint8)
    return Frequent(out)


def verified(words: Words, at: np.ndarray, n: int, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fingerprint, first occurrence, number of occurrences) of each different phrase among the n-grams that begin at ``at``.

    Occurrences with one fingerprint are compared with the first of them, word by word
    in ``ids``; those that differ are taken again among themselves, as a further part.
    """
    prints = words.grams(n, at)
    while len(at):
        known, first, group, times = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        pointer = at[first][group]
        same = words.salt[at] == words.salt[pointer]
        for k in range(n):
            same &= ids[at + k] == ids[pointer + k]
        if not same.all():
            times = np.bincount(group[same], minlength=len(first))
        yield known, at[first], times
        at, prints = at[~same], prints[~same]


def word_ids(words: Words) -> np.ndarray:
    """A number per word that is the same for two words just if their texts are, checked byte by byte."""
    _, first, ids = np.unique(words.prints, return_index=True, return_inverse=True)
    lengths, other = words.ends - words.starts, first[ids]
    same = lengths == lengths[other]
    checked = np.flatnonzero(same)
    sizes = lengths[checked]
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    differ = words.text[inside + np.repeat(words.starts[checked], sizes)] != words.text[inside + np.repeat(words.starts[other[checked]], sizes)]
    if len(checked):
        same[checked] = ~np.logical_or.reduceat(differ, begin)
    extra: dict[str, int] = {}
    for at in np.flatnonzero(~same).tolist():
        ids[at] = len(first) + extra.setdefault(words.phrase(at, 1), len(extra))
    return ids


class Phrases:
    """The phrases a task has met: one row per fingerprint, with words, count and an occurrence pointer.

    Words are numbered once per task by their text, so two phrases are the same just if
    language and word numbers are. A phrase whose fingerprint belongs to another one
    already is kept by its text.
    """

    # Columns: words' numbers (-1 behind the last), language, pointer: without id, id, place.
    WIDTH = LONGEST + 4

    def __init__(self):
        self.names: list[bytes] = []
        self.numbers: dict[bytes, int] = {}
        self.langs: dict[str, int] = {}
        self.prints = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.rows = np.zeros((0, self.WIDTH), np.int64)
        self.others: dict[tuple, list] = {}

    def __len__(self) -> int:
        return len(self.prints) + len(self.others)

    def numbered(self, words: Words, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each id of a block that some of ``at`` has, the task's number of the word."""
        found, first = np.unique(ids[at], return_index=True)
        out = np.full(int(ids.max(initial=0)) + 1, -1, np.int64)
        numbers, text = self.numbers, words.text.tobytes()
        first = at[first]
        for i, start, end in zip(found.tolist(), words.starts[first].tolist(), words.ends[first].tolist()):
            name = text[start:end]
            number = numbers.get(name)
            if number is None:
                number = numbers[name] = len(self.names)
                self.names.append(name)
            out[i] = number
        return out

    def add(self, prints: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> None:
        """Take in distinct fingerprints in ascending order."""
        spot = np.searchsorted(self.prints, prints)
        spot[spot == len(self.prints)] = 0
        known = self.prints[spot] == prints if len(self.prints) else np.zeros(len(prints), bool)
        phrase = slice(0, LONGEST + 1)
        same = known.copy()
        same[known] = (self.rows[spot[known], phrase] == rows[known, phrase]).all(axis=1)
        hit = spot[same]
        self.counts[hit] += counts[same]
        self.rows[hit, LONGEST + 1 :] = earlier(self.rows[hit, LONGEST + 1 :], rows[same, LONGEST + 1 :])
        for i in np.flatnonzero(known & ~same).tolist():
            key = tuple(rows[i, phrase].tolist())
            kept = self.others.setdefault(key, [0, rows[i, LONGEST + 1 :]])
            kept[0] += int(counts[i])
            kept[1] = earlier(kept[1][None], rows[i, LONGEST + 1 :][None])[0]
        if not known.all():
            new = ~known
            every = np.concatenate([self.prints, prints[new]])
            order = np.argsort(every, kind="stable")
            self.prints = every[order]
            self.counts = np.concatenate([self.counts, counts[new]])[order]
            self.rows = np.concatenate([self.rows, rows[new]])[order]

    def columns(self) -> list:
        """lang, words, phrase, count, doc_id, place of all phrases."""
        rows, counts = self.rows, self.counts
        if self.others:
            rows = np.concatenate([rows, [[*key, *kept[1]] for key, kept in self.others.items()]])
            counts = np.concatenate([counts, [kept[0] for kept in self.others.values()]])
        names, langs = [name.decode() for name in self.names], list(self.langs)
        lengths = (rows[:, :LONGEST] >= 0).sum(axis=1)
        phrases = [" ".join([names[i] for i in row[:n]]) for row, n in zip(rows[:, :LONGEST].tolist(), lengths.tolist())]
        ids = [None if without else doc for without, doc in rows[:, LONGEST + 1 : LONGEST + 3].tolist()]
        return [[langs[i] for i in rows[:, LONGEST].tolist()], lengths, phrases, counts, ids, rows[:, -1]]


def earlier(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the smaller pointer; one without an id comes last."""
    less, equal = np.zeros(len(a), bool), np.ones(len(a), bool)
    for i in range(a.shape[1]):
        less |= equal & (b[:, i] < a[:, i])
        equal &= b[:, i] == a[:, i]
    return np.where(less[:, None], b, a)


PHRASE_ROW = "lang string, words int, phrase string, count long, doc_id long, place long"


def phrase_counts(docs: DataFrame, filters: list[Frequent], expected: int = 0) -> DataFrame:
    """lang, words, phrase, count, doc_id, place: frequent phrases of 1 to ``LONGEST`` words with an occurrence pointer.

    Rows of no words hold the number of all words of a language. A task hands its phrases on as
    Arrow blocks, one per hash bucket of ``BUCKET_PHRASES`` of the ``expected`` phrases; each
    bucket's blocks then meet in one task, which reads them one after the other.
    """
    size, most, buckets = SEGMENT, HELD_PHRASES, max(1, -(-expected // BUCKET_PHRASES))
    schema = arrow_schema(PHRASE_ROW)

    def collect(parts):
        totals: dict[str, int] = {}
        found = Phrases()
        for words, docs_held, numbers in blocks(parts, size):
            for owner, times in zip(*np.unique(words.owner[words.counted], return_counts=True)):
                totals[words.langs[owner]] = totals.get(words.langs[owner], 0) + int(times)
            take_in(found, words, docs_held, numbers)
            if len(found) >= most:
                yield dealt(found.columns())
                found = Phrases()
        if len(found):
            yield dealt(found.columns())
        if totals:
            none = [None] * len(totals)
            yield dealt([list(totals), [0] * len(totals), [""] * len(totals), list(totals.values()), none, none])

    def dealt(columns: list) -> list:
        bucket = np.array([zlib.crc32(f"{lang} {phrase}".encode()) % buckets for lang, phrase in zip(columns[0], columns[2])])
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        chosen = np.unique(bucket)
        return [chosen, [packed(batch.take(pa.array(np.flatnonzero(bucket == b)))) for b in chosen]]

    def take_in(found: Phrases, words: Words, docs_held: list, numbers: np.ndarray) -> None:
        if not filters or not len(words.starts):
            return
        ids = word_ids(words)
        langs = np.array([found.langs.setdefault(lang, len(found.langs)) for lang in words.langs])
        without = np.array([doc is None for doc in docs_held])
        docs_held = np.array([0 if doc is None else doc for doc in docs_held], np.int64)
        own = None
        for n, at in passing(words, filters):
            if own is None:
                own = found.numbered(words, ids, at)
            for prints, first, times in verified(words, at[words.counted[at]], n, ids):
                owner = words.owner[first]
                rows = np.full((len(first), Phrases.WIDTH), -1, np.int64)
                for k in range(n):
                    rows[:, k] = own[ids[first + k]]
                rows[:, LONGEST] = langs[owner]
                rows[:, LONGEST + 1] = without[owner]
                rows[:, LONGEST + 2] = docs_held[owner]
                rows[:, LONGEST + 3] = numbers[owner] + first
                found.add(prints, rows, times)

    def merge(parts):
        now, held = None, {}
        for part in parts:
            for bucket, data in zip(part.column("bucket").to_pylist(), part.column("block")):
                if bucket != now:
                    if held:
                        yield rows_of(held)
                    now, held = bucket, {}
                for lang, n, phrase, times, doc, place in zip(*(c.to_pylist() for c in unpacked(data.as_buffer()).columns)):
                    kept = held.get((lang, n, phrase))
                    # Rows without an id are pointed to only where there is no other.
                    pointer = (doc is None, doc or 0, place or 0)
                    if kept is None:
                        held[lang, n, phrase] = [times, pointer]
                    else:
                        kept[0] += times
                        kept[1] = min(kept[1], pointer)
        if held:
            yield rows_of(held)

    def rows_of(held: dict) -> list:
        keys, values = list(zip(*held)), list(held.values())
        return [*map(list, keys), [v[0] for v in values], [None if v[1][0] else v[1][1] for v in values], [v[1][2] for v in values]]

    blocks_of = map_slices(docs, collect, "bucket long, block binary")
    return map_slices(blocks_of.repartition("bucket").sortWithinPartitions("bucket"), merge, PHRASE_ROW)


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: pa.Buffer) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def collocations(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, a, l, r, n, score, doc_id, place: all phrases that are no part of an as frequent longer one.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` the words of the language;
    ``doc_id`` and ``place`` point to its first occurrence (word number in the text).
    """
    rows = docs.select(docs["doc_id"].cast("long"), docs["lang"].cast("string"), docs["text"])
    filters: list[Frequent] = []
    expected = 0
    while len(filters) < LONGEST:
        frequent = written(gram_counts(rows, filters).filter(F.col("count") >= least), f"grams-{len(filters) + 1}")
        many = frequent.count()
        if not many:
            break
        expected += many
        filters.append(bitmap(frequent, many, "bitmap"))
    counts = written(phrase_counts(rows, filters, expected).filter((F.col("words") == 0) | (F.col("count") >= least)), "phrases")
    return scored(counts)


def scored(counts: DataFrame) -> DataFrame:
    """The phrases of :func:`phrase_counts` with the score of their weakest cut, without contained ones."""
    tokens = F.split("phrase", " ")

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(tokens, start, length), " ")

    long_ones = counts.filter("words > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    spots = long_ones.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)))
    inside = spots.groupBy("lang", part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("count").alias("longer"))
    phrases = counts.filter("words > 1").join(inside, ["lang", "phrase"], "left").filter("longer is null or longer < count")
    known = counts.filter("words > 0").select("lang", "phrase", "count")
    whole = counts.filter("words = 0").select("lang", F.col("count").alias("n"))
    cuts = phrases.join(whole, "lang").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", part(F.lit(1), F.col("cut"))).withColumn("right", part(F.col("cut") + 1, F.col("words") - F.col("cut")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("count").alias(name)), ["lang", side])
    # Products may pass 64 bits: decimals of 38 digits, divided without remainder.
    big = "decimal(38,0)"
    score = F.expr(f"cast(cast(1000 * cast(count as decimal(20,0)) as {big}) * n as {big}) div cast(cast(l as decimal(19,0)) * r as {big})")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("weakest")
    best = cuts.groupBy("lang", "phrase").agg(weakest, F.first("count").alias("a"), F.first("n").alias("n"), F.first("doc_id").alias("doc_id"), F.first("place").alias("place"))
    return best.select("lang", "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score", "doc_id", "place")


def ranked(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    Sub-groups of a language hand on their own best rows, so ranking one language takes ``SALTS * top`` rows at most.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = collocations(docs, least).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = rows.withColumn("near", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("near") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
