"""Phrases, token counts and the manifest against plain versions of their rules."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duskwork.llm import collocations, merkle, token_counts
from tests.llm.cases import SCHEMA, docs, rows, with_nulls

CLASHING = SCHEMA.replace("kept boolean", "print boolean").replace("component_id long", "count long")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def plain_phrases(made, least, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in made:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        longest = Counter()
        for phrase, times in f.items():
            if times >= least:
                for n in range(2, len(phrase)):
                    for i in range(len(phrase) - n + 1):
                        longest[phrase[i : i + n]] = max(longest[phrase[i : i + n]], times)
        found = []
        for phrase, a in f.items():
            if len(phrase) > 1 and a >= least and longest[phrase] < a:
                cuts = [(1000 * a * total[lang] // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(5)
    made = with_nulls(rows(many=25))
    words = [*"a b c d É ß \x00 x\x1cy".split(" "), "a" * 3000]
    for i in range(30):
        made.append((1000 + i, "".join(rng.choice(words) + rng.choice(["  ", " ", "\t", ". ", "\n", ";"] if i % 3 else [" "]) for _ in range(150)), [None, "und", "en", "fr"][i % 4], None, None))
    made.append((2000, "run on " * 20_000, "de", "s", 1))
    return made


@pytest.mark.parametrize(("segment", "held"), [(1 << 20, 1 << 20), (97, 50)])
def test_phrases_against_plain_counting(spark, monkeypatch, segment, held):
    monkeypatch.setattr(collocations, "SEGMENT", segment)
    monkeypatch.setattr(collocations, "HELD_PHRASES", held)
    monkeypatch.setattr(collocations, "BUCKET_PHRASES", held)
    made = [r for r in phrase_rows() if segment > 97 or len(r[1] or "") < 50_000]
    got = collocations.ranked(docs(spark, made), least=4, top=50)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(map(tuple, got.collect()))
    assert found == plain_phrases(made, 4, 50) and len({r[0] for r in found}) >= 3


def test_phrases_first_occurrence(spark):
    made = [(7, "x y. go on then", "en", None, 0), (3, "no. we GO on\nthen go on", "en", None, 0), (None, "go on", "en", None, 0)]
    found = {r.phrase: r for r in collocations.collocations(docs(spark, made), least=3).collect()}
    assert (found["go on"].a, found["go on"].doc_id, found["go on"].place) == (4, 3, 2)
    assert set(found) == {"go on"}


def test_phrases_of_nothing_and_clashing_columns(spark):
    assert collocations.ranked(docs(spark, [])).collect() == []
    assert collocations.ranked(docs(spark, [(1, None, None, None, None), (2, " .", "en", "s", 1)])).collect() == []
    made = [(*r, True, 5) for r in phrase_rows()[:40]]
    clash = spark.createDataFrame(made, CLASHING)
    assert sorted(map(tuple, collocations.ranked(clash, 3, 9).collect())) == plain_phrases(made, 3, 9)


def block_of(*texts):
    return next(iter(collocations.blocks([_Part(texts)], 1 << 20)))[0]


class _Part:
    def __init__(self, texts):
        self.data = {"doc_id": list(range(len(texts))), "lang": ["en"] * len(texts), "text": list(texts)}

    def column(self, name):
        return self

    def __getattribute__(self, name):
        if name != "column":
            return object.__getattribute__(self, name)
        data = object.__getattribute__(self, "data")
        return lambda c: type("Column", (), {"to_pylist": lambda _: data[c]})()


def test_colliding_fingerprints_are_told_apart_by_text():
    words = block_of("aa bb aa bb cc dd", "cc dd aa bb")
    plain = collocations.word_ids(words)
    words.prints[:] = 7
    ids = collocations.word_ids(words)
    assert [[a == b for b in ids] for a in ids] == [[a == b for b in plain] for a in plain]
    words.__dict__.pop("prefix", None)
    at = np.flatnonzero(words.piece[:-1] == words.piece[1:])
    found = Counter()
    kept = collocations.Phrases()
    own = kept.numbered(words, ids, np.arange(len(ids)))
    for prints, first, times in collocations.verified(words, at, 2, ids):
        assert len(set(prints)) == 1
        for pointer, n in zip(first.tolist(), times.tolist()):
            found[words.phrase(pointer, 2)] += n
        rows_made = np.full((len(first), kept.WIDTH), -1, np.int64)
        rows_made[:, 0], rows_made[:, 1] = own[ids[first]], own[ids[first + 1]]
        rows_made[:, 5:] = np.stack([0 * first, 0 * first, 9 - first, first], axis=1)
        kept.langs["en"] = 0
        kept.add(prints, rows_made, times)
        kept.add(prints, rows_made, times)
    assert found == {"aa bb": 3, "bb aa": 1, "bb cc": 1, "cc dd": 2, "dd aa": 1}
    langs, lengths, phrases, counts, ids, places = kept.columns()
    assert dict(zip(phrases, counts.tolist())) == {p: 2 * c for p, c in found.items()} and set(lengths) == {2} and set(langs) == {"en"}


def test_earlier_pointer():
    a = np.array([[0, 5, 9], [1, 0, 3], [0, 5, 1]])
    b = np.array([[0, 4, 10], [0, 7, 7], [0, 5, 2]])
    assert collocations.earlier(a, b).tolist() == [[0, 4, 10], [0, 7, 7], [0, 5, 1]]


def test_segments_cover_each_word_once():
    text = " .a b  cc\n" * 50 + "d" * 9000 + " e f g h i"
    for size in (1, 7, 64, 10_000):
        parts = list(collocations.segments(text.encode(), size))
        assert b"".join(own[:limit] for own, limit in parts).decode() == text
        assert sum(collocations.count_words(own[:limit]) for own, limit in parts) == len(re.findall(r"[^ .\n]+", text))


def test_bitmap_holds_every_fingerprint(spark):
    prints = [(i * 0x9E3779B97F4A7C15 + 11) % (1 << 64) - (1 << 63) for i in range(5000)]
    kept = collocations.bitmap(spark.createDataFrame([(p,) for p in prints], "print long"), len(prints), "bitmap")
    assert kept.has(np.array(prints, np.int64).view(np.uint64)).all()
    others = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert kept.has(others).mean() < 0.02


def test_scores_beyond_64_bits(spark):
    counts = [("en", 0, "", 4 * 10**13), ("en", 1, "a", 3 * 10**12), ("en", 1, "b", 2 * 10**12), ("en", 2, "a b", 10**12 + 7)]
    frame = spark.createDataFrame([(*c, 1, 1) for c in counts], "lang string, words int, phrase string, count long, doc_id long, place long")
    assert [r.score for r in collocations.scored(frame).collect()] == [1000 * (10**12 + 7) * 4 * 10**13 // (6 * 10**24)]


PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "It's 9<|endoftext|>9 Σας ΣΑΣ é 1́  x", "a1b2" * 3000, "don't we'll 's " * 2000, "é" * 5000 + "9" * 5000,
    "<|startoftext|>" * 700, "word　word​" * 900, "x" * 20_000, "1 ́" * 400, "\n\t\r\x0b \x1c" * 500, "日本語テキスト。" * 900,
]


def whole_counts(texts):
    own = Tokenizer.from_file(PATH)
    return [len(own.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize(("chars", "size"), [(1, 64), (50, 1000), (1 << 16, 1 << 18)])
def test_token_counts_of_cut_texts(monkeypatch, chars, size):
    monkeypatch.setattr(token_counts, "PIECE_CHARS", chars)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", size)
    monkeypatch.setattr(token_counts, "KEPT_PARTS", chars)
    own = token_counts.Counter(PATH)
    for _ in range(2):
        assert own.cuts and own.counts(TEXTS) == whole_counts(TEXTS)
    assert all(len(part) <= token_counts.KEPT_CHARS for part in own.known)
    other = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(other)
    whole = token_counts.Counter(other)
    assert not whole.cuts
    assert whole.counts(TEXTS) == [len(plain.encode(t, add_special_tokens=False).ids) for t in TEXTS]


def test_token_counts_of_table(spark):
    made = [*with_nulls(rows()), *((300 + i, t, None, None, None) for i, t in enumerate(TEXTS)), (5000, "long text " * 150_000, "en", "s", 0)]
    got = token_counts.token_counts(docs(spark, made).withColumn("n_tokens", F.lit("clash")))
    expected = [(r[0], len((r[1] or "").encode()), n, n > 2048) for r, n in zip(made, whole_counts([r[1] or "" for r in made]))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(docs(spark, [])).collect() == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def plain_tree(hashes):
    """Root, and for each leaf its (left, right) siblings from the leaf up."""
    ways, place = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, p in enumerate(place):
            start = p // 8 * 8
            ways[i].append(("".join(hashes[start:p]), "".join(hashes[p + 1 : start + 8])))
            place[i] = p // 8
        hashes = [sha("".join(hashes[i : i + 8])) for i in range(0, len(hashes), 8)]
    return hashes[0], ways


def plain_manifest(made):
    groups = defaultdict(list)
    for r in made:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[name] = (ordered, *plain_tree([plain_leaf(*r) for r in ordered]))
    root, tops = plain_tree([trees[name][1] for name in names])
    out = []
    for name, top in zip(names, tops):
        ordered, subroot, ways = trees[name]
        for r, way in zip(ordered, ways):
            steps = way + top
            shown = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                shown = (r[0], lower(r[1]), *r[2:])
            folded = plain_leaf(*shown)
            for left, right in steps:
                folded = sha(left + folded + right)
            out.append((r[0], plain_leaf(*r), subroot, root, sha("".join(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=str)


def manifest_rows(sizes):
    made = []
    for lang, size in sizes.items():
        before = len(made)
        made += [((before + i) * 7 % 1009, f"Text {i}" if i % 3 else f"text é {i}", lang, f"s{i % 2}", i) for i in range(size)]
    return made


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 8}, {None: 9, "de": 1, "": 64}, {"en": 65, **{f"l{i}": i for i in range(1, 12)}, "É": 7}, {"en": 600, "fr": 73},
])
def test_manifest_against_plain_trees(spark, sizes):
    made = manifest_rows(sizes)
    got = merkle.verified(docs(spark, random.Random(2).sample(made, len(made))).repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == plain_manifest(made)


def test_manifest_of_messy_rows(spark):
    made = with_nulls(rows())
    made += [(None, None, None, None, None)] * 3 + [(4, "", None, None, 0), (2**63 - 1, "A", "zz", None, None), (-(2**63), "A", "zz", None, 5)]
    clash = docs(spark, made).withColumnRenamed("kept", "leaf").withColumnRenamed("component_id", "place").withColumn("tree", F.lit("x"))
    found = sorted(map(tuple, merkle.verified(clash).collect()), key=str)
    assert found == plain_manifest(made)
    assert {r[-1] for r in found} == {True, False}
    assert merkle.verified(docs(spark, [])).collect() == []


def test_manifest_proofs_show_any_change(spark):
    made = manifest_rows({"en": 20, "de": 3})
    frame = docs(spark, made)
    kept, root = merkle.manifest(frame)
    folded = kept.select(merkle.fold(F.col("leaf"), F.col("proof")).alias("f"), merkle.fold(F.lit(sha("other")), F.col("proof")).alias("g"))
    assert {tuple(r) for r in folded.select("f").distinct().collect()} == {(root,)}
    assert folded.filter(F.col("g") == root).count() == 0
    _, changed = merkle.manifest(frame.withColumn("source", F.when(F.col("doc_id") == 14, "s9").otherwise(F.col("source"))))
    assert changed != root
