import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duskwork.llm import mixing, token_store
from tests.llm.cases import docs, rows, with_nulls

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=2500), max_size=5))
def test_shards_round_trip(documents):
    made = [np.array(d, np.uint32) for d in documents]
    shard = token_store.Shard(token_store.encode_shard(made))
    assert [d.tolist() for d in shard.documents()] == documents
    assert [shard.document(k).tolist() for k in range(len(made))] == documents


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1é '.,\n\t\r\x1c\x85\xa0 <|>_", max_size=40) | st.just("x <|endoftext|> y"))
def test_pieces_encode_like_the_whole(text):
    plain = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids if "endof" in text else SHARED.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_store.encoder(PATH).encode(text), "<u4").tolist() == plain


SHARED = Tokenizer.from_file(PATH)


def test_token_store_against_plain_encoding(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 900)
    made = with_nulls(rows())
    ordered = sorted(made, key=lambda r: (r[0] is None, r[0] or 0))
    got = sorted((tuple(r) for r in token_store.read_documents(token_store.write_shards(docs(spark, made))).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [r[0] for r in ordered]
    sums = {}
    for r in made:
        ids = np.array([*SHARED.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        sums.setdefault(r[0], []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for doc, start, n, crc in got:
        assert start == at and (n, crc) in sums[doc]
        at += n
    assert token_store.read_documents(token_store.write_shards(docs(spark, []))).count() == 0


def test_mixing_reaches_target_weights_and_keeps_columns(spark):
    made = [(i, f"t{i}", "en", "big" if i % 10 else "small", i) for i in range(4000)] + [(None, None, None, None, None)]
    frame = docs(spark, made)
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    got = mixing.mixed(frame, weights, total=4000)
    sizes = {r[0]: r[1] for r in got.groupBy("source").count().collect()}
    assert set(sizes) == {"big", "small"} and all(abs(n - 2000) < 250 for n in sizes.values())
    assert got.columns == [*frame.columns, "copy", "position"]
    again = mixing.mixed(frame, weights, total=4000)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    heavy = mixing.mixed(frame.where("doc_id < 20"), weights, total=4000).groupBy("source").count().collect()
    assert all(abs(r[1] - 2000) < 300 for r in heavy)  # rates of a hundred and a thousand
    assert mixing.mixed(frame.limit(0)).count() == 0


def test_encoding_with_a_small_cache(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_BYTES", 2000)
    monkeypatch.setattr(token_store, "KEPT_CHARS", 6)
    monkeypatch.setattr(token_store, "LEARN_CHARS", 20)
    own = token_store.Encoder(PATH)
    texts = ["", "a word " * 50, "x" * 5000 + " longer-than-kept words", "one <|endoftext|> more", *(f"w{i} v{i % 7}  u{i}" for i in range(300))]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode_all(texts)] == [
            SHARED.encode(t, add_special_tokens=False).ids for t in texts]
        assert own.held <= 1000 + 220 * 40 and all(len(piece) <= 6 for piece in {*own.known, *own.before})


class Counting:
    """A tokenizer that notes the pieces it is given."""

    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, given, is_pretokenized=False, **rest):
        self.seen += [piece for group in given for piece in group] if is_pretokenized else given
        return self.tokenizer.encode_batch_fast(given, is_pretokenized=is_pretokenized, **rest)


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    own, seen = token_store.Encoder(PATH), []
    for name in ("tokenizer", "words"):
        if hasattr(own, name):
            monkeypatch.setattr(own, name, Counting(getattr(own, name), seen))
    texts = [f"so{before}houseé{mark} then" for before in (" ", "\n") for mark in ("", ".", ",", "...", "!?", ")", "'s")]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode_all(texts)] == [
            SHARED.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(piece for piece in seen if "house" in piece) == [" houseé", "houseé"]


def test_kept_pieces_take_few_bytes():
    own = token_store.Encoder(PATH)
    own.encode_all([" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(676))])
    assert len(list(own.known)) > 600 and own.held < 60 * len(list(own.known))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab1éñ×÷中 '.,\n\t\r\x0b\x00\x1c\x7f\x85\xa0\u0301\u180e\u2003\u200b\u2019\u3000\ufeff<|>", max_size=20), max_size=6))
def test_texts_encoded_together_are_those_encoded_alone(texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in token_store.encoder(PATH).encode_all(texts)] == [
        SHARED.encode(t, add_special_tokens=False).ids for t in texts]
