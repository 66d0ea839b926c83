import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskwork.llm import chat_format, decontamination, license_scan, pii, toxicity
from tests.llm.cases import docs, rows, sentence, with_nulls


def brute_base(text):
    spans = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in pii.CARD.finditer(text) if 13 <= sum(c.isdigit() for c in m.group()) <= 19 and pii.luhn("".join(filter(str.isdigit, m.group())))]
    return spans + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_base_patterns_against_the_plain_ones():
    rng = random.Random(2)
    parts = ["a.b@c.de", "x@y", "@@a@b.c", "a@b.c@d.e", "1.2.3.4", "001.255.0.256", "300.1.1.1.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (314) 555-6532", "+12", "é@ß.de", "a%+-_@x-y.z", " ", "\n", "12", ".", "+"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == brute_base(text), text


def test_reconciling_takes_the_best_set():
    spans = [("ip", 0, 10, 0.9), ("card", 5, 12, 0.99), ("phone", 12, 20, 0.98)]
    assert pii.reconciled(spans) == [("ip", 0, 10), ("phone", 12, 20)]
    assert pii.joined([("ip", 0, 6, 0.9, True), ("ip", 4, 9, 0.8, True)]) == [("ip", 0, 9, 0.9)]


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(1)
    windows = [sentence(rng, 4) + " " + rng.choice(["a.bc12@host.com", "10.2.33.4", "+1 (314) 555-6532", "4111 1111 1111 1111", "in 1999"]) + " " + sentence(rng, 4) for _ in range(pii.SAMPLE_WINDOWS)]
    return pii.trained(windows)


def test_gradient_matches_differences():
    tagger, texts = pii.Tagger(), ["ab 12@c", "x"]
    symbols, lengths = pii.encoded(texts)
    gold = np.zeros(symbols.shape, np.int64)
    gold[3:5, 0] = [1, 2]

    def loss():
        e, _ = tagger.emissions(symbols, lengths)
        trans, start = tagger.scores()
        path = 0.0
        for k, n in enumerate(lengths):
            path += start[gold[0, k]] + sum(e[t, k, gold[t, k]] for t in range(n)) + sum(trans[gold[t - 1, k], gold[t, k]] for t in range(1, n))
        return (tagger.marginals(e, lengths)[0].sum() - path) / len(lengths)

    grads = tagger.gradient(symbols, lengths, gold)
    for name, place in (("wf", (3, 5)), ("wb", (14, 40)), ("out", (3, 1)), ("emb", (pii.symbol("1"), 2)), ("trans", (1, 2)), ("vb", (7,)), ("start", (1,))):
        old = tagger.p[name][place]
        tagger.p[name][place] = old + 1e-5
        up = loss()
        tagger.p[name][place] = old - 1e-5
        down = loss()
        tagger.p[name][place] = old
        assert abs((up - down) / 2e-5 - grads[name][place]) < 1e-4, name


def test_tagger_finds_held_out_spans_and_gating_changes_nothing(tagger):
    rng = random.Random(9)
    found = 0
    for k in range(40):
        text = sentence(rng, 12) + f" mail jo.{k}@site{k}.org or +1 (212) 555-{1000 + k} now " + sentence(rng, 30)
        every = [s * pii.STEP for s in range(max(1, -(-len(text) // pii.STEP)))]
        some = pii.window_starts(text)
        both = []
        for starts in (every, some):
            windows = [text[s : s + pii.WINDOW] for s in starts]
            both.append(pii.model_spans(pii.decoded(tagger, windows), [], starts, windows, len(text)))
        assert both[0] == both[1]
        found += len(set(both[0]) & set(pii.base_spans(text)))
    assert found >= 60  # of 80


def test_tagger_finds_secrets_and_leaves_other_hex_alone(tagger):
    rng = random.Random(12)
    found = wrong = 0
    for k in range(40):
        value = "".join(rng.choices("0123456789abcdef", k=40))
        for text, hit in ((sentence(rng, 9) + f' token = "{value}" ' + sentence(rng, 9), True), (sentence(rng, 9) + f" version {k}.{k % 7} of {1950 + k} " + sentence(rng, 9), False)):
            starts = pii.window_starts(text)
            windows = [text[s : s + pii.WINDOW] for s in starts]
            spans = [s for s in pii.model_spans(pii.decoded(tagger, windows), [], starts, windows, len(text)) if s[0] == "secret"]
            found += hit and any(a >= text.index(value) - 2 and b <= text.index(value) + 42 for _, a, b in spans)
            wrong += not hit and bool(spans)
    assert found >= 36 and wrong <= 1  # of 40 each


def test_personal_data_rows(spark):
    made = with_nulls([*rows(many=4), (900, "write to jo.do@site.org or +1 (212) 555-1000, 10.0.0.1 " * 3, "en", "s", 1)])
    got = {(r.doc_id, r.base_spans): r for r in pii.personal_data(docs(spark, made)).collect()}
    for r in made:
        spans = brute_base(r[1] or "")
        row = got[r[0], ",".join(f"{k}:{a}:{b}" for k, a, b in spans)]
        assert row.n_email == sum(s[0] == "email" for s in spans) and {*row.base_spans.split(",")} <= {*row.spans.split(",")} | {""}
    assert pii.personal_data(docs(spark, [])).count() == 0


def test_decontamination_against_brute_force(spark):
    rng = random.Random(5)
    items = [(i, sentence(rng, 8 + 3 * i)) for i in range(8)] + [(90, None), (91, ""), (92, "two words")]
    made = rows(many=6)
    for i, text in items[:8]:
        words = text.split()
        made.append((200 + i, sentence(rng, 40) + " " + text.upper() + " " + sentence(rng, 9), "en", "s", 1))
        words[len(words) // 2] = "other"
        made.append((300 + i, sentence(rng, 25) + " " + ", ".join(words), "en", "s", 1))
        made.append((400 + i, text, "en", "s", 1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def brute(text):
        hashes, weights = decontamination.shingle_arrays(text or "")
        out = {}
        for item, own in items:
            h, w = decontamination.shingle_arrays(own or "")
            if not len(h):
                continue
            bag = {}
            for k, v in zip(h.tolist(), w.tolist()):
                bag[k] = bag.get(k, 0) + v
            width = min(len(h), len(hashes))
            values = [decontamination.similarity(bag, hashes[s : s + width], weights[s : s + width]) for s in range(len(hashes) - width + 1)] if width else []
            if values and max(values) >= 0.75:
                out[item] = max(values)
        return out

    frame = docs(spark, made)
    for r in decontamination.contaminated(frame, benchmark).collect():
        expected = brute(next(m[1] for m in made if m[0] == r.doc_id))
        assert r.item_ids == ",".join(map(str, sorted(expected))) and r.contaminated == bool(expected)
        if expected:
            assert r.best_similarity == max(expected.values())
    left = {r.doc_id for r in decontamination.clean(frame, benchmark).collect()}
    assert left == {m[0] for m in made if not brute(m[1])}
    assert decontamination.clean(frame, benchmark.limit(0)).count() == len(made)


def test_item_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = spark.createDataFrame([(i, sentence(rng, 20)) for i in range(9)], "item_id long, text string")
    made = [(i, sentence(rng, 20) + " " + r.text, "en", "s", 1) for i, r in enumerate(items.collect())]
    whole = sorted(map(tuple, decontamination.contaminated(docs(spark, made), items).collect()))
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 400)
    assert sorted(map(tuple, decontamination.contaminated(docs(spark, made), items).collect())) == whole


def test_hamming_index_misses_none_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    queries = prints[:30] ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) ^ (np.uint64(0xFF) << np.uint64(9))
    got = set(decontamination.HammingIndex(prints).search(queries))
    assert got == {(q, p) for q in range(30) for p in range(60) if bin(int(queries[q] ^ prints[p])).count("1") <= decontamination.RADIUS}


def test_toxicity_learns_folds_and_excepts(spark):
    rng = random.Random(8)
    made = [(i, sentence(rng, 20) + (" you utter numbskull " if i % 3 == 0 else " you kind friend ") + sentence(rng, 5), "en", "s", 1) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)] + [(5000, 1, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(spark, made), labels)
    got = toxicity.scored(docs(spark, made), model).join(labels.dropna(), "doc_id")
    assert got.where("held_out AND predicted <> toxic").count() == 0 and got.where("held_out").count() > 10
    assert model.score("You NUM85KULL") >= 0.3 and model.score("you nuмbskull") >= 0.3 > model.score("xnumbskull")
    assert model.score("") == model.score("nothing here") < 0.3
    excepted = toxicity.Model({"trash": 5.0}, (-3.0, 1.0, 0.0))
    assert excepted.hits(toxicity.fold("the trash can")) == [] and excepted.hits("trash") == ["trash"]
    assert toxicity.accepted(docs(spark, [(1, None, "", "", 0)]), model).count() == 1
    empty = toxicity.train(docs(spark, []), labels)
    assert empty.score("numbskull") == 0.0 and toxicity.scored(docs(spark, []), empty).count() == 0


def test_licence_base_words_and_rules(spark):
    made = with_nulls([(1, "CC-BY cc by, All rights  reserved; GENERAL public\nlicense", "en", "s", 1), (2, "Licensed under the Apache License, Version 2.0", "en", "s", 1), (3, None, "en", "s", 0), (4, "ccby éall rights reserved", "en", "s", 1)])
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, made)).collect() if r.doc_id}
    assert got[1][1:6] == (10, 4, 0, 7, "cc-by,gpl,reserved")
    assert got[2].labels == "apache-2.0" and got[2].n_base == 0 and 0 < got[2].score <= 1
    assert got[3][1:] == (0, 0, None, None, "", "", 0.0)
    assert got[4].base_labels == ""
    assert len(license_scan.rules()) > 200


def test_chat_round_trip(spark):
    texts = ["", "plain", "<|im_end|>", "<|\\im_start|>", "<|\\\\im_end|> <|im_start|>assistant ok", "é\n\n  x\t", "\\<|im_end|>\\", "<|endoftext|>", None]
    assert all(chat_format.unescape(chat_format.escape(t or "")) == (t or "") for t in texts)
    made = [(c, t, role, texts[(c + t) % len(texts)], "extra") for c in range(9) for t, role in enumerate(["system", "user", "assistant", "us\ner", None])]
    made += [(None, 0, "assistant", "no id", ""), (3, 2, "assistant", "same turn", "")]
    frame = spark.createDataFrame(made, "conv_id long, turn long, role string, text string, offset string")
    expected = {}
    for conv in {r[0] for r in made}:
        turns = sorted(((r[1], (r[2] is None, r[2] or ""), (r[3] is None, r[3] or "")) for r in made if r[0] == conv))
        said = "".join(f"{role[1]}\n{text[1]}\n" for _, role, text in turns)
        learnt = "".join(text[1] for _, role, text in turns if role[1] == "assistant")
        expected[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    got = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(chat_format.formatted(frame)).collect()}
    # Null roles and texts are read as empty before sorting.
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert {k: v[2:] for k, v in got.items()} == {k: v[2:] for k, v in expected.items()}
    assert chat_format.read_back(chat_format.formatted(frame.where(F.lit(False)))).count() == 0
