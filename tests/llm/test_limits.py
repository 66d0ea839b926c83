"""Long texts in linear time, and ids and names at their limits."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from duskwork.llm import decontamination, license_scan, line_dedup, mixing, pii, toxicity
from duskwork.llm.frames import Intervals
from tests.llm.cases import docs, sentence

IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_intervals_against_looking_at_all():
    rng = random.Random(4)
    for _ in range(200):
        spans = [(a, a + rng.randint(1, 9)) for a in rng.choices(range(40), k=rng.randint(0, 8))]
        held = Intervals(spans)
        for a in range(40):
            for b in range(a + 1, 45):
                assert held.contain(a, b) is any(x <= a and b <= y for x, y in spans)
                assert held.meet(a, b) is any(x < b and a < y for x, y in spans)


def test_addresses_against_the_pattern():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("0123.25 .a") for _ in range(rng.randint(0, 40)))
        plain = [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert pii.addresses(text) == plain


LONG = 1_000_000


@pytest.mark.parametrize("text", [
    "7" * LONG, "1." * (LONG // 2), "12.34.56.78 " * (LONG // 12), "4 1-" * (LONG // 4), "+1(" * (LONG // 3), "a@b." * (LONG // 4),
    "x@" * (LONG // 2), "+1 " + "(" * LONG, "john@mail.org 4111111111111111 +491701234567 " * (LONG // 45),
])
def test_personal_data_of_a_long_text(text):
    begun = time.perf_counter()
    base = pii.base_spans(text)
    starts = pii.window_starts(text)
    windows = [text[s : s + pii.WINDOW] for s in starts]
    tagged = [[("email", 3, 20, 1.0)] for _ in windows]
    pii.model_spans(tagged, base, list(starts), windows, len(text))
    assert time.perf_counter() - begun < 5


@pytest.mark.parametrize("text", [
    "cc by " * (LONG // 6), "copyright (c) 2020 someone\n" * (LONG // 27), "general public license all rights reserved " * (LONG // 43),
    "licensed under the mit license, or the gpl. " * (LONG // 44), "a" * LONG, "(c) " * (LONG // 4),
])
def test_licences_of_a_long_text(text):
    begun = time.perf_counter()
    found = license_scan.scan_text(text)
    assert time.perf_counter() - begun < 5
    words = text.split()
    assert found[0] == len(words) and found[1] == text.count("cc by") + text.count("general public license") + text.count("all rights reserved")


def test_base_places_against_plain_search():
    rng = random.Random(8)
    phrases = {p: label for p, label in license_scan.BASE.items()}
    for _ in range(300):
        words = rng.choices("cc by general public license all rights reserved x".split(), k=rng.randint(0, 30))
        plain = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert sorted(license_scan.base_places([w.encode() for w in words])) == sorted(plain)


def test_toxicity_of_a_long_text_and_plain_search():
    model = toxicity.Model({"bad": 1.0, "vile": 2.0, "baddest": 0.5}, (0.0, 1.0, 1.0))
    exceptions = sorted(toxicity.EXCEPTIONS)
    begun = time.perf_counter()
    model.hits(toxicity.fold((exceptions[0] + " bad vile ") * (LONG // 20)))
    assert time.perf_counter() - begun < 5
    rng = random.Random(3)
    words = ["bad", "vile", "baddest", "xbad", "b4d", "calm", *exceptions]
    for _ in range(300):
        text = toxicity.fold(" ".join(rng.choices(words, k=rng.randint(0, 12))))
        at_word = lambda i: i == 0 or not text[i - 1].isalnum()
        harmless = [(i, i + len(e)) for e in map(toxicity.fold, exceptions) for i in range(len(text)) if text.startswith(e, i) and at_word(i)]
        plain = [
            s for s in model.weights for i in range(len(text))
            if text.startswith(s, i) and at_word(i) and not any(a <= i and i + len(s) <= b for a, b in harmless)]
        assert sorted(model.hits(text)) == sorted(plain)


def test_findings_do_not_depend_on_the_number_of_item_blocks(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, sentence(rng, 20)) for i in range(8)] + [(3, sentence(rng, 25))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    made = [(None, items[0][1], "en", "s", 1), (None, "nothing of that sort", "en", "s", 1), (5, items[1][1], "en", "s", 1),
            (5, items[2][1] + " " + items[8][1], "en", "s", 1), (6, None, None, None, None), (7, items[3][1] + " . " + items[8][1], "en", "s", 1)]
    whole = sorted(map(tuple, decontamination.contaminated(docs(spark, made), benchmark).collect()), key=str)
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 300)
    assert len(decontamination.item_blocks(benchmark)) > 2
    assert sorted(map(tuple, decontamination.contaminated(docs(spark, made), benchmark).collect()), key=str) == whole
    assert [(r[0], r[3]) for r in whole if r[1]] == [(5, "1"), (5, "2,3"), (7, "3"), (None, "0")]


def test_mixing_keeps_columns_whatever_their_names(spark):
    made = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(60)]
    plain = docs(spark, made)
    names = ["copy", "position", "cdf", "pieces", "row", "count", "mix_source", "rows", "rate"]
    clashing = plain.select("*", *[F.lit(n).alias(n) for n in names])
    got = mixing.mixed(clashing)
    assert got.columns == [*clashing.columns, "copy_", "position_"]
    expected = sorted((r.doc_id, r.copy, r.position) for r in mixing.mixed(plain).collect())
    rows = got.collect()
    assert sorted((r.doc_id, r.copy_, r.position_) for r in rows) == expected and [r.position_ for r in rows] == sorted(r.position_ for r in rows)
    assert {tuple(r[n] for n in names) for r in rows} == {tuple(names)}


def test_line_dedup_keeps_the_largest_id(spark):
    line = "a line of some length that repeats"
    made = [(2**63 - 1, f"{line}\nown", "en", "s", 1), (1, line, "en", "s", 1), (None, f"{line}\nhers", "en", "s", 1), (-(2**63), "x", "en", "s", 1)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.deduplicated(docs(spark, made)).collect()}
    assert got == {2**63 - 1: ("own", 1), 1: (line, 0), None: ("hers", 1), -(2**63): ("x", 0)}
