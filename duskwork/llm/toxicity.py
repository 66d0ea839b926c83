"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts to Latin ones,
digits used as letters to those letters. The lexicon holds word beginnings (stems) learned from
labelled documents: their document frequency under both labels gives a log-odds weight;
a stem is as long as its documents stay the same. One automaton finds stems and exception phrases; a
hit inside an exception phrase doesn't count. Distinct hits are summed by weight, once
plain and once divided by text length, and a logistic curve turns the two into a score.

Learning reads at most ``SAMPLE_ROWS`` labelled documents (those with the smallest hash of
their id, a documented bound); scoring reads every whole text. Null text counts as
empty and gets the score of a text without hits. Labels of documents that don't exist and
null labels are ignored; of several labels of one document the largest counts.
Without labels of both kinds every score is 0. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import pickle
import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import Intervals, map_slices, texts_of, written

SAMPLE_ROWS = 20_000
STEM_LENGTHS = range(4, 11)
LEAST_DOCS = 4
LEAST_WEIGHT = 2.0
LEXICON_MOST = 500
THRESHOLD = 0.3
COUNT_ENTRIES = 500_000

# Look-alike letters, digits standing for letters, harmless phrases.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһкмтвнαβεικνορτυχ０１２３４５６７８９ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ",
    "aeopcyxijsdhkmtbhabeiknoptux0123456789abcdefghijklmnopqrstuvwxyz",
))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash folder", "clown fish", "clown car", "loser bracket",
    "scum line", "pond scum", "soap scum", "worthless check", "worthless security",
)
FOLD = {ord(a): DIGITS.get(b, b) for a, b in LOOKALIKES.items()} | {ord(a): b for a, b in DIGITS.items()}
TO_FOLD = re.compile("[" + "".join(map(re.escape, {*LOOKALIKES, *DIGITS})) + "]")
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    text = text.lower()
    return text.translate(FOLD) if TO_FOLD.search(text) else text


class Model:
    """Lexicon, curve and automaton; pickles without the automaton."""

    def __init__(self, weights: dict[str, float], curve=(0.0, 0.0, 0.0), constant: float | None = None):
        self.weights, self.curve, self.constant = weights, curve, constant
        self.automaton = None

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def build(self):
        self.automaton = ahocorasick.Automaton()
        for phrase in EXCEPTIONS:
            self.automaton.add_word(fold(phrase), (None, len(fold(phrase))))
        for stem in self.weights:
            self.automaton.add_word(stem, (stem, len(stem)))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> list[str]:
        """Stems at the beginnings of words, outside exception phrases."""
        if self.automaton is None:
            self.build()
        found, harmless = [], []
        for end, (stem, length) in self.automaton.iter(folded):
            start = end - length + 1
            if start and folded[start - 1].isalnum():
                continue
            if stem is None:
                harmless.append((start, end))
            else:
                found.append((start, end, stem))
        if harmless:
            held = Intervals(harmless)
            found = [f for f in found if not held.contain(f[0], f[1])]
        return [stem for _, _, stem in found]

    def features(self, text: str) -> tuple[float, float]:
        """Weight of distinct hits; weight of all hits by length (per hundred letters, at least)."""
        folded = fold(text)
        hits = self.hits(folded)
        if not hits:
            return 0.0, 0.0
        return sum(self.weights[s] for s in sorted(set(hits))), sum(self.weights[s] for s in hits) / (1 + len(folded) / 100)

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        plain, dense = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] + self.curve[1] * plain + self.curve[2] * dense))))


def fit_curve(features: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge."""
    scale = np.maximum(features.max(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(features)), features / scale])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + 0.1 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w = w - np.linalg.solve(hess, grad)
    return float(w[0]), float(w[1] / scale[0]), float(w[2] / scale[1])


def choose_stems(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Stems with weight; ``rows`` are (stem, toxic documents, clean documents)."""
    counts = {stem: (t, c) for stem, t, c in rows}
    longest: dict[str, int] = {}
    for stem, (t, _) in counts.items():
        longest[stem[:-1]] = max(longest.get(stem[:-1], 0), t)
    chosen: dict[str, float] = {}
    for stem in sorted(counts, key=lambda s: (len(s), s)):
        t, c = counts[stem]
        weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        whole = longest.get(stem, 0) < 0.95 * t
        if weight >= LEAST_WEIGHT and whole and not any(stem.startswith(s) for s in (stem[:n] for n in STEM_LENGTHS if n < len(stem)) if s in chosen):
            chosen[stem] = weight
    best = sorted(chosen, key=lambda s: (-chosen[s] * counts[s][0], s))[:LEXICON_MOST]
    return {stem: chosen[stem] for stem in best}


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from labelled documents whose crc32(doc_id as text) mod 4 isn't 2."""
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("label")).dropna()
    known = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    # At most sample_rows ids: 20 bytes each, whatever the size of the tables.
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = written(docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id").select("text", "label"), "toxic-sample")

    def count(parts):
        counts: dict[str, list[int]] = {}
        for part in parts:
            for text, label in zip(texts_of(part), part.column("label").to_pylist()):
                stems = {word[:n] for word in set(WORD.findall(fold(text))) for n in STEM_LENGTHS if len(word) >= n}
                for stem in stems:
                    counts.setdefault(stem, [0, 0])[0 if label == 1 else 1] += 1
            if len(counts) > COUNT_ENTRIES:
                yield listed(counts)
                counts = {}
        if counts:
            yield listed(counts)

    def listed(counts):
        return list(counts), [v[0] for v in counts.values()], [v[1] for v in counts.values()]

    sizes = {row[0]: row[1] for row in sample.groupBy((F.col("label") == 1).alias("toxic")).count().collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Model({}, constant=0.0)
    stems = map_slices(sample, count, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # A stem with this weight is rarer among clean than among toxic documents by e**LEAST_WEIGHT.
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = stems.filter((F.col("toxic") >= LEAST_DOCS) & (odds >= LEAST_WEIGHT)).orderBy(F.desc("toxic"), "stem").limit(20 * LEXICON_MOST).collect()
    model = Model(choose_stems([tuple(r) for r in rows], toxic, clean))

    def measure(parts):
        for part in parts:
            rows = [model.features(text) for text in texts_of(part)]
            yield [r[0] for r in rows], [r[1] for r in rows], [1.0 if x == 1 else 0.0 for x in part.column("label").to_pylist()]

    table = map_slices(sample, measure, "plain double, dense double, label double").toPandas().sort_values(["plain", "dense", "label"]).to_numpy()
    model.curve = fit_curve(table[:, :2], table[:, 2])
    model.automaton = None
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@functools.lru_cache(maxsize=4)
def loaded(data: bytes) -> Model:
    return pickle.loads(data)


def score_column(model: Model, text: Column) -> Column:
    """The score of ``text`` as a column, Arrow batch by batch."""
    data = pickle.dumps(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = loaded(data)
        return pd.Series([own.score(text or "") for text in texts], dtype="float64")

    return score(text)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), score_column(model, F.col("text")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of the rows that score below the threshold."""
    return docs.filter(score_column(model, docs["text"]) < THRESHOLD)
