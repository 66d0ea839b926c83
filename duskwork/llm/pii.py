"""Personal data: fixed patterns plus a character BiLSTM with a CRF on top.

The base patterns are matched on whole texts and always stay. The model adds spans
in forms that patterns don't list: numbers without a plus, spelt-out addresses. It is a
bidirectional LSTM over characters with CRF transitions between tags, written and trained in
numpy on labelled spans: windows of the corpus labelled by the base patterns, at most
``SAMPLE_WINDOWS`` of them (those with the smallest hash), and further forms put into such windows.

Texts are cut into overlapping windows on a fixed grid; each is decoded on its
own, and then all spans of a document are reconciled together: pieces cut by a window's edge join
with what the next window says, and the set of non-overlapping spans with the highest total score stays
(weighted interval scheduling). A span holds a digit or an @ by definition, so windows
without one are not decoded; the result is the same as with them.

Null text counts as empty and has no spans. Offsets are code points, ends exclusive. Repeated rows and
null ids are answered like any other; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import pickle
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import Intervals, map_slices, texts_of, written

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
DIGIT = re.compile(r"[0-9]")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

WINDOW, STEP = 96, 48
SAMPLE_WINDOWS = 300
HIDDEN, EMBED = 16, 12
EPOCHS, BATCH, RATE = 10, 64, 0.03
DECODE_BATCH = 256
MIN_SCORE = 0.97
# Kinds the tagger marks: secrets have no base pattern.
MARKED = (*KINDS, "secret")
TAGS = ["O"] + [f"{p}-{k}" for k in MARKED for p in "BI"]
SEED = 7


# Base patterns ------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL, found from each @ outward instead of from every letter."""
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            found.append(match.span())
            after = match.end()
        at = text.find("@", max(at + 1, after))
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Matches of IP with small parts: the parts of each run of numbers and dots, four at a time."""
    found = []
    for chain in CHAIN.finditer(text):
        start, parts = chain.start(), chain.group().split(".")
        for at in range(0, len(parts), 4):
            four = parts[at : at + 4]
            end = start + sum(map(len, four)) + len(four) - 1
            if len(four) == 4 and all(map(small_part, four)):
                found.append((start, end))
            start = end + 1
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of all four kinds by kind as listed, then start."""
    spans = [("email", *span) for span in emails(text)]
    if not DIGIT.search(text):
        return spans
    spans += [("ip", *span) for span in addresses(text)]
    for match in CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
                spans.append(("phone", *match.span()))
    return spans


# Model --------------------------------------------------------------------------

def symbol(ch: str) -> int:
    """Class of a character: printable ASCII by itself, then line break, letters, others."""
    code = ord(ch)
    return code - 32 if 32 <= code < 127 else 95 if ch == "\n" else 96 if ch.isalpha() else 97


SYMBOLS = 99  # 98 pads


def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (time, text) and lengths."""
    out = np.full((max(map(len, texts)), len(texts)), 98, np.int64)
    for k, text in enumerate(texts):
        out[: len(text), k] = [symbol(ch) for ch in text]
    return out, np.array([len(t) for t in texts])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Bidirectional LSTM over characters, linear emissions, CRF transitions."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        tags = len(TAGS)
        self.p = {"emb": rng.normal(0, 0.3, (SYMBOLS, EMBED)), "out": rng.normal(0, 0.3, (2 * HIDDEN, tags)), "bias": np.zeros(tags), "trans": np.zeros((tags, tags)), "start": np.zeros(tags)}
        for side in "fb":
            self.p[f"w{side}"] = rng.normal(0, 1 / np.sqrt(EMBED + HIDDEN), (EMBED + HIDDEN, 4 * HIDDEN))
            self.p[f"v{side}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        # I-k follows only B-k or I-k.
        self.allowed = np.array([[not b.startswith("I") or a[2:] == b[2:] and a != "O" for b in TAGS] for a in TAGS])
        self.first = np.array([not t.startswith("I") for t in TAGS])

    def lstm(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        steps, size = x.shape[:2]
        w, v = self.p[f"w{side}"], self.p[f"v{side}"]
        h, c = np.zeros((size, HIDDEN)), np.zeros((size, HIDDEN))
        hs, kept = np.zeros((steps, size, HIDDEN)), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = np.concatenate([x[t], h], axis=1)
            gates = z @ w + v
            f, i, o = (sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            before = c
            c = m * (f * c + i * g)
            tc = np.tanh(c)
            h = m * o * tc
            hs[t] = h
            if keep:
                kept.append((t, z, f, i, o, g, before, tc, m))
        return hs, kept

    def emissions(self, symbols: np.ndarray, lengths: np.ndarray, keep: bool = False):
        mask = (np.arange(len(symbols))[:, None] < lengths).astype(float)
        x = self.p["emb"][symbols]
        (hf, kf), (hb, kb) = self.lstm(x, mask, "f", keep), self.lstm(x, mask, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        return h @ self.p["out"] + self.p["bias"], (mask, x, h, kf, kb)

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        return np.where(self.allowed, self.p["trans"], -1e4), np.where(self.first, self.p["start"], -1e4)

    def marginals(self, e: np.ndarray, lengths: np.ndarray):
        """Forward-backward: log partition, tag marginals, summed transition marginals."""
        trans, start = self.scores()
        steps, size, tags = e.shape
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = start + e[0]
        for t in range(1, steps):
            step = log_sum(alpha[t - 1][:, :, None] + trans, 1) + e[t]
            alpha[t] = np.where((t < lengths)[:, None], step, alpha[t - 1])
        for t in range(steps - 2, -1, -1):
            step = log_sum(trans + (beta[t + 1] + e[t + 1])[:, None, :], 2)
            beta[t] = np.where((t + 1 < lengths)[:, None], step, 0)
        logz = log_sum(alpha[-1], 1)
        tag = np.exp(alpha + beta - logz[None, :, None])
        pair = np.zeros((tags, tags))
        for t in range(1, steps):
            live = t < lengths
            if live.any():
                joint = alpha[t - 1][live][:, :, None] + trans + (e[t] + beta[t])[live][:, None, :] - logz[live][:, None, None]
                pair += np.exp(joint).sum(axis=0)
        return logz, tag, pair

    def gradient(self, symbols: np.ndarray, lengths: np.ndarray, gold: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean negative log-likelihood."""
        e, (mask, x, h, kf, kb) = self.emissions(symbols, lengths, keep=True)
        _, tag, pair = self.marginals(e, lengths)
        size = len(lengths)
        de = tag.copy()
        np.put_along_axis(de, gold[:, :, None], np.take_along_axis(de, gold[:, :, None], 2) - 1, 2)
        de *= mask[:, :, None] / size
        real = np.zeros_like(pair)
        live = mask[1:] > 0
        np.add.at(real, (gold[:-1][live], gold[1:][live]), 1)
        grads = {"trans": (pair - real) / size, "start": de[0].sum(axis=0), "out": np.einsum("tbh,tbk->hk", h, de), "bias": de.sum(axis=(0, 1))}
        dh = de @ self.p["out"].T
        dx = np.zeros_like(x)
        for side, kept, part in (("f", kf, dh[:, :, :HIDDEN]), ("b", kb, dh[:, :, HIDDEN:])):
            w = self.p[f"w{side}"]
            dw, dv = np.zeros_like(w), np.zeros(4 * HIDDEN)
            next_h, next_c = np.zeros((size, HIDDEN)), np.zeros((size, HIDDEN))
            for t, z, f, i, o, g, before, tc, m in reversed(kept):
                back = (part[t] + next_h) * m
                dc = (back * o * (1 - tc**2) + next_c) * m
                gates = np.concatenate([dc * before * f * (1 - f), dc * g * i * (1 - i), back * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                dw += z.T @ gates
                dv += gates.sum(axis=0)
                dz = gates @ w.T
                dx[t] += dz[:, :EMBED]
                next_h, next_c = dz[:, EMBED:], dc * f
            grads[f"w{side}"], grads[f"v{side}"] = dw, dv
        grads["emb"] = np.zeros_like(self.p["emb"])
        np.add.at(grads["emb"], symbols, dx)
        return grads

    def fit(self, texts: list[str], tags: list[list[int]], epochs: int = EPOCHS, seed: int = SEED) -> Tagger:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        count, total = 0, max(1, epochs * -(-len(texts) // BATCH))
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                symbols, lengths = encoded([texts[k] for k in chosen])
                gold = np.zeros(symbols.shape, np.int64)
                for column, k in enumerate(chosen):
                    gold[: len(tags[k]), column] = tags[k]
                grads = self.gradient(symbols, lengths, gold)
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                count += 1
                rate = RATE * (1 - count / (total + 1))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9**count)) / (np.sqrt(second[k] / (1 - 0.99**count)) + 1e-8)
        return self

    def decode(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """Viterbi spans (kind, start, end, mean marginal) of each window."""
        symbols, lengths = encoded(texts)
        e, _ = self.emissions(symbols, lengths)
        trans, start = self.scores()
        _, tag, _ = self.marginals(e, lengths)
        steps, size, tags = e.shape
        best, back = start + e[0], np.zeros((steps, size, tags), np.int64)
        for t in range(1, steps):
            paths = best[:, :, None] + trans
            back[t] = paths.argmax(axis=1)
            step = np.take_along_axis(paths, back[t][:, None, :], 1).squeeze(1) + e[t]
            live = (t < lengths)[:, None]
            back[t] = np.where(live, back[t], np.arange(tags))
            best = np.where(live, step, best)
        last = best.argmax(axis=1)
        path = np.zeros((steps, size), np.int64)
        for t in range(steps - 1, -1, -1):
            path[t] = last
            last = back[t][np.arange(size), last]
        out = []
        for k, length in enumerate(lengths):
            spans, at = [], 0
            while at < length:
                if path[at, k] == 0:
                    at += 1
                    continue
                end, kind = at + 1, TAGS[path[at, k]][2:]
                while end < length and TAGS[path[end, k]] == f"I-{kind}":
                    end += 1
                score = float(np.mean([tag[t, k, path[t, k]] for t in range(at, end)]))
                spans.append((kind, at, end, score))
                at = end
            out.append(spans)
        return out


# Training data ------------------------------------------------------------------

def other_forms(rng: np.random.Generator) -> tuple[str, str]:
    """Kind and string of personal data in a form the base patterns may not list."""
    def digits(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def word(low, high):
        return "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(low, high)))

    name = f"{word(3, 8)}{rng.choice(['.', '_', ''])}{word(2, 7)}"
    host = f"{word(3, 9)}.{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"
    parts = rng.integers(1, 255, 4)
    return [
        ("email", f"{name}@{host}"), ("email", f"{name}{digits(2)} @ {host}"), ("email", f"{name} at {digits(1)}{host}".replace(" at ", " @ ")),
        ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"+{digits(2)} {digits(3)} {digits(7)}"),
        ("ip", ".".join(map(str, parts))), ("ip", "[.]".join(map(str, parts))),
        ("card", " ".join(digits(4) for _ in range(4))), ("card", "-".join(digits(4) for _ in range(4))),
    ][rng.integers(0, 10)]


def harmless(rng: np.random.Generator) -> str:
    """Digits that are no personal data."""
    n = int(rng.integers(0, 10**6))
    return [
        f"{1900 + n % 130}", f"version {n % 9}.{n % 7}", f"{n % 9}.{n % 10}.", f"{n % 1000}", f"{n % 100},{n % 1000:03d}", f"{n % 24}:{n % 60:02d}",
        f"{2000 + n % 30}-{1 + n % 12:02d}-{1 + n % 28:02d}", hashlib.md5(str(n).encode()).hexdigest()[: 16 + n % 17], f"{n % 500}.{n % 90} %", "@",
    ][rng.integers(0, 10)]


# Labels of secrets in training windows: the value behind a telling name, or a key that tells itself.
SECRET = re.compile(r"""(?:password|passwd|secret|token|api[_-]?key)["']?\s*[=:]\s*["']?([0-9A-Za-z/+_-]{12,})|\b(AKIA[0-9A-Z]{16})\b""")


def secrets(text: str) -> list[tuple[str, int, int]]:
    return [("secret", *(m.span(1) if m[1] else m.span(2))) for m in SECRET.finditer(text)]


def made_secret(rng: np.random.Generator) -> str:
    """A secret as it stands in a text."""
    value = hashlib.sha1(str(int(rng.integers(0, 10**9))).encode()).hexdigest()[: int(rng.integers(18, 41))]
    name, sign, quote = rng.choice(["password", "token", "api_key", "secret"]), rng.choice(["=", " = ", ": "]), rng.choice(['"', ""])
    return f"AKIA{value[:16].upper()}" if rng.integers(0, 4) == 0 else f"{name}{sign}{quote}{value}{quote}"


def training_set(windows: list[str], seed: int = SEED) -> tuple[list[str], list[list[int]]]:
    """Windows with base spans as labels, and with further forms or harmless digits put in at blanks."""
    rng = np.random.default_rng(seed)
    texts, tags = [], []
    for text in windows:
        spans = [*base_spans(text), *secrets(text)]
        for turn in range(5):
            made, labels = text, list(spans)
            if turn:
                kind, extra = other_forms(rng) if turn < 3 else (None, harmless(rng) if turn == 3 else made_secret(rng))
                blanks = [i for i, ch in enumerate(text) if ch == " " and not any(a <= i < b for _, a, b in spans)]
                at = int(rng.choice(blanks)) + 1 if blanks else 0
                made = text[:at] + extra + " " + text[at:]
                shift = len(extra) + 1
                labels = [(k, a + shift, b + shift) if a >= at else (k, a, b) for k, a, b in spans]
                if kind:
                    labels.append((kind, at, at + len(extra)))
                labels += [(k, at + a, at + b) for k, a, b in secrets(extra)]
                cut = max(0, min(at - 30, len(made) - WINDOW)) if len(made) > WINDOW else 0
                made, labels = made[cut : cut + WINDOW], [(k, max(0, a - cut), min(b - cut, WINDOW)) for k, a, b in labels if b > cut and a < cut + WINDOW]
            row = [0] * len(made)
            for k, a, b in labels:
                if not any(row[a:b]):
                    row[a:b] = [TAGS.index(f"B-{k}")] + [TAGS.index(f"I-{k}")] * (b - a - 1)
            if made:
                texts.append(made)
                tags.append(row)
    return texts, tags


def trained(windows: list[str]) -> Tagger:
    texts, tags = training_set(windows)
    return Tagger().fit(texts, tags) if texts else Tagger()


# Reconciliation -----------------------------------------------------------------

def window_starts(text: str) -> list[int]:
    """Starts of the grid windows that hold a digit or an @."""
    starts: set[int] = set()
    for match in TRIGGER.finditer(text):
        place = match.start()
        starts.update(k * STEP for k in range(max(0, (place - WINDOW) // STEP + 1), place // STEP + 1))
    return sorted(starts)


def joined(spans: list[tuple[str, int, int, float, bool]]) -> list[tuple[str, int, int, float]]:
    """Overlapping spans of one kind made one where an edge has cut one of them."""
    out: list[list] = []
    for kind, start, end, score, cut in sorted(spans):
        last = out[-1] if out else None
        if last and last[0] == kind and start < last[2] and (cut or last[4]):
            last[2], last[3], last[4] = max(last[2], end), max(last[3], score), cut and last[4]
        else:
            out.append([kind, start, end, score, cut])
    return [(k, a, b, s) for k, a, b, s, _ in out]


def reconciled(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """The non-overlapping spans with the highest sum of score times length."""
    best: dict[tuple[str, int, int], float] = {}
    for kind, start, end, score in spans:
        best[kind, start, end] = max(score, best.get((kind, start, end), 0.0))
    ordered = sorted(best.items(), key=lambda s: (s[0][2], s[0]))
    ends = [s[0][2] for s in ordered]
    sums, chosen = [0.0], [None]
    for place, ((kind, start, end), score) in enumerate(ordered):
        before = bisect.bisect_right(ends, start, 0, place)
        value = sums[before] + score * (end - start)
        take = value > sums[-1]
        sums.append(max(value, sums[-1]))
        chosen.append(before if take else None)
    out, place = [], len(ordered)
    while place:
        if chosen[place] is None:
            place -= 1
        else:
            out.append(ordered[place - 1][0])
            place = chosen[place]
    return out[::-1]


def decoded(tagger: Tagger, windows: list[str]) -> list[list[tuple[str, int, int, float]]]:
    return [spans for at in range(0, len(windows), DECODE_BATCH) for spans in tagger.decode(windows[at : at + DECODE_BATCH])]


def model_spans(
    tagged: list[list[tuple[str, int, int, float]]], base: list[tuple[str, int, int]], starts: list[int], windows: list[str], length: int
) -> list[tuple[str, int, int]]:
    """Spans that a document's decoded windows add to its base spans."""
    found = []
    for start, window, spans in zip(starts, windows, tagged):
        for kind, a, b, score in spans:
            cut = a == 0 and start > 0 or b == len(window) and start + b < length
            found.append((kind, start + a, start + b, score, cut))
    def triggered(a, b):
        near = range(bisect.bisect_right(starts, a - WINDOW), bisect.bisect_left(starts, b))
        return any(TRIGGER.search(windows[i][max(0, a - starts[i]) : max(0, b - starts[i])]) for i in near)

    taken = Intervals([(a, b) for _, a, b in base])
    added = []
    for kind, a, b in reconciled([s for s in joined(found) if s[3] >= MIN_SCORE]):
        if b - a >= 6 and not taken.meet(a, b) and triggered(a, b):
            added.append((kind, a, b))
    return added


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (MARKED.index(s[0]), s[1], s[2])))


@functools.lru_cache(maxsize=2)
def loaded(data: bytes) -> Tagger:
    return pickle.loads(data)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, length, base (kinds:start:end), starts, windows: one pass over the whole texts."""

    def find(parts):
        for part in parts:
            texts = texts_of(part)
            starts = [window_starts(t) for t in texts]
            yield (
                part.column("doc_id"), [len(t) for t in texts], [listed(base_spans(t)) if s else "" for t, s in zip(texts, starts)],
                starts, ["\0".join(t[s : s + WINDOW].replace("\0", " ") for s in own) for t, own in zip(texts, starts)],
            )

    return written(map_slices(docs.select(F.col("doc_id").cast("long"), "text"), find, "doc_id long, length long, base string, starts array<long>, windows string"), "pii-windows")


def train_on(found: DataFrame) -> Tagger:
    """Fit on at most ``SAMPLE_WINDOWS`` windows, taken by hash from all documents."""
    windows = found.filter("size(starts) > 0").select(F.explode(F.split("windows", "\0")).alias("w")).distinct()
    rows = windows.orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()
    return trained([row[0] for row in rows])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_spans and spans (kind:start:end) of every row, and the number of all spans."""
    found = candidates(docs)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(train_on(found)))

    def tag(parts):
        tagger = loaded(shared.value)
        for part in parts:
            counts, spans = {k: [] for k in KINDS}, []
            columns = [part.column(c).to_pylist() for c in ("length", "base", "starts", "windows")]
            cut = [windows.split("\0") if starts else [] for starts, windows in zip(*columns[2:])]
            tagged = iter(decoded(tagger, [w for own in cut for w in own]))
            for length, base, starts, windows in zip(*columns[:3], cut):
                own = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                added = model_spans([next(tagged) for _ in windows], own, starts, windows, length) if starts else []
                spans.append(listed(own + added))
                for k in KINDS:
                    counts[k].append(sum(s[0] == k for s in own))
            yield [part.column("doc_id"), *counts.values(), part.column("base"), spans, [s.count(":") // 2 for s in spans]]

    # The windows lie in few files: decoding is dealt over all tasks, whatever their number.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(tasks, F.xxhash64("windows"), F.col("doc_id"))
    return map_slices(dealt, tag, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, n_spans long")
