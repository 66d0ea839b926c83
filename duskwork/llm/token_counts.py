"""Token counts by batch encoding; only lengths leave the workers.

Texts are split at spaces, and stretches longer than ``PIECE_CHARS`` before a blank or an
ASCII digit: this tokenizer drops white space, takes a digit as a piece of its own and
composes neither with what stands before, so the counts of the parts add up to that of
the whole. A stretch without any such place stays whole. Parts that are new reach the
tokenizer in batches of about ``BATCH_BYTES`` bytes, whatever their number, so short ones
share a call and long ones don't fill the memory; counts of short parts are kept for
the texts that follow, up to ``KEPT_PARTS`` of them. Tokenizers whose parts don't allow such
splits (``cuts_safely``) get whole texts, in batches of the same size.

Null text counts as empty: no bytes, no tokens. Repeated rows are each counted; a null
``doc_id`` stays null. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re

import public_tokenizers
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from duskwork.llm.frames import map_slices, texts_of

LIMIT = 2048
BATCH_BYTES = 1 << 18
PIECE_CHARS = 1 << 16
# Parts whose counts a worker keeps (about 40 MB), and the longest of them.
KEPT_PARTS = 300_000
KEPT_CHARS = 40
BREAK = re.compile("[ \t\n\r0-9]")
# Parts under which a cut before a blank or digit changes nothing: names of normalisers and pre-tokenizers.
SAFE_NORMALIZERS = {"NFC", "Lowercase", "Replace"}
SAFE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_safely(description: dict) -> bool:
    """Whether a tokenizer file's parts keep the counts of a text cut before a blank or an ASCII digit."""
    normalizer = description.get("normalizer") or {"normalizers": []}
    normalizers = normalizer.get("normalizers", [normalizer])
    steps = description.get("pre_tokenizer") or {"pretokenizers": []}
    splits = [s for s in steps.get("pretokenizers", [steps]) if s["type"] == "Split"]
    blanks = [n for n in normalizers if n["type"] == "Replace"]
    return (
        all(n["type"] in SAFE_NORMALIZERS for n in normalizers)
        and all(n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in blanks)
        and len(splits) == 1 and splits[0]["pattern"] == {"Regex": SAFE_SPLIT}
        and splits[0]["behavior"] == "Removed" and splits[0]["invert"]
        and not any(re.search(r"[\s0-9]", t["content"]) or t["lstrip"] or t["rstrip"] for t in description["added_tokens"])
    )


def pieces(text: str, most: int) -> list[str]:
    """``text`` cut before the first safe place from each ``most`` characters on."""
    out, start = [], 0
    while len(text) - start > most:
        place = BREAK.search(text, start + most)
        if place is None:
            break
        out.append(text[start : place.start()])
        start = place.start()
    out.append(text[start:])
    return out


class Counter:
    """Counts tokens of texts with one tokenizer file."""

    def __init__(self, path: str):
        # Spark runs a task per core; threads of the library would only compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            self.cuts = cuts_safely(json.load(file))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        if not self.cuts:
            found = dict(zip(texts, self.encoded(texts)))
            return [found[t] for t in texts]
        return [n for group in grouped(texts) for n in self.split_counts(group)]

    def split_counts(self, texts: list[str]) -> list[int]:
        """Counts of the texts from those of their parts; new parts of all of them are encoded together."""
        if len(self.known) > KEPT_PARTS:
            self.known.clear()
        known = self.known
        split = [text.split(" ") for text in texts]
        new = [part for part in set().union(*split) if part not in known]
        long_parts = {part: pieces(part, PIECE_CHARS) for part in new if len(part) > PIECE_CHARS}
        whole = [part for part in new if part not in long_parts]
        known.update(zip(whole, self.encoded(whole)))
        for part, cut in long_parts.items():
            known[part] = sum(self.encoded(cut))
        totals = [sum(map(known.__getitem__, parts)) for parts in split]
        for part in new:
            if len(part) > KEPT_CHARS:
                del known[part]
        return totals

    def encoded(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text, encoded in batches of even size."""
        return [
            len(found) for batch in grouped(texts)
            for found in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
        ]


def grouped(texts: list[str]):
    """``texts`` in order, in batches of about ``BATCH_BYTES`` bytes."""
    batch, size = [], 0
    for text in texts:
        batch.append(text)
        size += len(text.encode())
        if size >= BATCH_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; no shuffle, texts stay in their tasks."""
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def count(parts):
        own = counter(path)
        for part in parts:
            texts = texts_of(part)
            tokens = own.counts(texts)
            yield part.column("doc_id"), [len(t.encode()) for t in texts], tokens, [n > limit for n in tokens]

    return map_slices(
        docs.select(docs["doc_id"].cast("long"), "text"), count,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )
