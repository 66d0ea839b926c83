"""Chat formatting on token ids.

Every segment (role, text) is encoded on its own, with reserved ids spliced in
between, so no text can ever produce a control id and token borders never cross a
segment. Control strings inside texts are escaped by a backslash put after their
``<|`` (one more where backslashes already stand there), which is undone on reading.
Masks and offsets are prefix sums over segment lengths.

Turns are encoded in parallel wherever they lie; then a conversation's encoded turns
are sorted together and streamed, one output row per turn, so neither a long nor a hot
conversation is ever held whole.

Order is (conv_id, turn, role, text), nulls last; null role or text counts as empty;
repeated turns are all kept; rows without ``conv_id`` form one conversation. Only
non-empty turns of role ``assistant`` are under the loss mask. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duskwork.llm.frames import map_slices

START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END)
LOSS_ROLE = "assistant"
ESCAPE = re.compile(r"<\|(\\*)(?=(?:im_start|im_end)\|>)")
UNESCAPE = re.compile(r"<\|\\(\\*)(?=(?:im_start|im_end)\|>)")


def escape(text: str) -> str:
    return ESCAPE.sub(r"<|\\\1", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"<|\1", text)


def byte_table() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(extra)] = b
            extra += 1
    return table


class Codec:
    """One worker's tokenizer: ids of a text, and the bytes of ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.ids = {control: size + i for i, control in enumerate(CONTROLS)}
        table = byte_table()
        self.pieces = [b""] * size
        for piece, number in self.tokenizer.get_vocab().items():
            plain = all(ch in table for ch in piece)
            self.pieces[number] = bytes(table[ch] for ch in piece) if plain else piece.encode("utf-8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def text(self, ids) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8")


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def tokenizer_path(path: str | None = None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.json")


def formatted(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, part, tokens (uint32 bytes), loss_start, loss_end, offset: a row per turn, in order.

    ``part`` numbers the rows of a conversation, ``offset`` is the token offset of
    the row within it, and tokens ``loss_start`` to ``loss_end`` (relative to the row)
    are the ones to learn; the text begins at ``loss_start`` also where nothing is learned.
    """
    path = tokenizer_path(path)

    def encode(parts):
        own = codec(path)
        start, end = own.ids[START], own.ids[END]
        newline = own.encode(["\n"])[0]
        for part in parts:
            roles = [r or "" for r in part.column("role").to_pylist()]
            texts = [t or "" for t in part.column("text").to_pylist()]
            heads, bodies = own.encode([escape(r) + "\n" for r in roles]), own.encode([escape(t) for t in texts])
            packed, starts, ends = [], [], []
            for role, head, body in zip(roles, heads, bodies):
                segments = [[start], head, body, [end], newline]
                places = np.cumsum([len(s) for s in segments])
                packed.append(np.array([i for s in segments for i in s], "<u4").tobytes())
                learn = role == LOSS_ROLE
                starts.append(int(places[1]))
                ends.append(int(places[2]) if learn else int(places[1]))
            yield part.column("conv_id"), part.column("turn"), roles, texts, packed, starts, ends

    def assemble(parts):
        conv, number, offset, begun = None, 0, 0, False
        for part in parts:
            convs, packed = part.column("conv_id").to_pylist(), part.column("tokens").to_pylist()
            numbers, offsets = [], []
            for this, tokens in zip(convs, packed):
                if not begun or this != conv:
                    conv, number, offset, begun = this, 0, 0, True
                numbers.append(number)
                offsets.append(offset)
                number, offset = number + 1, offset + len(tokens) // 4
            yield convs, numbers, packed, part.column("loss_start"), part.column("loss_end"), offsets

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    encoded = map_slices(rows, encode, "conv_id long, turn long, role string, text string, tokens binary, loss_start long, loss_end long")
    ordered = encoded.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")]).drop("turn", "role", "text")
    return map_slices(ordered, assemble, "conv_id long, part long, tokens binary, loss_start long, loss_end long, offset long")


def turns_of(own: Codec, tokens: np.ndarray, body: int) -> tuple[str, str]:
    """Role and text, unescaped, of one formatted turn whose text begins at token ``body``."""
    start, end = own.ids[START], own.ids[END]
    stop = int(np.flatnonzero(tokens == end)[0])
    if tokens[0] != start:
        raise ValueError("a formatted turn begins with the start id")
    return unescape(own.text(tokens[1:body]).removesuffix("\n")), unescape(own.text(tokens[body:stop]))


def read_back(output: DataFrame, path: str | None = None) -> DataFrame:
    """Digest of each conversation, decoded from its formatted ids.

    Streams the sorted rows of a conversation; only running hashes are held.
    """
    path = tokenizer_path(path)

    def read(parts):
        own = codec(path)
        names = {number: control for control, number in own.ids.items()}
        state = None

        def done():
            conv, turns, all_text, chars, loss, size = state
            return [conv], [turns], [all_text.hexdigest()], [chars], [loss.hexdigest()], [size]

        for part in parts:
            columns = [part.column(c).to_pylist() for c in ("conv_id", "tokens", "loss_start", "loss_end")]
            for conv, packed, first, last in zip(*columns):
                if state is None or state[0] != conv:
                    if state is not None:
                        yield done()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                tokens = np.frombuffer(packed, "<u4")
                role, text = turns_of(own, tokens, first)
                learn = unescape(own.text(tokens[first:last]))
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(learn)
                state[4].update(learn.encode())
                inner = tokens[~np.isin(tokens, list(names))]
                state[5] += len(own.text(inner)) + sum(len(names[t]) for t in tokens.tolist() if t in names)
        if state is not None:
            yield done()

    ordered = output.select("conv_id", "part", "tokens", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return map_slices(
        ordered, read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
