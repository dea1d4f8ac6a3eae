"""Chat formatting at token level.

Every text segment is encoded on its own, and the ids of control tokens are
spliced between segments, so no text can ever merge with or turn into a
control token. The ids lie above the tokenizer's vocabulary. A turn is

    <|turn|> role <|body|> text <|end|>

Control strings that occur in a role or text are escaped, so that the
rendered string form is unambiguous too: a backslash is put after the first
character of a control string, one more if backslashes stand there already;
unescaping takes one away. The loss mask of a turn comes from prefix sums
over its ids: +1 after the body mark of an assistant turn, -1 at its end.

A conversation is the rows of its turns in order; it is never gathered into
one row. Reading back decodes ids to roles, texts and masked texts, and a
streaming fold over the sorted turns gives digests, holding one Arrow batch.

Defined results
    null text and null role are empty; rows go by (turn, role, text), nulls
    first, repeated rows are repeated turns; a null conversation id is a
    conversation of its own; empty tables give empty results; other columns
    are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# The control tokens of the template, in the order of their ids.
CONTROL = ["<|turn|>", "<|body|>", "<|end|>"]
# Control strings of common chat templates.
FOREIGN = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|startoftext|>", "<|user|>", "<|assistant|>", "<|system|>"]
LOSS_ROLE = "assistant"
SLICE = 128


def control_pattern(strings: list[str]) -> str:
    """First character, backslashes, rest: one alternative per control string."""
    rests: dict[str, list[str]] = {}
    for s in strings:
        rests.setdefault(s[0], []).append(re.escape(s[1:]))
    return "|".join(rf"{re.escape(first)}(?=\\*(?:{'|'.join(rest)}))" for first, rest in rests.items())


ESCAPE = re.compile(control_pattern(CONTROL + FOREIGN))
UNESCAPE = re.compile(rf"({ESCAPE.pattern})\\")


def escape(text: str) -> str:
    return ESCAPE.sub(lambda m: m.group(0) + "\\", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(lambda m: m.group(1), text)


class ChatCodec:
    """A tokenizer with the control ids placed above its vocabulary."""

    def __init__(self, tokenizer: str = TOKENIZER) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.encode_special_tokens = True
        base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.turn, self.body, self.end = (base + k for k in range(len(CONTROL)))

    def encode(self, roles: list[str], texts: list[str]) -> list[np.ndarray]:
        """Ids of each turn."""
        segments = [escape(s) for pair in zip(roles, texts, strict=True) for s in pair]
        coded = [e.ids for e in self.tokenizer.encode_batch(segments, add_special_tokens=False)]
        return [
            np.array([self.turn, *coded[k], self.body, *coded[k + 1], self.end], dtype=np.int32)
            for k in range(0, len(coded), 2)
        ]

    def loss_mask(self, ids: np.ndarray, role: str) -> np.ndarray:
        """1 on the text of an assistant turn: prefix sums of its marks."""
        if role != LOSS_ROLE:
            return np.zeros(len(ids), dtype=np.int8)
        opened = np.concatenate([[0], (ids == self.body)[:-1]])
        return np.cumsum(opened.astype(np.int8) - (ids == self.end).astype(np.int8)).astype(np.int8)

    def text(self, ids: np.ndarray) -> str:
        return unescape(self.tokenizer.decode([int(i) for i in ids], skip_special_tokens=False))

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str]:
        """(role, text, text under the mask) of one turn."""
        body = int(np.flatnonzero(ids == self.body)[0])
        return self.text(ids[1:body]), self.text(ids[body + 1 : -1]), self.text(ids[mask == 1])

    def rendered(self, ids: np.ndarray) -> str:
        """The string form, escapes and control strings included."""
        out, at = [], 0
        for k in np.flatnonzero(ids >= self.turn):
            out.append(self.tokenizer.decode([int(i) for i in ids[at:k]], skip_special_tokens=False))
            out.append(CONTROL[int(ids[k]) - self.turn])
            at = k + 1
        return "".join(out)


def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Few turns at a time: the tokenizer's results are many times their text."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.iloc[at : at + SLICE]


def format_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(conv_id, turn, role, text, ids, mask): one row per turn, encoded where
    it lies. role and text are the input's, for ordering the rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = ChatCodec(tokenizer)
        for batch in sliced(batches):
            roles, texts = batch["role"].fillna("").tolist(), batch["text"].fillna("").tolist()
            ids = codec.encode(roles, texts)
            masks = [codec.loss_mask(i, r) for i, r in zip(ids, roles, strict=True)]
            yield batch.astype({"conv_id": "Int64", "turn": "Int64"}).assign(ids=ids, mask=masks)

    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "conv_id long, turn long, role string, text string, ids array<int>, mask array<byte>")


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(conv_id, turn, role, text, loss_text, chars) read from ids and masks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = ChatCodec(tokenizer)
        for batch in sliced(batches):
            read = [(*codec.read(i, m), len(codec.rendered(i))) for i, m in zip(batch["ids"], batch["mask"], strict=True)]
            found = pd.DataFrame(read, columns=["role", "text", "loss_text", "chars"], index=batch.index)
            yield pd.concat([batch[["conv_id", "turn"]].astype("Int64"), found], axis=1)

    return formatted.select("conv_id", "turn", "ids", "mask").mapInPandas(
        run, "conv_id long, turn long, role string, text string, loss_text string, chars long"
    )


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.n, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)
        self.chars += chars

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Turns as read back -> one row per conversation. A task streams through
    its sorted turns; a long conversation is never held whole."""
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_one = None
        for batch in batches:
            done = []
            ids = [None if pd.isna(c) else int(c) for c in batch["conv_id"]]
            for conv, *turn in zip(ids, batch["role"], batch["text"], batch["loss_text"], batch["chars"], strict=True):
                if open_one is None or open_one.conv_id != conv:
                    if open_one is not None:
                        done.append(open_one.row())
                    open_one = _Digest(conv)
                open_one.add(*turn)
            if done:
                yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})
        if open_one is not None:
            yield pd.DataFrame([open_one.row()], columns=columns).astype({"conv_id": "Int64"})

    parts = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return parts.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
