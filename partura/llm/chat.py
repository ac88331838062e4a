"""Chat formatting on the level of tokens, and reading it back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.shipping import map_arrow

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
CONTROLS = (ROLE, TEXT, END)
LEARN = "assistant"

_FORMATTED = "conv_id long, turn long, ids array<int>, mask binary"


def escape(text: str) -> str:
    """No control string occurs in the result; `unescape` restores the text."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Template:
    """Ids of turns. Control strings are ids above the vocabulary, which no text can give."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.first = self.tokenizer.get_vocab_size()
        self.role, self.text, self.end = range(self.first, self.first + len(CONTROLS))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def turn(self, role_ids: list[int], text_ids: list[int], learn: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of a turn: the mask is the running sum of its starts and ends."""
        ids = np.array([self.role, *role_ids, self.text, *text_ids, self.end], np.int32)
        step = np.zeros(len(ids), np.int8)
        if learn and text_ids:
            step[len(role_ids) + 2] += 1
            step[-1] -= 1
        return ids, np.cumsum(step, dtype=np.int8)

    def parts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Role ids and text ids of a turn, found by the control ids."""
        at = np.flatnonzero(ids >= self.first)
        if ids[at].tolist() != [self.role, self.text, self.end]:
            raise ValueError("a turn must hold each control id once, in order")
        return ids[at[0] + 1 : at[1]], ids[at[1] + 1 : at[2]]

    def shown(self, ids: np.ndarray) -> str:
        """The formatted text of a turn."""
        role, text = self.parts(ids)
        return ROLE + self.decode(role) + TEXT + self.decode(text) + END


@lru_cache
def _template(path: str) -> Template:
    return Template(path)


def _format(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = _template(path)
        for batch in batches:
            roles, texts = ([x or "" for x in batch.column(k).to_pylist()] for k in (2, 3))
            known = {r: ids for r, ids in zip(set(roles), template.encode([escape(r) for r in set(roles)]))}
            all_ids, masks = [], []
            for role, ids in zip(roles, template.encode([escape(t) for t in texts])):
                made, mask = template.turn(known[role], ids, role == LEARN)
                all_ids.append(made), masks.append(mask.tobytes())
            lengths = np.cumsum([0, *map(len, all_ids)])
            flat = np.concatenate(all_ids) if all_ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int32()))
            columns = [batch.column(0), batch.column(1), lists, pa.array(masks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "ids", "mask"])

    return run


def format_chats(turns: DataFrame, vocabulary: str) -> DataFrame:
    """(conv_id, turn, ids, mask): the token ids of each row of `turns` (conv_id, turn, role, text) and their loss mask.

    A conversation is its turns by turn. Null role or text is as empty. Each segment is encoded by itself and control ids are
    spliced between, so no text can form one. In the text form a backslash before the bar keeps a control string in a text
    apart, and backslashes are doubled. The mask covers the text of assistant rows.
    Rows with a null conv_id are one conversation; rows with the same turn follow each other in the order of their ids.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return map_arrow(rows, _format(vocabulary), _FORMATTED)


_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_tokens long, n_loss_tokens long"
)


class _Sums:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n = [0] * 5

    def add(self, template: Template, ids: np.ndarray, mask: np.ndarray) -> None:
        role, text = (unescape(template.decode(p)) for p in template.parts(ids))
        learnt = ids[mask.astype(bool)]
        loss = unescape(template.decode(learnt)) if len(learnt) else ""
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        for k, more in enumerate((1, len(loss), len(template.shown(ids)), len(ids), len(learnt))):
            self.n[k] += more

    def row(self) -> tuple:
        n = self.n
        return (self.conv_id, n[0], self.turns.hexdigest(), n[1], self.loss.hexdigest(), n[2], n[3], n[4])


def _read(path: str):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    names.append("n_loss_tokens")
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, now, done = _template(path), None, []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            lists, masks = batch.column(2), batch.column(3).to_pylist()
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for k, conv_id in enumerate(batch.column(0).to_pylist()):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Sums(conv_id)
                now.add(template, flat[ends[k] : ends[k + 1]], np.frombuffer(masks[k], np.int8))
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield batch_of(done)

    return run


def read_chats(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of each conversation, read back from its ids and mask alone.

    Rows are sorted by conversation and turn and streamed: a task holds one batch and running digests, however
    long a conversation is.
    """
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return map_arrow(dealt, _read(vocabulary), _READ)
