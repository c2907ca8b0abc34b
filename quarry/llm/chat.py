"""Chat formatting by token-level assembly.

A turn is a reserved id that opens it, the ids of its escaped text, encoded by
themselves, and a reserved id that closes it. Reserved ids lie behind the
vocabulary, so no text can produce them; so that the rendered text is as
unambiguous as the ids, control strings inside texts are escaped reversibly.
The loss mask follows from marks at the bounds of assistant texts by a prefix
sum.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import tidied

#: Control strings in the order of their reserved ids. A role without its own
#: opening is written between OTHER and ROLE_END.
OPENINGS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER, ROLE_END, TURN_END = "### Other: ", "</role> ", " </turn>\n"
CONTROLS = (*OPENINGS.values(), OTHER, ROLE_END, TURN_END)
LOSS_ROLE = "assistant"
PART_IDS = 1 << 16   # a longer conversation continues in a further row

_CORE = "|".join(re.escape(c.strip()) for c in CONTROLS)
_ESCAPE = re.compile(rf"\\*(?:{_CORE})")
_UNESCAPE = re.compile(rf"\\(\\*(?:{_CORE}))")
_TURN = re.compile(rf"({'|'.join(map(re.escape, OPENINGS.values()))}|{re.escape(OTHER)})")


def escape(text: str) -> str:
    """One backslash in front of every control string (and the backslashes before it)."""
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Codec:
    """A byte-level tokenizer with reserved ids for the control strings behind its vocabulary."""

    def __init__(self, tokenizer_json: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_buffer(tokenizer_json)
        self.tok.encode_special_tokens = True   # their strings are ordinary text
        vocab = self.tok.get_vocab()
        size = max(vocab.values()) + 1
        self.reserved = {c: size + k for k, c in enumerate(CONTROLS)}
        # how the tokenizer writes each byte: printable ones as themselves, the others from U+0100 on
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        signs = {b: chr(b) for b in range(256) if chr(b) in alphabet and b < 256}
        others = iter(sorted(c for c in alphabet if ord(c) >= 256))
        back = {signs.get(b) or next(others): b for b in range(256)}
        self.bytes_of: dict[int, bytes] = {}
        for piece, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
        self.control_of = {i: c for c, i in self.reserved.items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def decode(self, ids) -> str:
        """The text of ids, reserved ones as their control strings."""
        return b"".join(self.control_of[i].encode() if i in self.control_of else self.bytes_of[i] for i in ids).decode()

    def assemble(self, turns: list[tuple[str, str]]) -> tuple[list[list[int]], list[np.ndarray]]:
        """Ids and loss mask of every (role, text) turn."""
        segments = [escape(t) for _, t in turns] + [escape(r) for r, _ in turns if r not in OPENINGS]
        coded = self.encode(segments)
        names = iter(coded[len(turns):])
        ids, masks = [], []
        for (role, _), body in zip(turns, coded, strict=False):
            if role in OPENINGS:
                head = [self.reserved[OPENINGS[role]]]
            else:
                head = [self.reserved[OTHER], *next(names), self.reserved[ROLE_END]]
            own = [*head, *body, self.reserved[TURN_END]]
            marks = np.zeros(len(own) + 1, np.int8)
            if role == LOSS_ROLE:
                marks[len(head)] += 1
                marks[len(head) + len(body)] -= 1
            ids.append(own)
            masks.append(np.cumsum(marks[:-1]) > 0)
        return ids, masks

    def turns(self, ids: list[int]) -> list[tuple[str, str]]:
        """The (role, text) turns that formatted ids hold."""
        roles = {self.reserved[c]: r for r, c in OPENINGS.items()}
        out, start, role = [], 0, ""
        for k, i in enumerate(ids):
            if i in roles:
                role, start = roles[i], k + 1
            elif i == self.reserved[OTHER]:
                start = k + 1
            elif i == self.reserved[ROLE_END]:
                role, start = unescape(self.decode(ids[start:k])), k + 1
            elif i == self.reserved[TURN_END]:
                out.append((role, unescape(self.decode(ids[start:k]))))
        return out


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of rendered text."""
    roles = {c: r for r, c in OPENINGS.items()}
    out, at = [], 0
    while at < len(text):
        opening = _TURN.match(text, at)
        at = opening.end()
        role = roles.get(opening[1])
        if role is None:
            stop = re.compile(rf"(?<!\\){re.escape(ROLE_END)}").search(text, at)
            role, at = unescape(text[at:stop.start()]), stop.end()
        stop = re.compile(rf"(?<!\\){re.escape(TURN_END)}").search(text, at)
        out.append((role, unescape(text[at:stop.start()])))
        at = stop.end()
    return out


PARTS = "conv bigint, part bigint, ids array<int>, loss_mask array<boolean>, text string"


def format_chats(rows: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", part_ids: int = PART_IDS) -> DataFrame:
    """(conv_id, part, ids array<int>, loss_mask array<boolean>, text) of formatted conversations.

    Turns are ordered by turn number (nulls first), then role and text; rows
    that repeat are turns each. Null roles and texts are empty, a null
    conversation id is a group of its own. ``text`` renders the ids.

    Rows are dealt by ranges of conversation and turn and sorted, so one
    conversation may spread over tasks and none is gathered whole: a row holds
    consecutive turns of one conversation, a new one begins in a new task or
    beyond ``part_ids`` ids, and ``part`` orders the rows of a conversation.
    """
    with open(tokenizer_path, "rb") as f:
        model = rows.sparkSession.sparkContext.broadcast(f.read())   # one vocabulary file
    order = ["conv", "turn", "role", "text"]
    src = rows.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                      F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        from pyspark import TaskContext
        codec = Codec(model.value)
        part = TaskContext.get().partitionId() << 36
        conv, ids, mask, begun = None, [], [], False

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([part], pa.int64()), pa.array([ids], pa.list_(pa.int32())),
                 pa.array([np.concatenate(mask)], pa.list_(pa.bool_())), pa.array([codec.decode(ids)], pa.string())],
                ["conv", "part", "ids", "loss_mask", "text"])

        for b in batches:
            convs = b.column("conv").to_pylist()
            turns = list(zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True))
            for k in range(0, len(turns), 256):
                for c, own, m in zip(convs[k:k + 256], *codec.assemble(turns[k:k + 256]), strict=False):
                    if begun and (c != conv or len(ids) + len(own) > part_ids):
                        yield row()
                        part, ids, mask = part + 1, [], []
                    conv, begun = c, True
                    ids.extend(own)
                    mask.append(m)
        if begun:
            yield row()

    return src.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidied(run), PARTS).withColumnRenamed("conv", conv_col)
