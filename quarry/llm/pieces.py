"""SentencePiece encoding through a table of distinct chunks, and decoding.

When no vocabulary piece has a whitespace marker after another character,
merges never cross the place in front of a marker, so a text's ids are the
ids of its chunks one after another. The same holds around a character that
is in no longer piece (the line feed) and in front of a full stop or comma
where no piece has one behind another character. Each task keeps a bounded
table of distinct chunks: the library segments a chunk once, and its ids are
put back by position.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_blocks, texts_of, tidied
from quarry.llm.idtable import IdTable, split_at

MARK = "▁"
JOIN = 4000   # distinct chunks encoded in one call


class ChunkEncoder:
    """Exactly the library's ids for whole texts; falls back to it where chunks are not safe."""

    def __init__(self, model: bytes, add_eos: bool = True):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.eos = [sp.eos_id()] if add_eos else []
        vocab = [sp.id_to_piece(i) for i in range(sp.vocab_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        plain = all(sp.normalize(s) == MARK + s.replace(" ", MARK)   # the library changes nothing else
                    for s in ("a", "  a  b ", "ﬁ ① é é　x", "a\tb\nc"))
        lone = sp.piece_to_id(MARK)
        feed = sp.encode("\n")
        self.safe = (plain and len(feed) == 2 and feed[0] == lone
                     and not any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in vocab))
        self.feed = feed[-1]
        # characters that some piece has in front of a full stop or comma
        self.before_stop = re.compile("[" + re.escape("".join(sorted(
            {p[i] for p in vocab for i in range(len(p) - 1) if p[i + 1] in ".," and p[i] not in f".,{MARK}"}))) + "\0]")
        self.find = re.compile(f"{MARK}+[.,]*[^{MARK}\n.,]*|\n|[.,]+[^{MARK}\n.,]*|[^{MARK}\n.,]+").findall
        self.find_wide = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+").findall
        self.table = IdTable(self._learn, {"\n": [self.feed]})

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for k in range(0, len(chunks), JOIN):
            own = chunks[k:k + JOIN]
            ids = self.sp.encode("\n" + "\n".join(own) + "\n", num_threads=1)
            parts.append(split_at(np.array(ids[2:], np.int32), self.feed, len(own)))   # behind the first marker and feed
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        find = self.find_wide if self.before_stop.search(text) else self.find
        return find(MARK + text.replace(" ", MARK))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        plain = [t.decode() for t in texts]
        if self.safe:
            ids, lens = self.table([self._chunks(t) for t in plain])
        else:
            coded = self.sp.encode(plain, num_threads=1)
            ids, lens = np.array([i for x in coded for i in x], np.int32), np.array([len(x) for x in coded], np.int64)
        if self.eos:
            ids = np.insert(ids, np.cumsum(lens), self.eos[0])
            lens = lens + 1
        return ids, lens


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           add_eos: bool = True) -> DataFrame:
    """(id, ids array<int>) for every input row; null text counts as empty.

    The ids are those of the library's ``encode`` on the whole text, with the
    model's end id after them if ``add_eos``. Memory: an Arrow batch, a block
    of it and the bounded table.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())   # one vocabulary file, under a MB
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        coder = ChunkEncoder(model.value, add_eos)
        for b in batches:
            texts, ids = texts_of(b, "text"), b.column("id")
            for part in row_blocks(texts):
                flat, lens = coder(texts[part])
                off = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(part.start, len(lens)), pa.ListArray.from_arrays(pa.array(off), pa.array(flat.astype(np.int32)))],
                    ["id", "ids"])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(tidied(run), f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id, the ids and ``decoded`` (string): the library's ``decode`` of each row's ids; null ids give ''."""
    with open(model_path, "rb") as f:
        model = coded.sparkSession.sparkContext.broadcast(f.read())
    src = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for b in batches:
            ids = b.column("ids")
            for start in range(0, b.num_rows, 200):
                part = ids.slice(start, 200)
                texts = [sp.decode(x) if x else "" for x in part.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(start, 200), part, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    id_type = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(tidied(run), f"id {id_type}, ids array<int>, decoded string")
            .withColumnRenamed("id", id_col).withColumnRenamed("ids", ids_col))
