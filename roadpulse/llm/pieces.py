"""SentencePiece encoding and decoding through a table of distinct chunks.

With a model that keeps spaces as markers and has no piece in which a marker follows another character, no merge ever
crosses from a word into the next marker. A text then falls apart into chunks (markers, then the word up to the next
space), each chunk has the same pieces wherever it stands, and the ids of a text are those of its chunks in order.
A task keeps a table from distinct chunk to ids and decoded bytes, segments only chunks that it has not seen, and
puts both back by position. The table holds ``TABLE_ENTRIES`` chunks at most and starts anew beyond; long chunks are
segmented each time. A table shared by all tasks would cost a shuffle of every word occurrence.

Nulls count as empty texts (begin and end id only). Texts with the marker character itself, and models without the
properties above, are encoded whole. Repeated rows give repeated results; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadpulse.llm.common import slices, trimmed

MARK = "▁"
TABLE_ENTRIES = 250_000
LONGEST_KEPT = 48
_coders: dict[str, Coder] = {}


class Coder:
    """One model in one worker, with its table."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        self.head, self.tail = array("I", [self.begin]).tobytes(), array("I", [self.end]).tobytes()
        self.mark, self.plain = self.model.piece_to_id(MARK), self.model.piece_to_id("a")
        #: ids of each chunk; decoded form of those that do not decode to themselves
        self.table: dict[str, bytes] = {}
        self.other: dict[str, str] = {}
        self.separable = self._separable()

    def _separable(self) -> bool:
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        # spaces are kept as they are, other white space and compatibility forms are not folded
        probe = self.model.encode(" a  b\t ① ", out_type=str)
        plain = "".join(p for p in probe if not p.startswith("<0x")).startswith(f"{MARK}{MARK}a{MARK}{MARK}b")
        whole = self.model.decode(self.model.encode(" a  b\t ① ")) == " a  b\t ① "
        return not crossing and plain and whole and MARK in pieces

    def rest(self) -> None:
        """Forget most chunks, so that a worker does not hold them between tasks."""
        self.table = trimmed(self.table)
        self.other = {c: t for c, t in self.other.items() if c in self.table}

    def segment(self, chunks: list[str]) -> None:
        """Add chunks to the table. A chunk lacks its first marker, which the model puts in front itself."""
        if len(self.table) + len(chunks) > TABLE_ENTRIES:
            self.rest()
        ids = [i or [self.mark] for i in self.model.encode(chunks, num_threads=1)]
        # decode() drops a space at the start of a text only, so an ordinary piece stands in front
        decoded = self.model.decode([[self.plain, *i] for i in ids])
        for chunk, i, text in zip(chunks, ids, decoded, strict=True):
            self.table[chunk] = array("I", i).tobytes()
            if text[2:] != chunk:
                self.other[chunk] = text[1:]

    def __call__(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        table, split, new = self.table, [], {}
        for text in texts:
            if not self.separable or MARK in text:
                split.append(None)
                continue
            chunks = _chunks(text)
            split.append(chunks)
            for c in chunks:
                if c not in table:
                    new[c] = None
        if new:
            if len(table) + len(new) > TABLE_ENTRIES:
                new.update(dict.fromkeys(c for chunks in split if chunks for c in chunks))
            self.segment(list(new))
        table = self.table
        out = []
        for text, chunks in zip(texts, split, strict=True):
            if chunks is None:
                ids = self.model.encode(text)
                out.append((array("I", [self.begin, *ids, self.end]).tobytes(), self.model.decode(ids)))
                continue
            ids = b"".join([self.head, *[table[c] for c in chunks], self.tail])
            if self.other and any(c in self.other for c in chunks):
                text = "".join([self.other.get(c, f" {c}") for c in chunks])[1:]
            out.append((ids, text))
        for c in new:
            if len(c) > LONGEST_KEPT:
                del table[c]
                self.other.pop(c, None)
        return out


def _chunks(text: str) -> list[str]:
    """Chunks of a text, each without its first marker: "a  b " gives "a", " b" and ""."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] for c in re.findall(" +[^ ]*", f" {text}")]


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encode(documents: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: the id, ``ids`` (array of int, begin and end included) and ``decoded`` text."""
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(model_path)
        for batch in slices(batches, "text"):
            pairs = code([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i, _ in pairs], pa.list_(pa.int32())),
                 pa.array([d for _, d in pairs], pa.string())],
                ["id", "ids", "decoded"],
            )
        code.rest()

    given = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    return given.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_column)


def digests(documents: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As ``encode``, but with the number of ids and SHA-256 digests instead of the ids and the text themselves."""
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(model_path)
        for batch in slices(batches, "text"):
            pairs = code([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(i) // 4 for i, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(i).hexdigest() for i, _ in pairs]), pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in pairs])],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        code.rest()

    given = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    out = given.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_column)
