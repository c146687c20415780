"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the model holds a whitespace marker after another character, so no merge crosses
from a word into the next marker: a text falls into chunks, each a run of markers and the
characters up to the next marker, and the library's ids of the text are those of its chunks
in order. Every task keeps a table of the chunks it has met, segments a new chunk once, and
joins the ids back by position. The table is emptied at ``max_chunks`` entries, which bounds
memory and changes no result. A model with pieces across markers is refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MAX_CHUNKS = 200_000
CHUNK = re.compile(r" *[^ ]+| +$")


def read_model(path: str) -> bytes:
    """The model's bytes, checked: its pieces may not cross a marker, nor its normaliser
    change or drop characters."""
    with open(path, "rb") as f:
        model = f.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    crossing = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if re.search(f"[^{MARK}]{MARK}", p)]
    probe = "  a  　ﬁé "
    if crossing or sp.decode(sp.encode(probe)) != probe:
        raise ValueError("the chunk table needs pieces within markers and an identity normaliser")
    return model


class ChunkTable:
    """Ids of texts, each distinct chunk segmented once."""

    def __init__(self, model: bytes, max_chunks: int = MAX_CHUNKS):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.max_chunks = max_chunks
        self.ids: dict[str, tuple[int, ...]] = {}
        self.texts: dict[str, str] = {}

    def chunks(self, text: str) -> list[str]:
        """Chunks without the first marker of each, which the library puts before a text."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [c[1:] for c in CHUNK.findall(" " + text)]

    def learn(self, chunks: list[list[str]]) -> None:
        if len(self.ids) > self.max_chunks:
            self.ids, self.texts = {}, {}
        new = list(set(chain.from_iterable(chunks)).difference(self.ids))
        for chunk, ids in zip(new, self.sp.encode(new, num_threads=1)):
            # a lone last marker: the library gives none for the empty text
            ids = ids if chunk else [self.sp.piece_to_id(MARK)]
            self.ids[chunk] = tuple(ids)
            self.texts[chunk] = ",".join(map(str, ids))

    def encode(self, chunks: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.ids.__getitem__, chunks)))

    def id_text(self, chunks: list[str]) -> str:
        return ",".join(map(self.texts.__getitem__, chunks))


def groups(column: pa.Array, max_bytes: int = 4 << 20) -> Iterator[list[str]]:
    """The texts of a batch (null: empty), in lists of about ``max_bytes`` at most; a longer
    text stands alone."""
    out, size = [], 0
    for x in column:
        text = x.as_py() or ""
        if out and size + len(text) > max_bytes:
            yield out
            out, size = [], 0
        out.append(text)
        size += len(text)
    if out:
        yield out


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, text`` per row: the ids and the text that they decode to.

    A null text counts as empty: no ids, empty text. Repeated rows come back as often as
    they came; an empty table gives no rows; only the two named columns are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for b in batches:
            at = 0
            for texts in groups(b.column("t")):
                chunks = [table.chunks(t) for t in texts]
                table.learn(chunks)
                ids = [table.encode(c) for c in chunks]
                yield pa.RecordBatch.from_arrays(
                    [b.column("i").slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(table.sp.decode(ids), pa.string())], ["doc_id", "ids", "text"])
                at += len(texts)

    return _mapped(docs, run, "ids array<int>, text string", id_col, text_col)


def digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row: ``encode`` digested in the
    task, so that no ids are shipped. Nulls and repeats as there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            n, of_ids, of_text = [], [], []
            for texts in groups(b.column("t")):
                chunks = [table.chunks(t) for t in texts]
                table.learn(chunks)
                for c in chunks:
                    ids = table.encode(c)
                    n.append(len(ids))
                    of_ids.append(sha(table.id_text(c)))
                    of_text.append(sha(table.sp.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(docs, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", id_col, text_col)


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from a column of ids (null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for b in batches:
            texts = [sp.decode(x.as_py() or []) for x in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return _mapped(encoded, run, "text string", id_col, ids_col)


def counts(docs: DataFrame, model: bytes, text_col: str = "text", out_col: str = "n_tokens",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and the number of ids of each row's text (null: 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        sizes: dict[str, int] = {}
        for b in batches:
            n = []
            for texts in groups(b.column(b.num_columns - 1)):
                chunks = [table.chunks(t) for t in texts]
                new = [c for c in set(chain.from_iterable(chunks)) if c not in sizes]
                if len(sizes) > table.max_chunks:
                    sizes, new = {}, list(set(chain.from_iterable(chunks)))
                for c, ids in zip(new, table.sp.encode(new, num_threads=1)):
                    sizes[c] = len(ids) if c else 1
                n += [sum(map(sizes.__getitem__, c)) for c in chunks]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*keep, out_col])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, F.col(text_col).alias("_t")).mapInArrow(run, f"{kinds}`{out_col}` bigint")


def _mapped(docs: DataFrame, run, columns: str, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"doc_id {kind}, {columns}"))
