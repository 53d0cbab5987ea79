"""Packing by concatenate and cut (operator 5).

First pass: each task encodes its documents once, gives each the tokens that stand before it in the
task, and writes the ids (two bytes an id where the vocabulary allows) to the shared folder. The
totals of the tasks, one number for each, are summed up to global offsets. Second pass: with its
offset known, each document is cut at the multiples of the window by itself, so nothing is sorted
or gathered; its pieces are the boundary records of the sequences that they belong to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_characters
from .common import staged, text_batches

WINDOW, END_ID = 1024, 0
#: Texts of these characters alone are split alike by all libraries and Unicode versions.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ‐-‧‰-⁞]*+")


def default_vocabulary() -> str:
    """Where the installed public tokenizer files have this vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids as the tokenizers library gives them, at the speed of tiktoken where both agree.

    Both read the same vocabulary file. Texts with special tokens or with characters on whose class
    Unicode versions differ are encoded by the tokenizers library, all others by tiktoken.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        byte_of = {c: b for b, c in byte_characters().items()}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as little-endian integers of `kind`."""
        if PLAIN.fullmatch(text) and not (self.special and self.special.search(text)):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(self.kind)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(part, doc_id, start, n, ids): `start` counts the tokens before the document in its task."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, total = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], enc.kind).tobytes()
        for batch in batches:
            ids = [enc.encode(t or "").tobytes() + end for t in batch.column("text").to_pylist()]
            n = np.fromiter((len(x) // enc.kind.itemsize for x in ids), np.int64, len(ids))
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part)), batch.column("doc_id"), pa.array(before), pa.array(n), pa.array(ids, pa.binary())], names=["part", "doc_id", "start", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "part long, doc_id long, start long, n long, ids binary")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row for each piece.

    Null and empty texts consist of the end id alone. Repeated rows and null doc_ids are packed like
    any other row; texts of any length are cut freely. An empty table gives no rows. Only the last
    sequence can be short. Sequences follow the order of tasks and of rows in them, so they depend on
    how the input is split, not on timing: what is packed is read from the staged first pass. With
    `with_ids` each piece comes with its ids, so that sequences can be written out.
    """
    path = path or default_vocabulary()
    first = staged(encoded(docs, path), "packing")
    # One row for each task of the first pass: as many as input splits, whatever their size.
    totals = sorted((r.part, r.total) for r in first.groupBy("part").agg(F.sum("n").alias("total")).collect())
    sums = np.cumsum([0, *(t for _, t in totals)])
    bases = {part: int(s) for (part, _), s in zip(totals, sums[:-1], strict=True)}
    kind = encoder(path).kind.str

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            out: list[tuple] = []
            whole: list[list[int]] = []
            for part, doc, start, n, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "start", "n", "ids")), strict=True):
                at = bases[part] + start
                wide = np.frombuffer(raw, kind).astype("<u4").tobytes()
                a = 0
                while a < n:
                    b = min(n, a + window - (at + a) % window)
                    out.append((doc, a, b - a, zlib.crc32(wide[4 * a : 4 * b]), n, (at + a) // window, (at + a) % window))
                    if with_ids:
                        whole.append(np.frombuffer(wide[4 * a : 4 * b], "<u4").tolist())
                    a = b
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 7
            columns += [pa.array(whole, pa.list_(pa.int64()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"][: len(columns)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return first.mapInArrow(cut, schema + (", ids array<long>" if with_ids else ""))
