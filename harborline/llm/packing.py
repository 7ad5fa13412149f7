"""Packing by concatenate and cut.

Pass one gives every document its ids and its place inside its partition, and writes them to the shared folder. The
partitions' totals, a row each, give global offsets by a prefix sum. Pass two cuts the ids at multiples of the sequence
length: a document that crosses a boundary leaves a record on either side.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, written

END = 0  # id after each document
SPECIAL = {"<|endoftext|>": 50256}  # the vocabulary's special token
SEQUENCE = 1024
BROADCAST_PARTS = 1_000_000  # offsets of 16 bytes, one for each partition; more are joined by a shuffle


class Encoder:
    """Ids of the byte-level BPE vocabulary, as the tokenizers library gives them.

    A text is cut before every space that stands between two other characters, where the vocabulary's own splitting
    pattern cuts as well, and the pieces' ids are remembered. New pieces are encoded together, in one call, by the same
    vocabulary in rank form, and told apart by their bytes. Memory: at most `most` pieces, then it starts anew. A text
    with other runs of white space is encoded whole. Strings of special tokens in a text stand for their ids, as in the
    library's plain call; `special` maps them to ids, an empty one makes them ordinary text.
    """

    def __init__(self, vocabulary: str, most: int = 400_000, special: dict | None = None):
        import base64
        import re

        import tiktoken
        from public_tokenizers import PATTERN

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode_ordinary = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)
        self.special = SPECIAL if special is None else special
        self.parts = re.compile("|".join(map(re.escape, self.special)) or r"(?!)").split
        self.names = re.compile("|".join(map(re.escape, self.special)) or r"(?!)").findall
        self.odd = re.compile(r" (?:\s|\Z)").search
        self.pieces: dict[str, bytes] = {}
        self.most = most

    def learn(self, pieces: list[str]) -> None:
        if not pieces:
            return
        ids = np.array(self.encode_ordinary(" " + " ".join(pieces)), "<u2")
        ends = np.cumsum([len(x.encode()) + 1 for x in pieces])
        cuts = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1
        data = ids.tobytes()
        at = 0
        for piece, to in zip(pieces, (cuts * 2).tolist(), strict=True):
            self.pieces[piece] = data[at:to]
            at = to

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian 16-bit numbers; none for null."""
        marked = [i for i, t in enumerate(texts) if t and any(x in t for x in self.special)]
        if marked:
            found = set(marked)
            out = self.encode([None if i in found else t for i, t in enumerate(texts)])
            for i in marked:
                between = [np.array([self.special[x]], "<u2").tobytes() for x in self.names(texts[i])]
                out[i] = b"".join(x + y for x, y in zip(self.encode(self.parts(texts[i])), [*between, b""], strict=True))
            return out
        whole = lambda t: np.array(self.encode_ordinary(t), "<u2").tobytes()
        cut = [t.split(" ") if t and not self.odd(t) else None for t in texts]
        if len(self.pieces) > self.most:
            self.pieces.clear()
        self.learn(list({x for c in cut if c for x in c[1:]} - self.pieces.keys()))
        get = self.pieces.__getitem__
        return [b"" if not t else whole(t) if c is None else whole(c[0]) + b"".join(map(get, c[1:])) for t, c in zip(texts, cut, strict=True)]


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encode(vocabulary: str | None):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, part, at = Encoder(vocabulary or vocabulary_path()), TaskContext.get().partitionId(), 0
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for i in range(0, len(ids), 256):  # small results, whatever the texts' lengths
                out = [x + end for x in encoder.encode(texts.slice(i, 256).to_pylist())]
                n = np.array([len(x) // 2 for x in out], np.int64)
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays([ids.slice(i, 256).cast(pa.int64()), pa.array([part] * len(out), pa.int32()), pa.array(before), pa.array(n), pa.array(out, pa.binary())], ["doc_id", "part", "before", "n", "ids"])

    return run


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, part, before, n, ids), written: ids as 16-bit numbers with END, `before` ids earlier in the partition."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(mapped(d, _encode(vocabulary), "doc_id long, part int, before long, n long, ids binary"), "ids")


def _cut(sequence: int):
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            rows = []
            for doc, at, ids in zip(batch.column("doc_id").to_pylist(), batch.column("at").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                x = np.frombuffer(ids, "<u2").astype("<u4")
                start = 0
                while start < len(x):
                    to = min(len(x), start + sequence - (at + start) % sequence)
                    rows.append((doc, start, to - start, zlib.crc32(x[start:to].tobytes()), len(x), (at + start) // sequence, (at + start) % sequence))
                    start = to
                    if len(rows) >= 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document is one or more pieces; a null or empty text is its END alone. Sequences hold exactly `sequence` ids,
    but for the last, so padding is less than one sequence in all. Repeated documents are packed as often as they stand
    there. Empty tables give no rows; further columns are ignored.
    """
    e = encoded(docs, vocabulary)
    totals = e.groupBy("part").agg(F.sum("n").alias("total"))  # a row for each partition; one task adds them up
    offsets = totals.select(F.col("part").alias("of_part"), F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    offsets = written(offsets, "offsets")
    few = F.broadcast(offsets) if offsets.count() <= BROADCAST_PARTS else offsets
    placed = e.join(few, F.col("part") == F.col("of_part")).select("doc_id", (F.col("before") + F.col("offset")).alias("at"), "ids")
    return mapped(placed, _cut(sequence), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
