"""Packing of token ids into sequences by balanced cost.

Documents are encoded where they are read. A run of pieces that fills a bounded number of sequences is packed at once: a
document's full sequences are cut off first; the rest, in descending order of length, goes to the sequence with the lowest
estimated cost that has room, a linear plus a quadratic (attention) term per piece. There are only as many sequences as the ids need, so a
piece that fits nowhere is cut over the sequences with most room, and at most the last sequence of a run is padded.
Nothing is shuffled: a run never depends on another, and a lost task packs its runs again in the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import prepare
from marketflow.llm.tokens import KEPT, encoded, encoder

LENGTH = 2048
LINEAR, QUADRATIC = 1.0, 1.0 / 1024  # cost of a piece of n ids: LINEAR * n + QUADRATIC * n * n
RUN = 1024  # sequences packed at once


def pack(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths. Equal lengths keep their order."""
    out, rest = [], []
    total = sum(lengths)
    count = -(-total // length)
    sequence = 0
    for doc, n in enumerate(lengths):
        whole = n // length
        for k in range(whole):
            out.append((doc, k * length, length, sequence, 0))
            sequence += 1
        if n % length:
            rest.append((n % length, doc, whole * length))
    room = np.full(count - sequence, length)
    cost = np.zeros(count - sequence)
    rest.sort(key=lambda piece: (-piece[0], piece[1]))
    for n, doc, start in rest:
        while n:
            open_ = room >= n
            best = int(np.where(open_, cost, np.inf).argmin()) if open_.any() else int(room.argmax())
            size = min(n, int(room[best]))
            out.append((doc, start, size, sequence + best, length - int(room[best])))
            room[best] -= size
            cost[best] += LINEAR * size + QUADRATIC * size * size
            n, start = n - size, start + size
    return out


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, run: int = RUN, kept: int = KEPT) -> DataFrame:
    """Every id of every whole ``text`` (null is empty) and its ``end_id``, in pieces of sequences of at most ``length`` ids.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset. Repeated rows are separate documents, a null id
    stays null, other columns are not read. ``run`` bounds the sequences packed at once; a longer document makes a
    longer run, ``kept`` the pieces of text that a worker remembers. Sequence ids are unique, not dense. An empty table gives no piece.
    """
    prepare(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, 0
        keys, texts = [], []

        def out() -> pa.RecordBatch:
            nonlocal number
            rows = sorted(pack([len(t) for t in texts], length), key=lambda r: (r[3], r[4]))
            doc, start, size, sequence, offset = (np.array(c, np.int64) for c in zip(*rows))
            crc = [zlib.crc32(texts[d][s : s + n]) for d, s, n in zip(doc, start, size)]
            sequence += (part << 40) + number
            number += int(sequence.max() - sequence.min()) + 1
            return pa.RecordBatch.from_arrays([
                pa.array([keys[d] for d in doc], pa.int64()), pa.array(start), pa.array(size), pa.array(crc, pa.int64()),
                pa.array([len(texts[d]) for d in doc], pa.int64()), pa.array(sequence), pa.array(offset),
            ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        part = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            for first, ids, offsets in encoded(batch.column(1), encoder(tokenizer, kept)):
                for i in range(len(offsets) - 1):
                    keys.append(names[first + i])
                    texts.append(np.append(ids[offsets[i] : offsets[i + 1]], end_id).astype("<u4"))
                    held += len(texts[-1])
                    if held >= run * length:
                        yield out()
                        keys, texts, held = [], [], 0
        if texts:
            yield out()

    source = docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("part"))
    return source.mapInArrow(
        pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
