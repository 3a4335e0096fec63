"""Best-fit decreasing packing into windows of a fixed size.

A document longer than a window is first cut into full windows and a rest.  Pieces are then taken in descending
length, each into the open window with the least sufficient remaining capacity, found by a
segment tree over capacities; if none has room a new window opens.

Pieces are dealt at random into blocks of bounded size that are packed on their own, one task each, so no task holds
more than a block and only the last windows of a block stay open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import stored, values

WINDOW = 2048
#: Pieces of a block, on average.
BLOCK_PIECES = 8192


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each piece; ``lengths`` must be in descending order, from 1 to ``window``."""
    size = 1 << window.bit_length()  # leaves 0 .. window
    open_at = [0] * (2 * size)  # inner nodes and leaves: open windows with such remaining capacities
    with_room: list[list[int]] = [[] for _ in range(window + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    for k, need in enumerate(lengths.tolist()):
        at = need + size  # climb to the first node to the right that is not empty, then descend to its left-most leaf
        while not open_at[at]:
            while at & 1 and at > 1:
                at >>= 1
            if at <= 1:
                at = 0
                break
            at += 1
        if at:
            while at < size:
                at = 2 * at if open_at[2 * at] else 2 * at + 1
            room = at - size
            number = with_room[room].pop()
            while at:
                open_at[at] -= 1
                at >>= 1
        else:
            room, number, n = window, n, n + 1
        bins[k], offsets[k] = number, window - room
        if left := room - need:
            with_room[left].append(number)
            at = left + size
            while at:
                open_at[at] += 1
                at >>= 1
    return bins, offsets


def cut(docs: DataFrame, n_tokens: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: all columns of ``docs`` plus ``start`` and ``length``; full windows first, then the rest.
    A document without tokens (or with a null count) has no piece."""
    n = F.coalesce(F.col(f"`{n_tokens}`").cast("long"), F.lit(0).cast("long"))
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(window).cast("long")))
    rows = docs.where(n > 0).withColumn("__op_n", n).select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("start", "length")], "__op_n", F.explode_outer(starts).alias("start"))
    return rows.withColumn("length", F.least(F.lit(window).cast("long"), F.col("__op_n") - F.col("start"))).drop("__op_n")


def pack(pieces: DataFrame, length: str = "length", window: int = WINDOW, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """All columns of ``pieces`` plus ``sequence_id`` and ``offset`` (gapless from 0 in each sequence); one row per piece.

    ``pieces`` is written once to the shared folder, so that its blocks are the same for every attempt of a task; ties in
    length go by the other columns' order of rows.  A null or non-positive length, or one above ``window``, is an error of the
    caller and fails the job.  Repeated rows are pieces of their own; an empty table gives an empty result.
    """
    table = stored(pieces, "pieces")
    blocks = max(1, -(-table.count() // block_pieces))
    table = table.withColumns({"__op_row": F.monotonically_increasing_id()})
    table = table.withColumn("__op_block", F.pmod(F.xxhash64("__op_row"), F.lit(blocks)).cast("long"))

    def place(rows: pa.Table) -> pa.Table:
        n = rows.column(length).to_numpy()
        if len(n) and not (n.min() >= 1 and n.max() <= window):  # a null is a NaN here
            raise ValueError(f"piece lengths must be from 1 to {window}")
        order = np.lexsort((rows.column("__op_row").to_numpy(), -n))
        number, offset = best_fit_decreasing(n[order].astype(np.int64), window)
        first = rows.column("__op_block")[0].as_py() << 32
        return rows.take(order).append_column("sequence_id", pa.array(first + number)).append_column("offset", pa.array(offset))

    fields = [f for f in table.schema.fields if f.name not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    packed = table.select(*[F.col(f"`{f.name}`") for f in fields]).groupBy("__op_block").applyInArrow(place, schema)
    return packed.select(*[F.col(f"`{c}`") for c in keep], "sequence_id", "offset")


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 1, window: int = WINDOW) -> DataFrame:
    """Pieces of tokenized documents: doc_id, doc_tokens, start, length, ids_crc32 (of the piece's 32-bit ids).

    A null or empty text has the end id alone; texts of any length are encoded whole; other columns are not carried.
    """
    from binascii import crc32
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pulseboard.llm.tokens import encoder as encoder_of
        encoder = encoder_of(tokenizer)
        for batch in batches:
            sizes, sums = [], []
            for t in values(batch, "text"):
                ids = encoder.ids(t, end)
                sizes.append(len(ids))
                sums.append([crc32(ids[i:i + window].tobytes()) for i in range(0, len(ids), window)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))], names=["doc_id", "doc_tokens", "sums"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    counted = source.mapInArrow(encode, f"doc_id {id_type}, doc_tokens long, sums array<long>")
    pieces = cut(counted, "doc_tokens", window)
    return pieces.select("doc_id", "doc_tokens", "start", "length", F.get("sums", (F.col("start") / window).cast("int")).alias("ids_crc32"))
