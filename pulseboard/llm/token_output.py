"""Packed token ids in binary files, and their reader.

Tasks encode their rows and fill blocks of bounded size.  A block's pieces are packed best-fit decreasing and written as one
file of arrays: ``ids`` (sequences x window, unsigned, padded), ``cu_lengths`` (cumulative segment lengths of
all sequences, each starting again from 0), ``cu_rows`` (where each sequence's lengths begin) and ``resets`` (one bit per token: the position
counter restarts there).  A Parquet index names each piece's place.  File names differ by attempt, and the index holds those of the attempts that succeeded.
"""

from __future__ import annotations

import io
from binascii import crc32
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import shared_folder, stored, values
from pulseboard.llm.packing import WINDOW, best_fit_decreasing

#: Tokens and documents of a block; memory of a task follows the first, and one document.
BLOCK_TOKENS = 4_000_000
BLOCK_DOCS = 16_384
#: Tasks that read files, at most.
MOST_TASKS = 20_000


def pack_block(docs: list[np.ndarray], window: int, pad: int, dtype: str) -> tuple[dict[str, np.ndarray], list[tuple[int, int, int, int, int]]]:
    """Arrays of a block, and its pieces as (document number, start, length, sequence, offset)."""
    pieces = [(k, s, min(window, len(ids) - s)) for k, ids in enumerate(docs) for s in range(0, len(ids), window)]
    pieces.sort(key=lambda p: -p[2])
    rows, offsets = best_fit_decreasing(np.array([p[2] for p in pieces], np.int64), window)
    n = int(rows.max()) + 1 if len(rows) else 0
    ids, resets = np.full((n, window), pad, dtype), np.zeros((n, window), bool)
    for (k, s, m), r, o in zip(pieces, rows.tolist(), offsets.tolist(), strict=True):
        ids[r, o:o + m] = docs[k][s:s + m]
        resets[r, o] = True
    used = np.zeros(n, np.int64)
    np.maximum.at(used, rows, offsets + np.array([p[2] for p in pieces], np.int64))
    starts = [np.flatnonzero(x) for x in resets]
    lengths = [np.append(x, u) for x, u in zip(starts, used, strict=True)]
    arrays = {"ids": ids, "resets": np.packbits(resets, axis=1),
              "cu_lengths": np.concatenate(lengths).astype("<u4") if n else np.zeros(0, "<u4"),
              "cu_rows": np.cumsum([0, *map(len, lengths)]).astype("<u8")}
    return arrays, [(*p, r, o) for p, r, o in zip(pieces, rows.tolist(), offsets.tolist(), strict=True)]


def write_packed(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 1, pad: int = 0,
                 window: int = WINDOW, dtype: str = "<u2", folder: str | None = None) -> DataFrame:
    """Write all documents and return the index, one row per piece: doc_id, doc_tokens, start, length, path, row, offset.

    A null or empty text is the end id alone; an overlong text is cut into pieces, without loss; repeated rows are documents of
    their own; a null id stays null; an empty table writes nothing; other columns are ignored.  ``dtype`` must hold every id, else the job fails.
    """
    folder = folder or shared_folder(docs.sparkSession, "packed-ids")
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    most = np.iinfo(dtype).max

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pulseboard.llm.files import attempt_name, writer
        from pulseboard.llm.tokens import encoder as encoder_of
        encoder, name, block = encoder_of(tokenizer), attempt_name(), 0
        keys, held, n = [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{name}-{block:05d}.npz"
            arrays, pieces = pack_block(held, window, pad, dtype)
            data = io.BytesIO()
            np.savez(data, **arrays)
            with writer(path) as out:
                out.write(data.getbuffer())
            k, start, length, row, offset = zip(*pieces, strict=True)
            columns = [pa.array([keys[i] for i in k], kind), [len(held[i]) for i in k], start, length, [path] * len(k), row, offset]
            return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["doc_id", "doc_tokens", "start", "length", "path", "row", "offset"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for key, t in values(batch, "doc_id", "text"):
                ids = encoder.ids(t, end)
                if ids.max() > most or pad > most:
                    raise ValueError(f"an id is above {most}")
                keys.append(key)
                held.append(ids)
                n += len(ids)
                if n >= BLOCK_TOKENS or len(held) >= BLOCK_DOCS:
                    yield flush()
                    keys, held, n, block = [], [], 0, block + 1
        if held:
            yield flush()

    id_type = source.schema["doc_id"].dataType.simpleString()
    return stored(source.mapInArrow(write, f"doc_id {id_type}, doc_tokens long, start long, length long, path string, row long, offset long"), "packed-index")


def read_packed(index: DataFrame) -> DataFrame:
    """Read the files back, one task per file, check them against the index, and return its rows plus ``ids_crc32``.

    A segment that is missing, longer, shorter or without its position reset fails the job.
    """

    def read(rows: pa.Table) -> pa.Table:
        from pulseboard.llm.files import reader
        path = rows.column("path")[0].as_py()
        places = list(values(rows, "row", "offset", "length"))
        with reader(path) as f:
            data = np.load(io.BytesIO(f.read()))
        ids, cu, at = data["ids"], data["cu_lengths"], data["cu_rows"]
        resets = np.unpackbits(data["resets"], axis=1)
        found = {(r, int(a)): int(b - a) for r in range(len(ids)) for a, b in zip(cu[at[r]:at[r + 1] - 1], cu[at[r] + 1:at[r + 1]], strict=True)}
        want = {(r, o): m for r, o, m in places}
        if found != want or int(resets.sum()) != len(want):
            raise ValueError(f"{path} does not hold the segments of its index")
        sums = [crc32(ids[r, o:o + m].astype("<u4").tobytes()) for r, o, m in places]
        return rows.append_column("ids_crc32", pa.array(sums, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields) + ", ids_crc32 long"
    # a number of its own: by their bytes the index's rows would go to a few tasks
    files = index.agg(F.count_distinct("path")).first()[0]
    return index.repartition(max(1, min(files, MOST_TASKS)), "path").groupBy("path").applyInArrow(read, schema)
