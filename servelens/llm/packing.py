"""Cost-balanced packing of documents into fixed-length token sequences.

A document's ids are cut into pieces of ``seq_len``; a full piece is a sequence of its own.
The remainders are dealt to buckets of about ``bucket_rows`` documents by a hash of the row,
so no bucket depends on a key of the data or holds more than ``bucket_rows * seq_len`` ids.  Within a bucket the number of sequences is
the least that holds all ids.  Pieces go, longest first, to the sequence of lowest estimated
attention cost (``linear * n + quadratic * n * n`` per piece) that still has room; a piece
that fits nowhere is cut at the largest gap.  A bucket pads less than one sequence.

NULL and empty texts consist of the end id alone.  Repeated rows are packed once each.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servelens.llm.common import column_slices
from servelens.llm.encoding import chunk_encoder

PIECES = T.StructType([
    T.StructField("bucket", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType()),
])
PACKED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("sequence_cost", T.DoubleType()), T.StructField("ids", T.BinaryType()),
])


def assign(lengths: list[int], seq_len: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], list[float]]:
    """``(piece, start in piece, length, sequence, offset)`` for lengths given in descending order, and each sequence's cost."""
    import numpy as np

    n_seq = -(-sum(lengths) // seq_len)
    room = np.full(n_seq, seq_len)
    cost = np.zeros(n_seq)
    out = []
    for piece, left in enumerate(lengths):
        at = 0
        while left:
            fits = room >= left
            k = int(np.where(fits, cost, np.inf).argmin()) if fits.any() else int(room.argmax())
            n = min(left, int(room[k]))
            out.append((piece, at, n, k, seq_len - int(room[k])))
            room[k] -= n
            cost[k] += linear * n + quadratic * n * n
            at, left = at + n, left - n
    return out, cost.tolist()


def pack(docs: DataFrame, tokenizer_path: str, *, end_id: int, seq_len: int = 2048, linear: float = 1.0,
         quadratic: float = 1 / 2048, bucket_rows: int = 2000, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place (``doc_id``, ``text`` are read; other columns are not).

    ``with_ids`` also returns each piece's ids (little-endian unsigned 32-bit), which the
    training reader concatenates by ``sequence_id`` and ``offset``.  Buckets follow the number
    of rows, so a task's share does not grow with the corpus.
    """
    n_buckets = max(1, -(-docs.count() // bucket_rows))
    rows = docs.select(F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(n_buckets)).alias("bucket"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        encoder = chunk_encoder(tokenizer_path, False, end_id)
        schema = pa.schema([(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECES])
        for batch in batches:
            buckets, doc_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, texts in column_slices(batch, "text"):
                ids, counts = encoder.encode(texts)
                ids = ids.astype("<u4")
                stops = np.cumsum(counts)
                found: list[tuple] = []
                for i, (n, stop) in enumerate(zip(counts.tolist(), stops.tolist())):
                    own = ids[stop - n:stop]
                    for at in range(0, n, seq_len):
                        part = own[at:at + seq_len]
                        full = len(part) == seq_len
                        found.append((buckets[a + i], doc_ids[a + i], at, len(part), n,
                                      zlib.crc32(part.tobytes()) if full else None,
                                      part.tobytes() if with_ids or not full else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def place(table):
        import pyarrow as pa

        rows = table.to_pylist()
        rows.sort(key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"], r["start"], r["ids"] or b"", r["ids_crc32"] or 0))
        n_full = sum(r["length"] == seq_len for r in rows)
        base = rows[0]["bucket"] << 32
        out = [(r["doc_id"], r["start"], seq_len, r["ids_crc32"], r["doc_tokens"], base + k, 0,
                linear * seq_len + quadratic * seq_len * seq_len, r["ids"]) for k, r in enumerate(rows[:n_full])]
        rest = rows[n_full:]
        placed, costs = assign([r["length"] for r in rest], seq_len, linear, quadratic)
        for piece, at, n, k, offset in placed:
            r = rest[piece]
            ids = r["ids"][4 * at:4 * (at + n)]
            out.append((r["doc_id"], r["start"] + at, n, zlib.crc32(ids), r["doc_tokens"], base + n_full + k, offset,
                        costs[k], ids if with_ids else None))
        schema = pa.schema([(f.name, pa.binary() if f.name == "ids" else pa.float64() if f.name == "sequence_cost" else pa.int64())
                            for f in PACKED])
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    packed = rows.mapInArrow(cut, PIECES).groupBy("bucket").applyInArrow(place, PACKED)
    return packed if with_ids else packed.drop("ids")
