"""Adaptive context-mixing range coder for token ids, and id files made of its blocks.

A block holds at most ``BLOCK`` ids and is coded on its own: every model starts anew, and a header
carries the id count and a checksum.  Per id three predictions are made: the id seen last after the two ids before
(order 2), the one seen last after the id before (order 1), and a distribution over magnitude classes of
ids (order 0), renewed every ``_RENEWAL`` ids from its counts.  The chance that order 2 is right is mixed from two adaptive
estimates, chosen by the confidences of order 2 and of order 1; what is left is shared between order 1 and order 0 in the same
way.  One interval step codes the outcome; the place within the class, which no model predicts, follows the coder's words as plain bits.
All arithmetic is on integers, or on floats that hold the integers and the whole parts of their quotients exactly.

The blocks of a segment are coded side by side as lanes of numpy arrays.  A segment holds whole documents
(about ``SEGMENT`` ids) and is one row of the file: document ids and counts, and its blocks.  A longer document
is cut into numbered parts of ``SEGMENT`` ids, each a row of its own, so the coder's memory has a bound; its id count and
checksum are joined from those of its parts.  Files are Parquet written by Spark, in ascending ``doc_id``; a lost task
writes its file again.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servelens.llm.common import column_slices, shared_path, written
from servelens.llm.encoding import chunk_encoder

BLOCK = 4096
SEGMENT = 2048 * BLOCK
#: chunks whose ids a Python worker keeps, and bytes of text that it splits at once
MAX_CHUNKS, SLICE = 600_000, 8 << 20
#: name, version, ids, crc32 of the ids as little-endian unsigned 32-bit, 16-bit words of the range coder; bits of misses follow the words
_HEAD = struct.Struct("<4sBIII")
_NAME, _VERSION = b"CMRC", 2
_SLOTS = 11  # bits of a context table
_CLASSES = 30  # ids below 8, then one class per binary magnitude
_PART_BITS, _RENEWAL = 8, 128  # class shares are parts of 2 ** 8, renewed after so many ids
_PARTS = 1 << _PART_BITS
_LEAST = 4096  # of 2 ** 16, left to the others by an estimate: order 0 keeps 2 ** 8 at least, one for each part

_BOTTOM, _TOP = 1 << 32, 1 << 48


def _class_of(ids: np.ndarray) -> np.ndarray:
    """Class of each id."""
    bits = np.frexp(ids.astype(np.float64))[1]  # binary magnitude, exact below 2 ** 53
    return np.maximum(bits - 3, 0).astype(np.int64)


#: class: first id and free bits
_FIRST = np.array([0, *[8 << k for k in range(_CLASSES - 1)]], np.int64)
_FREE = np.array([3, *[3 + k for k in range(_CLASSES - 1)]], np.int64)
_MASK = (1 << _FREE) - 1


def _slot1(last: np.ndarray) -> np.ndarray:
    """Place in a context table; products are taken modulo 2 ** 32."""
    return (last * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)


def _slot2(last: np.ndarray, last2: np.ndarray) -> np.ndarray:
    return (last * np.uint32(0x85EBCA6B) ^ last2 * np.uint32(0xC2B2AE35)) >> np.uint32(32 - _SLOTS)


class _Models:
    """Predictions and their updates for ``lanes`` blocks of ids in ``classes`` classes."""

    def __init__(self, lanes: int, classes: int):
        lane = np.arange(lanes, dtype=np.int64)
        self.base, self.by8, self.by16, self.by4, self.part = lane << _SLOTS, lane << 3, lane << 4, lane << 2, lane << _PART_BITS
        kind = np.int32 if classes <= 26 else np.int64
        self.order1 = np.zeros(lanes << _SLOTS, kind)  # id << 2 | confidence
        self.order2 = np.zeros(lanes << _SLOTS, kind)
        self.by2 = np.full(lanes * 8, 1 << 14, np.int32)
        self.by1 = np.full(lanes * 16, 1 << 14, np.int32)
        self.rest = np.full(lanes * 4, 1 << 13, np.int32)
        self.first = lane * classes
        self.counts = np.zeros((lanes, classes), np.int32)
        self.renew(0)
        self.last = np.zeros(lanes, np.uint32)
        self.last2 = np.zeros(lanes, np.uint32)

    def renew(self, step: int) -> None:
        """Shares of the classes from the counts of misses, soon after the start and every ``_RENEWAL`` steps; older counts weigh half."""
        if step % _RENEWAL and step not in (8, 16, 32, 64):
            return
        lanes, classes = self.counts.shape
        share = 1 + self.counts * (_PARTS - classes) // np.maximum(self.counts.sum(axis=1, keepdims=True), 1)
        share[np.arange(lanes), self.counts.argmax(axis=1)] += _PARTS - share.sum(axis=1)
        self.share, self.below = share.astype(np.int32).ravel(), (np.cumsum(share, axis=1) - share).astype(np.int32).ravel()
        self.class_at = np.repeat(np.tile(np.arange(classes, dtype=np.uint8), lanes), share.ravel())
        if step % _RENEWAL == 0:
            self.counts >>= 1

    def predict(self, m: int | None = None):
        """Frequencies (of 2 ** 16) of order 2 and of order 1 being right after the last ids."""
        return self.predict_at(self.base + _slot1(self.last), self.base + _slot2(self.last, self.last2))

    def predict_at(self, at1: np.ndarray, at2: np.ndarray):
        self.at1, self.at2 = at1, at2
        self.e1, self.e2 = self.order1.take(at1), self.order2.take(at2)
        self.c1, self.c2 = self.e1 & 3, self.e2 & 3
        self.id1, self.id2 = self.e1 >> 2, self.e2 >> 2
        self.differ = self.id1 != self.id2
        self.k2 = self.by8 + ((self.c2 << 1) + self.differ)
        self.k1 = self.by16 + ((self.c2 << 2) + self.c1)
        self.k0 = self.by4 + self.c1
        self.p2, self.p1, self.p0 = self.by2.take(self.k2), self.by1.take(self.k1), self.rest.take(self.k0)
        f2 = np.minimum(np.maximum((self.p2 + self.p1) >> 1, 64), 65536 - _LEAST)
        # order 1 keeps a share, as it may be right however unlikely it looks
        f1 = (65536 - f2) * (np.minimum(np.maximum(self.p0, 64), 65536 - _LEAST) >> 1) >> 15
        return f2, f1 * self.differ

    def interval(self, at: np.ndarray, f2: np.ndarray, f1: np.ndarray, f12: np.ndarray, part: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, miss: np.ndarray):
        """Start and size (of 2 ** 16) of an outcome, where ``at`` is the place of the lane's class."""
        start = np.where(miss, f12 + part * self.below.take(at), f2 * hit1)
        return start, np.where(miss, part * self.share.take(at), np.where(hit2, f2, f1))

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, miss: np.ndarray, at: np.ndarray) -> None:
        entry = ids << 2
        self.order2[self.at2] = np.where(hit2, self.e2 + (self.c2 < 3), np.where(self.c2 > 0, self.e2 - 1, entry))
        self.order1[self.at1] = np.where(self.id1 == ids, self.e1 + (self.c1 < 3), np.where(self.c1 > 0, self.e1 - 1, entry))
        target = hit2.astype(np.int32) << 16
        self.by2[self.k2] = self.p2 + ((target - self.p2) >> 5)
        self.by1[self.k1] = self.p1 + ((target - self.p1) >> 5)
        # order 1 learns where it was asked: order 2 was wrong and held another id
        self.rest[self.k0] = self.p0 + (((hit1.astype(np.int32) << 16) - self.p0) >> 5) * (self.differ & ~hit2)
        self.counts.reshape(-1)[at] += miss
        self.last2, self.last = self.last, ids.astype(np.uint32)


def _lanes(n: int) -> tuple[int, int]:
    """Number of blocks and length of the last."""
    return -(-n // BLOCK), (n - 1) % BLOCK + 1


def _packed(values: np.ndarray, bits: np.ndarray, per_lane: np.ndarray) -> list[bytes]:
    """A bit string per lane of its values, which stand lane after lane; lowest bits come first."""
    done = np.concatenate(([0], np.cumsum(bits)))
    ends = np.cumsum(per_lane)
    before = done[ends - per_lane]
    length = done[ends] - before
    words = (length >> 5) + 2
    base = np.cumsum(words) - words
    at = done[:-1] + np.repeat((base << 5) - before, per_lane)
    word, shifted = at >> 5, values << (at & 31)
    # the fields of a word do not overlap, so that their sum is exact and below 2 ** 32
    n = int(words.sum())
    raw = (np.bincount(word, shifted & 0xFFFFFFFF, n) + np.bincount(word + 1, shifted >> 32, n)).astype("<u4").tobytes()
    return [raw[4 * b:4 * b + (k + 7 >> 3)] for b, k in zip(base.tolist(), length.tolist())]


def encode_blocks(ids: np.ndarray, classes: int = _CLASSES) -> list[bytes]:
    """Blocks of a run of ids (unsigned, below ``2 ** (classes + 2)``).  Zeros are coded behind the last block's ids, up to the others' length."""
    n = len(ids)
    if not n:
        return []
    lanes, tail = _lanes(n)
    steps = BLOCK if lanes > 1 else tail
    flat = np.zeros(lanes * BLOCK, np.uint32)
    flat[:n] = ids
    by_lane = flat.reshape(lanes, BLOCK)
    model = _Models(lanes, classes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, _TOP - 1, np.int64)
    width = BLOCK + 8  # a step emits a word at most
    out = np.zeros(lanes * width, np.uint16)
    row = np.arange(lanes, dtype=np.int64) * width
    filled = row.copy()
    missed = np.zeros((BLOCK, lanes), bool)
    for begin in range(0, steps, _RENEWAL):
        # two ids before the first step stand above those of the steps
        end = min(begin + _RENEWAL, steps)
        grid = np.zeros((end - begin + 2, lanes), np.uint32)
        from_ = max(begin - 2, 0)
        grid[from_ - begin + 2:] = by_lane[:, from_:end].T
        class_grid = _class_of(grid[2:]) + model.first
        at1 = model.base + _slot1(grid[1:-1])
        at2 = model.base + _slot2(grid[1:-1], grid[:-2])
        grid = grid.astype(model.order1.dtype)
        for t in range(end - begin):
            model.renew(begin + t)
            x, c = grid[t + 2], class_grid[t]
            f2, f1 = model.predict_at(at1[t], at2[t])
            hit2 = model.id2 == x
            hit1 = (model.id1 == x) & ~hit2
            miss = missed[begin + t] = ~(hit2 | hit1)
            f12 = f2 + f1
            start, size = model.interval(c, f2, f1, f12, 65536 - f12 >> _PART_BITS, hit2, hit1, miss)
            r = span >> 16
            low += r * start
            span = r * size
            over = np.flatnonzero(low >= _TOP)
            if len(over):
                low[over] -= _TOP
                place = filled[over] - 1
                while len(place):  # a carry runs on through words that are full
                    out[place] += np.uint16(1)
                    place = place[out[place] == 0] - 1
            at = np.flatnonzero(span < _BOTTOM)
            if len(at):
                place, leaving = filled[at], low[at]
                out[place] = leaving >> 32
                filled[at] = place + 1
                low[at] = (leaving & (_BOTTOM - 1)) << 16
                span[at] <<= 16
            model.update(x, hit2, hit1, miss, c)
    for k in (32, 16, 0):
        out[filled] = low >> k & 0xFFFF
        filled += 1
    bits = []
    for a in range(0, lanes, 64):
        chosen = missed[:, a:a + 64].T
        values = by_lane[a:a + 64][chosen].astype(np.int64)
        found = _class_of(values)
        bits += _packed(values - _FIRST[found], _FREE[found], chosen.sum(axis=1))
    blocks, out = [], out.astype(">u2")
    for i, (a, b) in enumerate(zip(row.tolist(), filled.tolist())):
        own = ids[i * BLOCK:(i + 1) * BLOCK].astype("<u4")
        blocks.append(_HEAD.pack(_NAME, _VERSION, len(own), zlib.crc32(own.tobytes()), b - a) + out[a:b].tobytes() + bits[i])
    return blocks


def decode_blocks(blocks: list[bytes], classes: int = _CLASSES) -> np.ndarray:
    """All ids of a run's blocks; a block that fails its checksum raises (its values are kept in range until then)."""
    if not blocks:
        return np.zeros(0, np.uint32)
    if any(len(b) < _HEAD.size or b[:5] != _HEAD.pack(_NAME, _VERSION, 0, 0, 0)[:5] for b in blocks):
        raise ValueError("not a block of this coder")
    heads = [_HEAD.unpack_from(b) for b in blocks]
    lanes, tail = len(blocks), heads[-1][2]
    if any(h[2] != BLOCK for h in heads[:-1]) or not 0 < tail <= BLOCK:
        raise ValueError("blocks are not those of one run")
    n_words = np.array([h[4] for h in heads], np.int64)
    stops = _HEAD.size + 2 * n_words
    sizes = np.array([len(b) for b in blocks], np.int64) - stops
    if (sizes < 0).any() or (n_words < 3).any():
        raise ValueError("a block is cut off")
    words = np.frombuffer(b"".join(b[_HEAD.size:k] for b, k in zip(blocks, stops.tolist())), ">u2").astype(np.uint16)
    read = np.cumsum(n_words) - n_words
    raw = np.frombuffer(b"".join([*(b[k:] + bytes(-(len(b) - k) % 4) for b, k in zip(blocks, stops.tolist())), bytes(8)]), "<u4").astype(np.int64)
    window = raw[:-1] | raw[1:] << 32  # each four bytes and the next four
    sizes = sizes + 3 >> 2
    bit = (np.cumsum(sizes) - sizes) << 5
    model = _Models(lanes, classes)
    span = np.full(lanes, _TOP - 1, np.int64)
    code = words[read].astype(np.int64) << 32 | words[read + 1].astype(np.int64) << 16 | words[read + 2]
    code = np.minimum(code, span - 1)  # a broken block's code may lie outside
    read += 3
    steps = BLOCK if lanes > 1 else tail
    grid = np.zeros((steps, lanes), np.uint32)
    for t in range(steps):
        model.renew(t)
        f2, f1 = model.predict()
        f12 = f2 + f1
        part = 65536 - f12 >> _PART_BITS
        r = span >> 16
        # quotients of numbers below 2 ** 48 and 2 ** 32: the whole part of the float is exact
        value = np.minimum(code / r, 65535).astype(np.int32)
        hit2 = value < f2
        miss = value >= f12
        hit1 = ~(hit2 | miss)
        share = np.minimum(np.maximum(value - f12, 0) / part, _PARTS - 1).astype(np.int32)
        c = model.class_at.take(model.part + share).astype(np.int64)
        class_place = model.first + c
        start, size = model.interval(class_place, f2, f1, f12, part, hit2, hit1, miss)
        code -= r * start
        span = r * size
        at = np.flatnonzero(span < _BOTTOM)
        if len(at):
            place = read[at]
            wider = span[at] << 16
            code[at] = np.minimum(code[at] << 16 | words.take(place, mode="clip"), wider - 1)
            read[at] = place + 1
            span[at] = wider
        place = window.take(bit >> 5, mode="clip") >> (bit & 31) & _MASK.take(c)
        bit += _FREE.take(c) * miss
        x = np.where(miss, (_FIRST.take(c) + place).astype(model.order1.dtype), np.where(hit2, model.id2, model.id1))
        grid[t] = x
        model.update(x, hit2, hit1, miss, class_place)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:(lanes - 1) * BLOCK + tail]
    for i, h in enumerate(heads):
        if zlib.crc32(ids[i * BLOCK:(i + 1) * BLOCK].astype("<u4").tobytes()) != h[3]:
            raise ValueError(f"block {i} fails its checksum")
    return ids


FILE_SCHEMA = ("partition int, segment int, part int, n_ids long, classes int, doc_ids array<long>, counts array<long>, blocks array<binary>")


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, *, end_id: int = 0, space_leads: bool = True, size: int = SEGMENT) -> None:
    """Ids of every whole text (NULL as empty) and an end id, in ascending ``doc_id`` (NULL first, ties by text).

    ``part`` is NULL in rows of whole documents; a document of more than ``size`` ids has rows with parts 0, 1, ...
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = chunk_encoder(tokenizer_path, space_leads, end_id, MAX_CHUNKS)
        classes = max(2, int(encoder.vocab_size - 1).bit_length() - 2)
        part, segment = TaskContext.get().partitionId(), 0
        doc_ids, counts, ids, held = [], [], [], 0
        schema = pa.schema([("partition", pa.int32()), ("segment", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("classes", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary()))])

        def row(doc_ids, counts, ids, cut=None):
            nonlocal segment
            values = (part, segment, cut, len(ids), classes, doc_ids, counts, encode_blocks(ids, classes))
            segment += 1
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, schema)], schema=schema)

        def runs(n_found):
            """Document ranges of a slice: each document longer than a segment alone, what lies between together."""
            first = 0
            for at in np.flatnonzero(n_found > size).tolist():
                if at > first:
                    yield first, at
                yield at, at + 1
                first = at + 1
            if first < len(n_found):
                yield first, len(n_found)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, texts in column_slices(batch, "text", SLICE):
                found, n_found = encoder.encode(texts)
                ends = np.concatenate(([0], np.cumsum(n_found)))
                for i, j in runs(n_found):
                    own = found[ends[i]:ends[j]]
                    long = j == i + 1 and len(own) > size
                    if not long:
                        doc_ids += keys[a + i:a + j]
                        counts += n_found[i:j].tolist()
                        ids.append(own)
                        held += len(own)
                    if held and (long or held >= size):
                        yield row(doc_ids, counts, np.concatenate(ids))
                        doc_ids, counts, ids, held = [], [], [], 0
                    if long:
                        for cut, at in enumerate(range(0, len(own), size)):
                            piece = own[at:at + size]
                            yield row([keys[a + i]], [len(piece)], piece, cut)
        if held:
            yield row(doc_ids, counts, np.concatenate(ids))

    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


_CRC = 0xEDB88320  # the polynomial of crc32, highest power in the lowest bit


def _product(a: int, b: int) -> int:
    """Product of two polynomials modulo that of crc32."""
    out = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            out ^= b
        b = b >> 1 ^ (_CRC if b & 1 else 0)
    return out


def joined_crc(parts) -> int:
    """crc32 of joined byte strings, from ``(length, crc32)`` of each."""
    total = 0
    for n, crc in parts:
        shift, square = 1 << 31, 1 << 23  # 1, and the power of one byte
        while n:
            if n & 1:
                shift = _product(shift, square)
            square, n = _product(square, square), n >> 1
        total = _product(shift, total) ^ crc
    return total


def _starts(files: DataFrame) -> DataFrame:
    """Ids before each row of the files: before its partition (a row per partition is summed) and in it."""
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = files.groupBy("partition").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("partition", before(Window.orderBy("partition")).alias("base"))
    inside = files.select("partition", "segment", before(Window.partitionBy("partition").orderBy("segment")).alias("inside"))
    return inside.join(parts, "partition").select("partition", "segment", (F.col("base") + F.col("inside")).alias("start"))


def read_documents(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files; a broken block raises."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    starts = written(_starts(files.select("partition", "segment", "n_ids")), "ids-starts")

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                            ("partition", pa.int32()), ("first", pa.int32())])
        for batch in batches:
            for i in range(batch.num_rows):
                part, first, start, classes, doc_ids, counts, blocks = (batch.column(c)[i].as_py() for c in range(7))
                raw = memoryview(decode_blocks(blocks, classes).astype("<u4").tobytes())
                counts = np.array(counts, np.int64)
                stops = np.cumsum(counts)
                crcs = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(stops.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + stops - counts), pa.array(counts), pa.array(crcs, pa.int64()),
                                                  pa.array([part] * len(crcs), pa.int32()), pa.array([first] * len(crcs), pa.int32())], schema=schema)

    def decoded(rows: DataFrame) -> DataFrame:
        return rows.join(starts, ["partition", "segment"]).select(
            "partition", (F.col("segment") - F.coalesce("part", F.lit(0))).alias("first"), "start", "classes", "doc_ids", "counts", "blocks").mapInArrow(
            run, "doc_id long, start long, n_tokens long, ids_crc32 long, partition int, first int")

    def join_parts(batches):
        import pyarrow as pa

        for batch in batches:
            crcs = [joined_crc((4 * p["n_tokens"], p["ids_crc32"]) for p in parts) for parts in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(crcs, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    whole = decoded(files.where(F.col("part").isNull())).drop("partition", "first")
    # a row per part; the filter skips the row groups of whole documents
    parts = decoded(files.where(F.col("part").isNotNull())).groupBy("partition", "first").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "n_tokens", "ids_crc32"))).alias("parts"))
    cut = parts.select("doc_id", "start", "n_tokens", "parts").mapInArrow(join_parts, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return whole.unionByName(cut)


def write_and_read(docs: DataFrame, tokenizer_path: str, *, end_id: int = 0, size: int = SEGMENT) -> DataFrame:
    """Write the id files to the shared folder and return what is read back."""
    path = shared_path(docs.sparkSession, "id-files")
    write_ids(docs, tokenizer_path, path, end_id=end_id, size=size)
    return read_documents(docs.sparkSession, path)
