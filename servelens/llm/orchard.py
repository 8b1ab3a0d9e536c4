"""Vector code compression: product codes whose entries are found by Orchard's search.

Vectors are cut into equal consecutive parts and every part position has a codebook of few entries.  The
nearest entry of a part is found by Orchard's method: each entry keeps the others of its codebook sorted
by distance; from a first guess the search goes along the list of the best entry so far, jumps to the list
of each improved entry, passes marked (visited) entries, and ends where the list lies beyond twice the
current distance, as no entry from there on can be nearer.  The search runs for many parts at once in
numpy lanes.  All arithmetic is on integers, so distances, ties and means are exact.

Only codebooks (``entries`` rows of a vector's length) and their sums pass through the driver.

Defined results: rows whose vector is NULL, empty, or holds NULL or non-finite components are dropped.  All
other vectors must have one length, a multiple of ``parts``, and integer components small enough for exact
64-bit distances (``ValueError`` / failed task otherwise).  A NULL id sorts last, repeated ids by vector,
and each row keeps its own result.  Fewer vectors than entries give smaller codebooks; an empty table gives
no rows.  Columns beside those named are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servelens.llm.common import slices, written

#: lanes (vectors) searched at once
TILE = 4096


class Codebooks:
    """Entries ``(parts, entries, width)`` with the distance-sorted neighbour lists of each entry."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.n_parts, self.size, self.width = entries.shape
        gaps = ((entries[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(-1)
        order = np.argsort(gaps, axis=-1, kind="stable")
        # the entry itself comes marked, the last place of each list lies beyond any distance
        far = np.full((*gaps.shape[:2], 1), np.iinfo(np.int64).max)
        self.gaps = np.concatenate([np.take_along_axis(gaps, order, -1), far], -1).reshape(-1)
        self.lists = np.concatenate([order, np.zeros_like(far)], -1).reshape(-1)
        self.flat = entries.reshape(-1, self.width)
        # first guess: the entry nearest in the component of the widest range
        self.axis = np.ptp(entries, axis=1).argmax(-1)

    def guess(self, x: np.ndarray) -> np.ndarray:
        found = np.empty(x.shape[:2], np.int64)
        for p, axis in enumerate(self.axis):
            line = self.entries[p, :, axis]
            order = np.argsort(line, kind="stable")
            middles = (line[order][1:] + line[order][:-1]) / 2
            found[:, p] = order[np.searchsorted(middles, x[:, p, axis])]
        return found.reshape(-1)

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry (ties to the lower index) and squared distance of each part of ``(rows, dim)`` vectors."""
        n = len(vectors)
        x = vectors.reshape(n, self.n_parts, self.width)
        best = self.guess(x)
        x = x.reshape(-1, self.width)
        base = np.tile(np.arange(self.n_parts) * self.size, n)
        distance = ((x - self.flat[base + best]) ** 2).sum(-1)
        marked = np.int64(1) << best if self.size < 63 else None
        seen = None if marked is not None else np.zeros((len(x), self.size), bool)
        if seen is not None:
            seen[np.arange(len(x)), best] = True
        place = np.zeros(len(x), np.int64)
        lanes = np.arange(len(x))
        while len(lanes):
            at = (base[lanes] + best[lanes]) * (self.size + 1) + place[lanes]
            # beyond twice the distance (four times its square) nothing is nearer or ties
            go = self.gaps[at] <= 4 * distance[lanes]
            lanes, at = lanes[go], at[go]
            entry = self.lists[at]
            place[lanes] += 1
            if seen is None:
                new = (marked[lanes] >> entry) & 1 == 0
            else:
                new = ~seen[lanes, entry]
            lane, entry = lanes[new], entry[new]
            if seen is None:
                marked[lane] |= np.int64(1) << entry
            else:
                seen[lane, entry] = True
            d = ((x[lane] - self.flat[base[lane] + entry]) ** 2).sum(-1)
            better = (d < distance[lane]) | ((d == distance[lane]) & (entry < best[lane]))
            lane, entry = lane[better], entry[better]
            best[lane], distance[lane], place[lane] = entry, d[better], 0
        return best.reshape(n, self.n_parts), distance.reshape(n, self.n_parts)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def integers(column, dim: int, n_parts: int) -> np.ndarray:
    """``floor(4096 x)`` of an Arrow list column as ``(rows, dim)``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(column) * dim or (np.diff(column.offsets.to_numpy()) != dim).any():
        raise ValueError(f"vectors must have {dim} components")
    scaled = np.floor(flat * 4096.0)
    if len(scaled) and 16.0 * np.abs(scaled).max() ** 2 * (dim // n_parts) >= 2.0 ** 63:
        raise ValueError("components are too large for exact 64-bit distances")
    return scaled.astype(np.int64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` of the rows that are kept."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.col(vector_col)
    return (vectors.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite))
            .select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.cast("array<double>").alias("v")))


def first_codebooks(rows: DataFrame, n_parts: int, n_entries: int) -> Codebooks | None:
    """Parts of the ``n_entries`` rows of least id (a top-k of bounded size)."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(n_entries).collect()
    if not least:
        return None
    dim = len(least[0].v)
    if dim % n_parts:
        raise ValueError(f"vectors of {dim} components do not divide into {n_parts} parts")
    import pyarrow as pa

    start = integers(pa.array([r.v for r in least], pa.list_(pa.float64())), dim, n_parts)
    return Codebooks(np.ascontiguousarray(start.reshape(len(start), n_parts, -1).transpose(1, 0, 2)))


def round_sums(rows: DataFrame, books: Codebooks) -> list:
    """``(cell, n, sums)`` of each used entry: one assignment of all rows, summed per task, then over tasks."""
    n_parts, size, width = books.n_parts, books.size, books.width
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("sums", T.ArrayType(T.LongType()))])

    def assign(batches):
        import pyarrow as pa

        cells = n_parts * size
        counts, sums = np.zeros(cells, np.int64), np.zeros((cells, width), np.int64)
        offsets = np.arange(n_parts) * size
        for batch in batches:
            for a in range(0, batch.num_rows, TILE):
                x = integers(batch.column(0).slice(a, TILE), n_parts * width, n_parts)
                best, _ = books.search(x)
                cell = (best + offsets).reshape(-1)
                order = np.argsort(cell, kind="stable")
                used, first = np.unique(cell[order], return_index=True)
                sums[used] += np.add.reduceat(x.reshape(-1, width)[order], first, axis=0)
                counts[used] += np.diff(np.append(first, len(cell)))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used]),
                                          pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["cell", "n", "sums"])

    partial = rows.select("v").mapInArrow(assign, schema)
    return partial.groupBy("cell").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect()


def refined(rows: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    for _ in range(rounds):
        entries = books.entries.copy()
        for r in round_sums(rows, books):
            entries[r.cell // books.size, r.cell % books.size] = [s // r.n for s in r.sums]
        books = Codebooks(entries)
    return books


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b in slices([1] * batch.num_rows, TILE):
                part = batch.slice(a, b - a)
                best, distance = books.search(integers(part.column(2), books.n_parts * books.width, books.n_parts))
                codes = [row.tobytes().hex() for row in best.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes, pa.string()),
                                                  pa.array(distance.sum(-1))], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "v").mapInArrow(encode, schema)


def compress(vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """Codes of all usable vectors and the codebooks (None without a usable vector); at most 256 entries."""
    rows = written(usable(vectors, id_col, vector_col, label_col), "orchard-rows")
    books = first_codebooks(rows, parts, entries)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    books = refined(rows, books, rounds)
    return encoded(rows, books), books


def code_digest(vectors: DataFrame, **parameters) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: codes with the error of all equal labels."""
    codes, books = compress(vectors, **parameters)
    codes = written(codes, "orchard-codes")
    # one row per label, summed before the shuffle; AQE broadcasts it where it is small and splits a hot label's rows where not
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    return (codes.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256")))


def _rounds_sql(parts: int, entries: int, rounds: int) -> str:
    nearest = """assigned{r} as materialized (
  select vec_id, label, p, arg_min(e, (d, e)) as e, min(d) as d from (
    select x.vec_id, x.label, x.p, b.e, sum((x.x - b.x) * (x.x - b.x)) as d
    from flat x join book{r} b on x.p = b.p and x.i = b.i group by all) group by all)"""
    mean = """book{n} as materialized (
  select b.p, b.e, b.i, coalesce(m.x, b.x) as x from book{r} b left join (
    select x.p, a.e, x.i, (sum(x.x) - ((sum(x.x) % count(*)) + count(*)) % count(*)) // count(*) as x
    from flat x join assigned{r} a on x.vec_id = a.vec_id and x.p = a.p group by all) m using (p, e, i))"""
    steps = [s for r in range(rounds) for s in (nearest.format(r=r), mean.format(r=r, n=r + 1))]
    return ",\n".join([*steps, nearest.format(r=rounds)])


#: DuckDB twin of :func:`code_digest` for tables with unique ids
CODES_SQL = f"""
with usable as (
  select vec_id, label, embedding from embeddings
  where embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
flat as materialized (
  select vec_id, label, (i - 1) // (n // 8) as p, (i - 1) % (n // 8) as i, floor(4096 * embedding[i]::double)::hugeint as x
  from (select *, len(embedding) as n, unnest(range(1, len(embedding) + 1)) as i from usable)),
book0 as materialized (
  select p, e, i, x from flat join (
    select vec_id, row_number() over (order by vec_id) - 1 as e from usable qualify e < 16) using (vec_id)),
{_rounds_sql(8, 16, 6)},
codes as (
  select vec_id, label, string_agg(printf('%02x', e), '' order by p) as code, sum(d) as error from assigned6 group by all)
select vec_id, code, error::bigint as error,
       (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(x::varchar, ',' order by p, e, i)) from book6) as codebooks_sha256
from codes
"""
