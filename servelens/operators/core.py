"""Reusable relational building blocks.

Each function maps DataFrames to a DataFrame with built-in Spark operators
only.  Windows are always partitioned by a key the caller names; the only
unpartitioned windows are over inputs that are bounded by construction (one
row per period of one model) and say so in their docstring.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------

def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                   suffix: str = "__r", packed: bool | None = None) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL.

    With few keys the ``<=>`` conditions are the join keys.  With many keys
    (``packed``, default for more than four) both sides pack the keys into one
    struct and join on struct equality, which compares field by field with
    NULL equal to NULL: the shuffle partitions and sorts on a single key
    instead of two expressions per column.  Right-side key columns are
    dropped; other right columns that clash with left names are dropped too
    (the left value wins, as with an ``_DROP`` suffix).
    """
    keys = list(keys)
    packed = len(keys) > 4 if packed is None else packed
    r = right.select(*[F.col(c).alias(c + suffix) if c in keys else F.col(c) for c in right.columns])
    clash = [c for c in right.columns if c not in keys and c in left.columns]
    r = r.drop(*clash)
    if not packed:
        cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[k + suffix]) for k in keys])
        return left.join(r, cond, how).drop(*[k + suffix for k in keys])
    # the keys travel in the struct only and are taken out of it after the join
    lk = left.select(F.struct(*[F.col(k) for k in keys]).alias("__k"), *[F.col(f"`{c}`") for c in left.columns if c not in keys])
    rk = r.withColumn("__k" + suffix, F.struct(*[F.col(k + suffix).alias(k) for k in keys]))
    j = lk.join(rk, lk["__k"] == rk["__k" + suffix], how)
    j = j.drop("__k" + suffix, *[k + suffix for k in keys])
    return j.select(*[F.col(f"__k.`{c}`").alias(c) if c in keys else F.col(f"`{c}`") for c in left.columns],
                    *[F.col(f"`{c}`") for c in j.columns if c != "__k" and c not in left.columns])


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder
    (``spark.checkpoint.dir``) and continue from the written table.

    Used where the modelled process persists a table anyway (per-account
    constraint values) or where a costly intermediate is read twice.  The
    plan is computed once (a reliable RDD checkpoint would compute it twice
    and store Java-serialised rows); lineage is cut, so a lost executor
    recomputes nothing before this point, and later plans stay small.
    """
    import uuid
    from servelens.session import ensure_checkpoint_dir
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/servelens-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def semi_join(df: DataFrame, keys_df: DataFrame, on, anti: bool = False) -> DataFrame:
    """Keep (or with ``anti`` drop) rows whose key occurs in ``keys_df``."""
    return df.join(keys_df, on, "left_anti" if anti else "left_semi")


def substring_lookup(targets: DataFrame, source: DataFrame, target_col: str, source_col: str,
                     append: Sequence[str], contains: bool = False) -> DataFrame:
    """Find-any lookup (J12): append ``append`` columns of the ``source`` row
    whose ``source_col`` occurs in ``target_col``; unmatched rows keep NULLs.

    The default is an equi-join (the values are whole names).  With
    ``contains=True`` a substring match is used and the longest matching
    source value wins, ties broken by the appended values (deterministic, NULLs
    last).  That path is an equi-join too: each distinct target is expanded
    into its substrings of the lengths that source values have, at most
    ``length x (number of distinct lengths)`` rows, and the best match is an
    aggregate.  Neither side is broadcast or bounded in size.
    """
    src = source.select(F.col(source_col).alias("__find"), *[F.col(c).alias(f"__a_{c}") for c in append])
    appended = [f"__a_{c}" for c in append]
    # one source row per value, as an aggregate (a hot value is combined map-side)
    src = top1_by(src, ["__find"], [(c, True) for c in appended], appended)
    if contains:
        lengths = src.agg(F.collect_set(F.length("__find"))).scalar()
        names = targets.select(F.col(target_col).alias("__name")).where(F.col("__name").isNotNull()).distinct()
        sized = names.withColumn("__lengths", lengths).select("__name", F.explode("__lengths").alias("__len"))
        starts = F.sequence(F.lit(1), F.length("__name") - F.col("__len") + 1)
        parts = (sized.where(F.col("__len") <= F.length("__name"))
                 .select("__name", "__len", F.explode(F.array_distinct(F.transform(
                     starts, lambda i: F.substring("__name", i, F.col("__len"))))).alias("__find")))
        src = top1_by(parts.join(src, "__find"), ["__name"], [("__len", False), *[(c, True) for c in appended]],
                      appended).withColumnRenamed("__name", "__find")
    j = targets.join(src, targets[target_col] == src["__find"], "left")
    return j.select(*targets.columns, *[F.col(f"__a_{c}").alias(c) for c in append])


# ---------------------------------------------------------------------------
# ordering, uniqueness, upsert
# ---------------------------------------------------------------------------

def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def top1_by(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], cols: Sequence[str]) -> DataFrame:
    """First row per key as an aggregate (D1, N4 for large groups).

    ``order`` is a list of ``(column, ascending)``; descending columns must be
    numeric; NULLs come last either way.  ``min(struct(...))`` is computed map-side like any aggregate, so a
    key that holds a large share of all rows never has to be sorted in one
    task (a ``row_number`` window would)."""
    parts = [p for i, (c, asc) in enumerate(order)
             for p in (F.col(c).isNull().alias(f"__n{i}"), (F.col(c) if asc else -F.col(c)).alias(f"__o{i}"))]
    best = F.min(F.struct(*parts, *[F.col(c).alias(c) for c in cols])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in cols])


def union_ordered(*dfs: DataFrame, priority_col: str = "__priority") -> DataFrame:
    """Union by name with missing columns NULL (U1, U3), tagging each input
    with its position so later ``first_by`` can prefer input #1."""
    tagged = [d.withColumn(priority_col, F.lit(i)) for i, d in enumerate(dfs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _same_key(keys: Sequence[str]) -> Column:
    """Equality of the keys with those named ``__of_<key>``; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])


def split_by_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key occurs in ``keys_df`` and the others; NULL equals NULL."""
    wanted = keys_df.select(*[F.col(k).alias(f"__of_{k}") for k in keys]).distinct()
    return df.join(wanted, _same_key(keys), "left_semi"), df.join(wanted, _same_key(keys), "left_anti")


def first_wins(existing: DataFrame, new: DataFrame, keys: Sequence[str],
               order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """One row per key of ``new``: a stored row if there is one, else a new row.

    Only flagged rows, those whose key is registered anew, take part.  Several
    stored rows of a flagged key collapse to the first in ``order`` (pairs of
    column and ascending, then least values), in one aggregate over both inputs.
    """
    flagged, _ = split_by_keys(existing, new, keys)
    rows = union_ordered(flagged, new)
    cols = [c for c in rows.columns if c not in (*keys, "__priority")]
    return top1_by(rows, keys, [("__priority", True), *order], cols).select(*[c for c in rows.columns if c != "__priority"])


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                     order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """Existing rows plus the new rows whose key is not yet present.

    Stored rows that share a key of ``new`` are reduced to the first
    (:func:`first_wins`); stored rows of other keys stay as they are.
    """
    _, others = split_by_keys(existing, new, keys)
    return others.unionByName(first_wins(existing, new, keys, order), allowMissingColumns=True)


def merge_rows(inputs: Sequence[DataFrame], keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """One row per key: for each column the value last written among the inputs that carry it.

    ``inputs`` are in the order of writing; of rows of one key in one input the
    one with the greatest ``latest`` (then the greatest values) is the last.  A
    column that an input lacks is not touched by it, a NULL that it carries is
    written.  Columns carried by the same inputs are decided together, by one
    ``max_by`` in one aggregate, so rows of a frequent key are combined before
    the shuffle.
    """
    columns = list(dict.fromkeys(c for df in inputs for c in df.columns if c not in keys))
    carriers: dict[tuple[int, ...], list[str]] = {}
    for c in columns:
        carriers.setdefault(tuple(i for i, df in enumerate(inputs) if c in df.columns), []).append(c)
    tagged = []
    for i, df in enumerate(inputs):
        groups = []
        for g, (which, cols) in enumerate(carriers.items()):
            if i not in which:
                continue
            value = F.struct(*[F.col(c) for c in cols])
            rank = [F.col(c).alias(f"r{n}") if c in df.columns else F.lit(None).alias(f"r{n}") for n, c in enumerate(latest)]
            groups += [value.alias(f"__v{g}"), F.struct(F.lit(i).alias("i"), *rank, value.alias("v")).alias(f"__s{g}")]
        tagged.append(df.select(*keys, *groups))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    last = rows.groupBy(*keys).agg(*[F.max_by(f"__v{g}", f"__s{g}").alias(f"__v{g}") for g in range(len(carriers))])
    place = {c: g for g, cols in enumerate(carriers.values()) for c in cols}
    return last.select(*keys, *[F.col(f"__v{place[c]}.{c}").alias(c) for c in columns])


def upsert_last_wins(existing: DataFrame, updates: DataFrame | Sequence[DataFrame], keys: Sequence[str],
                     latest: Sequence[str] = ()) -> DataFrame:
    """Update-else-insert on ``keys`` (K3-K5).

    ``updates`` is one input or several in the order of writing.  A stored row
    with an update's key keeps the columns that the updates do not carry and
    gets the others from the last update (see :func:`merge_rows`); a key that is
    not stored is inserted.  Stored rows of other keys are passed on untouched,
    without a shuffle where the updates are small.  NULL equals NULL in keys.
    """
    updates = [updates] if isinstance(updates, DataFrame) else list(updates)
    touched = reduce(lambda a, b: a.union(b), [u.select(*keys) for u in updates])
    stored, others = split_by_keys(existing, touched, keys)
    merged = merge_rows([stored, *updates], keys, latest)
    out = [*existing.columns, *[c for c in merged.columns if c not in existing.columns]]
    return others.unionByName(merged, allowMissingColumns=True).select(*out)


def append_guarded(target: DataFrame, source: DataFrame, on: Sequence[str], limit: int, mode: str = "error",
                   how: str = "inner") -> DataFrame:
    """Every target row with each source row of its key, at most ``limit`` source rows a key.

    The rows are counted per key inside the plan and no action runs on the
    driver.  ``error``: the query fails when a key that a target row meets has
    more rows.  ``warn``: all rows pass, with a flag column ``over_limit``.
    """
    if mode not in ("error", "warn"):
        raise ValueError(f"mode must be 'error' or 'warn', not {mode!r}")
    counts = source.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    counted = target.join(counts, list(on), "left")
    over = F.coalesce(F.col("__n") > F.lit(limit), F.lit(False))
    if mode == "error":
        message = F.concat(F.lit("append: "), F.col("__n").cast("string"), F.lit(f" rows for one key, at most {limit} are allowed"))
        counted = counted.where(F.when(over, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    else:
        counted = counted.withColumn("over_limit", over)
    return counted.drop("__n").join(source, list(on), how)


def number_rows(df: DataFrame, order: Sequence[Column], partition: Sequence[str] = (), name: str = "RecordID",
                start: int = 1) -> DataFrame:
    """Row numbering from ``start``.

    With ``partition`` a window per partition.  Without, the whole table is
    numbered in its order without passing through one task: rows are range
    partitioned and sorted, numbered within their partition and written; the
    partitions' counts (one row each) give the number before each partition.
    Rows equal in ``order`` are numbered in any order.
    """
    if partition:
        w = Window.partitionBy(*partition).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(w) + F.lit(start - 1)).cast("bigint"))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id holds the partition above 33 bits and the row's place in it below
    tagged = materialize(ranged.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("__id", 33)
    tagged = tagged.withColumn("__part", part)
    counts = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    so_far = lambda done: F.coalesce(F.try_element_at(done, F.lit(-1))["after"], F.lit(0).cast("bigint"))
    running = F.aggregate(
        "all", F.array().cast("array<struct<__part: bigint, before: bigint, after: bigint>>"),
        lambda done, x: F.concat(done, F.array(F.struct(
            x["__part"].alias("__part"), so_far(done).alias("before"), (so_far(done) + x["n"]).alias("after")))))
    before = (counts.agg(F.array_sort(F.collect_list(F.struct("__part", "n"))).alias("all"))
              .select(F.explode(running).alias("x")).select("x.__part", "x.before"))
    # one row per partition of the numbered table
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = tagged.join(F.broadcast(before), "__part")
    return numbered.select(*df.columns, (F.col("before") + place + F.lit(start)).cast("bigint").alias(name))


# ---------------------------------------------------------------------------
# windows: shares, carry-forward, ties, expansion
# ---------------------------------------------------------------------------

def share_of_total(df: DataFrame, partition: Sequence[str], value: str, name: str = "share",
                   total_name: str | None = None) -> DataFrame:
    """``value / sum(value) over partition`` (N3, A5); NULL for a zero total."""
    tot = F.sum(value).over(Window.partitionBy(*partition))
    out = df.withColumn(total_name or "__tot", tot)
    out = out.withColumn(name, F.try_divide(F.col(value).cast("double"), F.col(total_name or "__tot").cast("double")))
    return out if total_name else out.drop("__tot")


def carry_forward(df: DataFrame, order: str, anchor_value: str, net: str, partition: Sequence[str] = (),
                  name: str = "begin") -> DataFrame:
    """Anchored running balance.

    ``begin[i] = anchor_value[i]`` when it is > 0, otherwise
    ``begin[i-1] + net[i-1]``.  Expressed as a segment id (running count of
    anchors) and a running sum of ``net`` inside the segment, so it is one
    window pass, not a loop.  A row before the first anchor has no balance
    and raises, as the sequential definition does.
    ``partition`` names the model / scenario column; the periods of one
    model are a handful of rows.  Without it the input is one model.
    """
    if not partition:
        one = carry_forward(df.withColumn("__model", F.lit("")), order, anchor_value, net, ["__model"], name)
        return one.drop("__model")
    base = Window.partitionBy(*partition)
    w_run = base.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_anchor = F.coalesce(F.col(anchor_value) > 0, F.lit(False))
    out = df.withColumn("__seg", F.sum(is_anchor.cast("int")).over(w_run))
    seg_w = Window.partitionBy(*partition, "__seg").orderBy(order)
    prev = seg_w.rowsBetween(Window.unboundedPreceding, -1)
    start = F.first(F.col(anchor_value)).over(seg_w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bal = start + F.coalesce(F.sum(net).over(prev), F.lit(0.0))
    out = out.withColumn(name, F.when(F.col("__seg") == 0,
                                      F.raise_error(F.lit("no opening balance before the first period")).cast("double"))
                         .otherwise(bal))
    return out.drop("__seg")


def top_with_ties(df: DataFrame, value: str, partition: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``value`` equals the maximum of their partition (T1, F18);
    NULL values never qualify.  Without ``partition`` the maximum of the whole
    table is a scalar subquery, so no task holds all rows."""
    if not partition:
        return df.where(F.col(value) == df.agg(F.max(value)).scalar())
    w = Window.partitionBy(*partition)
    return df.withColumn("__max", F.max(value).over(w)).where(F.col(value) == F.col("__max")).drop("__max")


def expand_back(df: DataFrame, count: Column, name: str = "j") -> DataFrame:
    """Repeat each row ``count`` times with ``name`` = 1..count (N5);
    ``count <= 0`` gives no row (``sequence(1, 0)`` alone would give two)."""
    seq = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    return df.select("*", F.explode(seq).alias(name))


# ---------------------------------------------------------------------------
# reshape
# ---------------------------------------------------------------------------

def unpivot_prefixed(df: DataFrame, ids: Sequence[str], prefix: str, key: str = "corp_code",
                     value: str = "account_value") -> DataFrame:
    """Unpivot the columns named ``<prefix><code>`` to rows."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    if not cols:
        return df.select(*ids, F.lit(None).cast("string").alias(key),
                         F.lit(None).cast("double").alias(value)).where(F.lit(False))
    long = df.select(*ids, *[F.col(c).cast("double").alias(c[len(prefix):]) for c in cols])
    return long.unpivot(list(ids), [c[len(prefix):] for c in cols], key, value)


def pivot_prefixed(long: DataFrame, ids: Sequence[str], codes: Sequence[str], prefix: str,
                   key: str = "corp_code", value: str = "account_value") -> DataFrame:
    """Pivot per-code values to columns ``<prefix><code>`` (R2).  ``codes`` is
    the (small) list of account codes, so Spark needs no extra pass to find it."""
    p = long.groupBy(*ids).pivot(key, list(codes)).agg(F.first(value))
    return p.select(*ids, *[F.col(f"`{c}`").alias(prefix + c) for c in codes])
