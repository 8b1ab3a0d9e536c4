"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (NULL last) get the given weights in turn and share the words of
all documents; a target stops at ``max_copies`` times its source's words and the excess is shared by
weight among the others (a water level over the sources).

Within a source every document is wanted ``target / source words`` times (times its ``weight`` over the
source's word-weighted mean, where a weight column is named).  The whole part of that is allocated as
certain copies.  For the fraction ``p`` left the documents are ranked by Pareto odds
``(u / (1 - u)) / (p / (1 - p))``, with ``u`` drawn by a hash of the row, and gone through in that order: each
is taken if its words fit what the source still needs, else left out, until none fits.  At last the one
left out whose size comes nearest to the rest is taken, if that brings the source nearer to its target.

Each source's ranking is cut by a histogram of the odds; the one bin that holds the cut is binned again until it
has at most ``exact`` units, and only those are sorted, so no task's rows grow with a source.  After the document that does not fit, the same is done with those
further down that fit the rest, in rounds over all sources at once.  With each round's rest at least
every document as large as the one left out drops away, so the rounds grow like a logarithm of
the documents.  The decision on a row depends on its own draw, its size and its source's cuts.  Reruns
agree.  NULL and blank texts have size 0 and are never sampled.  Rows repeated with equal id and text
share a draw and are taken together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servelens.llm.common import SPACE, occurrences, written


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_copies: int) -> DataFrame:
    """Adds ``target`` to ``sizes(source, source_size)``: one row per source, so windows over all of it are small."""
    by_name, by_ratio = Window.orderBy(F.col("source").isNull(), "source"), Window.orderBy("ratio", "position")
    everything, before = Window.partitionBy(), Window.orderBy("ratio", "position").rowsBetween(Window.unboundedPreceding, -1)
    s = sizes.withColumn("position", F.row_number().over(by_name) - 1)
    s = s.withColumn("share", F.get(F.array(*map(F.lit, map(float, weights))), F.col("position") % len(weights)))
    s = s.withColumn("most", F.lit(float(max_copies)) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("share"))
    # water level if exactly the sources of lower ratio are full
    s = s.withColumn("level", (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                     / (F.sum("share").over(everything) - F.coalesce(F.sum("share").over(before), F.lit(0.0))))
    s = s.withColumn("rank", F.row_number().over(by_ratio))
    first_open = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("rank", "level"))).over(everything)["level"]
    return s.withColumn("level", first_open).select(
        "source", "source_size", F.least("most", F.coalesce(F.col("share") * F.col("level"), F.col("most"))).alias("target"))


def _draw(doc_id: Column, text: Column, seed: int) -> Column:
    """Uniform in (0, 1)."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 11).cast("double") + 0.5) / float(1 << 53)


def _wanted(max_copies: int) -> Column:
    """Copies wanted of a document, on average."""
    return F.least(F.lit(float(max_copies)), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * F.col("relative"))


def _order(u: Column, p: Column) -> Column:
    """Pareto odds ``q`` as ``q / (1 + q)``, from 0 to 1 (1 where the fraction is 0)."""
    return F.when(p > 0, u * (1 - p) / (u * (1 - p) + p * (1 - u))).otherwise(1.0)


def sampling_plan(base: DataFrame, weights: tuple[float, ...], max_copies: int, bins: int, exact: int) -> tuple[DataFrame, DataFrame]:
    """Per source: ``source_size, target, mean_weight``, the cuts of its ranking (``rounds``: orders between which all rows of at most a
    size are taken) and ``close``, the order of the closing unit.  Besides, ``source, order`` of the units that fit by the size
    of a row but not with all their rows.  ``base``: ``source, size, u, weight``."""
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("weighted"))
    targets = source_targets(sizes.select("source", "source_size"), weights, max_copies)
    targets = targets.join(sizes.select(F.col("source").alias("s"), "weighted"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("weighted") / F.col("source_size")).otherwise(1.0).alias("mean_weight"))
    targets = written(targets, "mixing-targets")

    rows = with_plan(base, targets).withColumn("relative", F.when(F.col("mean_weight") > 0, F.col("weight") / F.col("mean_weight")).otherwise(1.0))
    rows = rows.withColumn("wanted", _wanted(max_copies)).withColumn("whole", F.floor("wanted"))
    rows = rows.withColumn("order", _order(F.col("u"), F.col("wanted") - F.col("whole")))
    # rows of one draw are one unit; the certain copies are summed with them
    units = written(rows.groupBy("source", "order").agg(
        F.sum("size").alias("size"), F.max("size").alias("row_size"), F.sum(F.col("size") * F.col("whole")).alias("certain")), "mixing-units")

    certain = units.groupBy("source").agg(F.sum("certain").alias("certain"))
    state = written(with_plan(targets, certain).select(
        "source", (F.col("target") - F.col("certain") + 0.5).alias("gap"), F.lit(-1.0).alias("start"),
        F.array().cast("array<struct<after: double, before: double, most: double>>").alias("rounds")), "mixing-cuts")
    rest = units.filter((F.col("order") < 1) & (F.col("size") > 0)).select("source", "order", "size", "row_size")
    rest, skipped = _still_fitting(rest, state)
    while not rest.isEmpty():
        state = _cut(rest, state, bins, exact)
        rest, more = _still_fitting(rest, state)
        skipped = skipped.unionByName(more)

    # the unit nearest to the rest, even if it goes beyond
    skipped = written(skipped, "mixing-skipped")
    left = with_plan(_mark_skipped(units, skipped), state).filter(
        (F.col("order") < 1) & (F.col("size") > 0) & ~(~F.col("skipped") & _in_rounds(F.col("order"), F.col("row_size"))))
    off = F.abs(F.col("size") - (F.col("gap") - 0.5))
    close = left.filter(off < F.col("gap") - 0.5).groupBy("source").agg(F.min(F.struct(off.alias("off"), "order")).getField("order").alias("close"))
    return written(with_plan(with_plan(targets, state.select("source", "rounds")), close), "mixing-plan"), skipped


def _still_fitting(rest: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units down the ranking that fit their source's gap, and those of which only a single row would."""
    on = with_plan(rest, state.select("source", "gap", "start")).filter((F.col("order") > F.col("start")) & (F.col("row_size") <= F.col("gap")))
    return (written(on.filter("size <= gap").select(*rest.columns), "mixing-rest"),
            on.filter("size > gap").select("source", "order"))


def _crossing(histogram: DataFrame, at: DataFrame) -> DataFrame:
    """``at`` with each source's running sum ``got`` carried on to the bin that goes beyond its gap, and the orders ``first`` to
    ``last`` and the number ``n`` of that bin's units (NULL if all fit).  A source has at most as many rows as there are bins."""
    sums = with_plan(histogram, at.select("source", "gap", "got"))
    sums = sums.withColumn("upto", F.col("got") + F.sum("size").over(Window.partitionBy("source").orderBy("bin")))
    found = sums.groupBy("source").agg(F.max(F.when(F.col("upto") <= F.col("gap"), F.col("upto"))).alias("before"),
                                       F.min(F.when(F.col("upto") > F.col("gap"), F.struct("bin", "low", "high", "n"))).alias("cross"), F.lit(True).alias("any"))
    return with_plan(at, found).select("source", "gap", F.coalesce("before", "got").alias("got"), (F.col("seen") | F.col("any").isNotNull()).alias("seen"),
                                       F.col("cross.low").alias("first"), F.col("cross.high").alias("last"), F.col("cross.n").alias("n"))


def _cut(rest: DataFrame, state: DataFrame, bins: int, exact: int) -> DataFrame:
    """One round: units are taken by ascending order up to the first beyond the gap, after which the next round starts.
    The bin that holds the cut is binned again until it has at most ``exact`` units in every source; only those are sorted."""
    at = state.select("source", "gap", F.lit(0).cast("long").alias("got"), F.lit(False).alias("seen"),
                      F.greatest("start", F.lit(0.0)).alias("first"), F.lit(1.0).alias("last"))
    rows = rest
    while True:
        width = F.col("last") - F.col("first")
        own = F.when(width > 0, F.least(F.floor((F.col("order") - F.col("first")) / width * bins), F.lit(bins - 1))).otherwise(0)
        histogram = written(with_plan(rows, at.select("source", "first", "last")).groupBy("source", own.cast("int").alias("bin")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("order").alias("low"), F.max("order").alias("high")), "mixing-histogram")
        # written, so that its size is known and it is broadcast to the rows
        at = written(_crossing(histogram, at), "mixing-crossing")
        rows = with_plan(rows, at.select("source", "first", "last")).filter(F.col("order").between(F.col("first"), F.col("last"))).select(*rest.columns)
        if (at.agg(F.max("n")).first()[0] or 0) <= exact:
            break
        rows = written(rows, "mixing-bin")  # the bin's least and greatest orders part at the next step, so it gets smaller
    inside = with_plan(rows, at.select("source", "gap", "got"))
    inside = inside.withColumn("upto", F.col("got") + F.sum("size").over(Window.partitionBy("source").orderBy("order")))
    within = inside.groupBy("source").agg(F.max(F.when(F.col("upto") <= F.col("gap"), F.col("upto"))).alias("last_got"),
                                          F.min(F.when(F.col("upto") > F.col("gap"), F.col("order"))).alias("first_out"))
    found = with_plan(with_plan(state, at.select("source", "got", "seen")), within)
    end = F.coalesce("first_out", F.lit(1.0))
    return written(found.select(
        "source", (F.col("gap") - F.coalesce("last_got", "got")).alias("gap"), F.when(F.col("seen"), end).otherwise(F.col("start")).alias("start"),
        F.when(F.col("seen"), F.array_append("rounds", F.struct(F.col("start").alias("after"), end.alias("before"), F.col("gap").alias("most"))))
        .otherwise(F.col("rounds")).alias("rounds")), "mixing-cuts")


def _in_rounds(order: Column, row_size: Column) -> Column:
    return F.coalesce(F.exists("rounds", lambda r: (order > r["after"]) & (order < r["before"]) & (row_size <= r["most"])), F.lit(False))


def _mark_skipped(rows: DataFrame, skipped: DataFrame) -> DataFrame:
    """Adds ``skipped`` to rows with ``source`` and ``order``.  Only repeated rows can be skipped: mostly there are none, else they are joined."""
    if skipped.isEmpty():
        return rows.withColumn("skipped", F.lit(False))
    # certain rows have no draw to join by: a value of their own, beyond all orders, spreads them
    key = F.when(F.col("order") < 1, F.col("order")).otherwise(2 + F.rand(0))
    marks = skipped.select(F.col("source").alias("servelens_source"), F.col("order").alias("servelens_order"), F.lit(True).alias("servelens_mark"))
    joined = rows.withColumn("servelens_key", key).join(
        marks, (F.col("servelens_key") == F.col("servelens_order")) & F.col("source").eqNullSafe(F.col("servelens_source")), "left")
    return joined.withColumn("skipped", F.col("servelens_mark").isNotNull()).drop(*marks.columns, "servelens_key")


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Joined by source, NULL being a source like any; the plan's rows are as many as sources."""
    plan = plan.withColumnRenamed("source", "servelens_source")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("servelens_source")), "left").drop("servelens_source")


def word_count(text: Column) -> Column:
    """Words of a text: its runs of white space as one space each, trimmed, and the spaces counted."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    return F.when(t == "", 0).otherwise(occurrences(t, " ") + 1).cast("long")


def _base(docs: DataFrame, weight: str | None, seed: int) -> DataFrame:
    return docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        _draw(F.col("doc_id"), F.col("text"), seed).alias("u"),
        (F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)).alias("weight"))


def with_copies(rows: DataFrame, plan: DataFrame, skipped: DataFrame, max_copies: int) -> DataFrame:
    """Adds ``copies`` and the plan to rows with ``source``, ``size``, ``u`` and ``weight``."""
    rows = with_plan(rows, plan)
    rows = rows.withColumn("relative", F.when(F.col("mean_weight") > 0, F.col("weight") / F.col("mean_weight")).otherwise(1.0))
    rows = rows.withColumn("wanted", _wanted(max_copies))
    rows = _mark_skipped(rows.withColumn("order", _order(F.col("u"), F.col("wanted") - F.floor("wanted"))), skipped)
    sampled = (F.col("order") < 1) & (~F.col("skipped") & _in_rounds(F.col("order"), F.col("size")) | F.coalesce(F.col("order") == F.col("close"), F.lit(False)))
    return rows.withColumn("copies", F.when(F.col("size") > 0, F.floor("wanted") + sampled.cast("long")).otherwise(0))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3, weight: str | None = None, seed: int = 17, bins: int = 256,
        exact: int = 4096) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` (words with repeats) of every row."""
    base = written(_base(docs, weight, seed), "mixing-base")
    plan, skipped = sampling_plan(base, weights, max_copies, bins, exact)
    return with_copies(base, plan, skipped, max_copies).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3, weight: str | None = None, seed: int = 17,
                    bins: int = 256, exact: int = 4096) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it, with all their columns.
    Documents without a word are in no mix."""
    plan, skipped = sampling_plan(written(_base(docs, weight, seed).drop("doc_id"), "mixing-base"), weights, max_copies, bins, exact)
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    keyed = docs.select(own).select(
        "row", F.col("row.source").cast("string").alias("source"), _draw(F.col("row.doc_id"), F.col("row.text"), seed).alias("u"),
        word_count(F.col("row.text")).alias("size"),
        (F.greatest(F.coalesce(F.col(f"row.{weight}").cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)).alias("weight"))
    copies = with_copies(keyed, plan, skipped, max_copies).select("row", F.col("copies").cast("int").alias("copies")).filter("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
