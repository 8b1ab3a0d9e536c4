"""Document fingerprints by closed syncmers, with built-in functions only.

A text is the sequence of its words' hashes.  Of each run of ``k`` words the inner runs of ``s`` words are
hashed; the run is an anchor (a closed syncmer) if the least inner hash stands at its first or last place.
Whether a run is an anchor depends on the run alone, so shared passages share their anchors wherever
they stand, and anchors keep their word position.

The likeness of two texts is computed from all their anchors.  Each anchor hash that both texts hold pairs
its first positions in the two; a pair counts if the pair before or after it in the text has the same
offset, so that a match by chance of a few words far from any other does not.  (Where a text has one
distinct anchor only, its pair counts alone.)  The likeness is the part of the distinct anchors of both that
counts; two texts without words have 1.

The fingerprint grows with the text: it holds the distinct anchor hashes (32 bits) below a fixed threshold,
a 32nd of the range, and at least the ``sketch`` smallest.  Texts of fewer than ``k`` words have one
anchor, their whole sequence; texts without words have an empty fingerprint.  NULL counts as the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servelens.llm.common import SPACE, fenced


def with_anchors(df: DataFrame, text: str, out: str, k: int = 5, s: int = 2) -> DataFrame:
    """Adds ``out``: array of ``(position, hash)`` of the anchors of column ``text``.  Each array is a column
    of its own, so that no step is evaluated again inside another step's lambda."""
    words, inner = f"{out}_words", f"{out}_inner"
    df = df.withColumn(words, F.transform(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), ""), lambda w: F.xxhash64(w)))
    n = F.size(words)
    none = F.array().cast("array<bigint>")
    df = df.withColumn(inner, F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (s - 1)), lambda i: F.xxhash64(F.slice(words, i, s)))).otherwise(none))
    span = k - s + 1  # inner runs of a run

    def at_edge(i: Column) -> Column:
        least = F.array_min(F.slice(inner, i, span))
        return (F.get(F.col(inner), i - 1) == least) | (F.get(F.col(inner), i + (span - 2)) == least)

    value = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))
    found = F.transform(F.filter(F.sequence(F.lit(1), n - (k - 1)), at_edge),
                        lambda i: F.struct(i.alias("position"), value(F.xxhash64(F.slice(words, i, k))).alias("hash")))
    whole = F.array(F.struct(F.lit(1).alias("position"), value(F.xxhash64(F.col(words))).alias("hash")))
    return df.withColumn(out, F.when(n >= k, found).when(n > 0, whole).otherwise(F.slice(whole, 1, 0))).drop(words, inner)


#: anchor hashes below it are in every fingerprint
THRESHOLD = 1 << 27


def sketch_of(hashes: Column, size: int) -> Column:
    """Of sorted distinct hashes: those below the threshold, at least ``size``."""
    below = F.size(F.filter(hashes, lambda h: h < THRESHOLD))
    return F.when(F.size(hashes) <= size, hashes).otherwise(F.slice(hashes, 1, F.greatest(F.lit(size), below)))


def packed(anchors: Column) -> Column:
    """Hash and position of each anchor in one number."""
    return F.transform(anchors, lambda a: F.shiftleft(a["hash"], 31) + a["position"])


def hashes_of(anchors: Column) -> Column:
    return F.transform(anchors, lambda v: F.shiftright(v, 31))


def distinct_hashes(anchors: Column) -> Column:
    return F.sort_array(F.array_distinct(hashes_of(anchors)))


def with_likeness(df: DataFrame, a: str, b: str, a_hashes: str, out: str) -> DataFrame:
    """Adds ``out``, from 0 to 1: the likeness of the packed anchors ``a`` (with their hashes) and ``b``.
    Arrays that lambdas look into are columns of their own."""
    b_hashes, merged, pairs = f"{out}_hashes", f"{out}_merged", f"{out}_pairs"
    place, low = (1 << 30) - 1, (1 << 31) - 1
    none = F.array().cast("array<bigint>")
    df = fenced(df.withColumn(b_hashes, hashes_of(F.col(b))))
    # by hash, first the positions in a from the last, then those in b from the first: the pair meets in the middle
    both = F.sort_array(F.concat(F.transform(a, lambda v: v + place - 2 * v.bitwiseAND(F.lit(place))), F.transform(b, lambda v: v + (place + 1))))
    df = fenced(df.withColumn(merged, F.when(F.arrays_overlap(a_hashes, b_hashes), both).otherwise(none)))
    at = lambda i: F.get(F.col(merged), i)
    meet = F.filter(F.sequence(F.lit(0), F.size(merged) - 2), lambda i: (F.shiftright(at(i), 31) == F.shiftright(at(i + 1), 31))
                    & (F.shiftright(at(i), 30) != F.shiftright(at(i + 1), 30)))
    found = F.transform(meet, lambda i: F.shiftleft(place - at(i).bitwiseAND(F.lit(place)), 31) + at(i + 1).bitwiseAND(F.lit(place)))
    df = fenced(df.withColumn(pairs, F.when(F.size(merged) > 0, F.sort_array(found)).otherwise(none)))
    offset = lambda i: F.get(F.col(pairs), i).bitwiseAND(F.lit(low)) - F.shiftright(F.get(F.col(pairs), i), 31)
    same = lambda x, y: F.coalesce(x == y, F.lit(False))
    kept = F.size(F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: same(offset(i), offset(i - 1)) | same(offset(i), offset(i + 1))))
    single = (F.array_min(a_hashes) == F.array_max(a_hashes)) | (F.array_min(b_hashes) == F.array_max(b_hashes))
    count = F.when(F.size(pairs) == 0, 0).when(single, F.size(pairs)).otherwise(kept)
    value = F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(F.size(pairs) == 0, 0.0).otherwise(count / F.size(F.array_union(a_hashes, b_hashes)))
    return df.withColumn(out, value).drop(b_hashes, merged, pairs)


def as_text(sketch: Column) -> Column:
    """Eight hexadecimal digits per value."""
    return F.array_join(F.transform(sketch, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), "")


def fingerprints(docs: DataFrame, k: int = 5, s: int = 2, sketch: int = 64) -> DataFrame:
    """``doc_id``, anchors and the fingerprint of every row."""
    df = with_anchors(docs.select("doc_id", F.col("text").alias("t")), "t", "anchors", k, s)
    return df.select("doc_id", "anchors", as_text(sketch_of(distinct_hashes(packed(F.col("anchors"))), sketch)).alias("fingerprint"))


def with_followers(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` dealt to ranges (``bucket``) of ``doc_id`` by quantiles.  Each range also gets the first
    row of the next range (``part`` 1), the last one the first row of all (``part`` 2), so the row that
    follows a row by ascending ``doc_id`` (NULL last, ties by text) is found within a range.

    The quantiles are approximate and, for large ids, rounded; a range's bound is the least id that falls into it,
    so every bound is an id of the table and no range is empty."""
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n).alias("b"), F.min("doc_id").alias("least")).first()
    quantiles = sorted(set(found["b"] or []))

    def below(values: list[int]):
        edges = F.array(*[F.lit(v).cast("bigint") for v in values]) if values else F.array().cast("array<bigint>")
        return lambda c: F.size(F.filter(edges, lambda b: b <= c))

    least = docs.where("doc_id is not null").groupBy(below(quantiles)(F.col("doc_id")).alias("r")).agg(F.min("doc_id").alias("id"))
    bounds = sorted(r.id for r in least.collect())[1:]
    bucket = lambda c: F.when(c.isNull(), F.lit(len(bounds))).otherwise(below(bounds)(c))
    rows = docs.select("doc_id", "text")
    own = rows.withColumn("bucket", bucket(F.col("doc_id"))).withColumn("part", F.lit(0))
    follow = rows.filter(F.col("doc_id").isin(bounds)) if bounds else rows.filter("false")
    follow = follow.groupBy("doc_id").agg(F.min("text").alias("text"))
    follow = follow.withColumn("bucket", bucket(F.col("doc_id")) - 1).withColumn("part", F.lit(1))
    # the least id (NULL if there is no other) and its least text: neither sorts nor moves the rows
    first = rows.filter(F.col("doc_id").eqNullSafe(F.lit(found["least"]))).groupBy("doc_id").agg(F.min("text").alias("text"))
    first = first.withColumn("bucket", F.lit(len(bounds))).withColumn("part", F.lit(2))
    return own.unionByName(follow).unionByName(first)


def edited_fingerprints(docs: DataFrame, k: int = 5, s: int = 2, sketch: int = 64) -> DataFrame:
    """Each text's fingerprint, that of its edited text (the last half of its code points replaced by as many
    of the next document's first), and the likenesses by all anchors to the edited text and to the next document."""
    df = with_followers(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")))
    # dealt before the anchors are made, so that only texts are moved
    df = df.repartition(F.col("bucket"))
    df = with_anchors(df, "text", "anchors", k, s).withColumn("own", packed(F.col("anchors"))).drop("anchors")
    order = Window.partitionBy("bucket").orderBy("part", F.col("doc_id").asc_nulls_last(), "text")
    df = df.withColumn("next_text", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order)).filter("part = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    df = df.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"), distinct_hashes(F.col("own")).alias("hashes"))
    df = with_likeness(fenced(df), "own", "next_own", "hashes", "near_next").drop("next_own")
    df = with_anchors(df, "edited", "anchors", k, s).withColumn("edited_own", packed(F.col("anchors"))).drop("anchors")
    df = with_likeness(df, "own", "edited_own", "hashes", "near_edited").drop("own")
    df = fenced(df.withColumn("edited_hashes", distinct_hashes(F.col("edited_own"))).drop("edited_own"))
    return fenced(df.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(sketch_of(F.col("hashes"), sketch)).alias("fingerprint"),
                            as_text(sketch_of(F.col("edited_hashes"), sketch)).alias("edited_fingerprint"), "near_edited", "near_next"))
