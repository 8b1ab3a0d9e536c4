"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_distance // 2 + 1`` segments, so two fingerprints within
``max_distance`` bits agree up to one bit in at least one segment.  Each segment is indexed once
per bit with that bit blanked (64 keys in all); fingerprints that meet under a key are compared.

Only distinct fingerprints are indexed: copies share one.  A group of near copies is not expanded
into its pairs.  First every fingerprint is linked to the smallest one under each of its keys, if
near enough, which gives components with one link per fingerprint and key.  Then, under keys where
several components still meet, the members outside the largest component there are compared with
all members of other components.  No link between different components is lost, and none within
one is listed.

NULL, empty and blank texts have fingerprint 0, which links like any other.  Rows with a NULL
``doc_id`` take part; a component's id is the smallest ``doc_id`` that is not NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import text_slices, written
from servelens.llm.components import connected_components


def simhash(text: bytes, shingle: int, seed: int) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text: words are lower-cased in A-Z only."""
    import numpy as np
    from xxhash import xxh64_digest

    words = text.lower().split()  # of bytes: ASCII case and the six ASCII white space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxh64_digest(joined, seed)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps + 1).tolist()]
        stops = [*gaps.tolist(), len(joined)][shingle - 1:]
        digests = b"".join([xxh64_digest(joined[a:b], seed) for a, b in zip(starts, stops)])
    n = len(digests) // 8
    ones = np.zeros(64, np.int64)
    rows = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):  # summed in bounded pieces
        ones += np.unpackbits(rows[at:at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` (signed) of every row."""
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fingerprint", pa.int64())])
        for batch in batches:
            for a, b, texts in text_slices(batch, "text"):
                prints = pa.array([simhash(t, shingle, seed) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), prints], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, text_hash long, fingerprint long")


def signature_keys(fingerprint: Column, max_distance: int) -> Column:
    """All one-wildcard segment variants as an array of longs (variant number above the segment's bits)."""
    n = max_distance // 2 + 1
    bounds = [64 * i // n for i in range(n + 1)]
    keys = []
    for low, high in zip(bounds, bounds[1:]):
        segment = F.shiftrightunsigned(fingerprint, low)
        for bit in range(high - low):
            mask = ((1 << (high - low)) - 1) & ~(1 << bit)
            masked = segment.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
            # up to 57 bits leave room for the variant's number; a longer segment is hashed with it
            number = len(keys)
            keys.append(F.lit(number << 57).bitwiseOR(masked) if high - low <= 57 and number < 64 else F.xxhash64(masked, F.lit(number)))
    return F.array(*keys)


def near_components(prints: DataFrame, max_distance: int) -> DataFrame:
    """``(node, component)`` over the distinct values of ``prints(fingerprint)``; values that are
    linked to none, or are their component's smallest, are left out."""
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= max_distance
    # 64 keys come of each row, so the few bytes of the rows are dealt out before
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.repartition(n).select("fingerprint", F.explode(signature_keys(F.col("fingerprint"), max_distance)).alias("key"))
    groups = keyed.groupBy("key").agg(F.min("fingerprint").alias("least"), F.max("fingerprint").alias("most"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.filter((F.col("n") > 2) | ((F.col("n") == 2) & near(F.col("least"), F.col("most")))), "simhash-groups")
    # two fingerprints that meet alone under a key are compared in place; of larger groups the
    # members between the least and the greatest are joined back (by merging at every size)
    large = groups.filter("n > 2").select(F.col("key").alias("k"), "least", "most").hint("merge")
    between = keyed.join(large, (F.col("key") == F.col("k")) & (F.col("fingerprint") != F.col("least")) & (F.col("fingerprint") != F.col("most")))
    met = between.select("key", "fingerprint", "least").union(large.select("k", "least", "least")).union(large.select("k", "most", "least"))
    met = written(met, "simhash-met")
    links = met.filter((F.col("fingerprint") != F.col("least")) & near(F.col("fingerprint"), F.col("least"))).select("fingerprint", "least")
    links = links.union(groups.filter("n = 2").select("most", "least"))
    first = connected_components(links.toDF("a", "b"))

    known = met.join(first.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "key", "fingerprint", F.coalesce("component", "fingerprint").alias("component"))
    here = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = here.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    open_ = known.join(mixed.select("key", "main"), "key")
    x, y = open_.filter("component != main").alias("x"), open_.alias("y")
    second = connected_components(
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
               & ((F.col("y.component") == F.col("y.main")) | (F.col("x.fingerprint") < F.col("y.fingerprint")))
               & near(F.col("x.fingerprint"), F.col("y.fingerprint")))
        .select(F.col("x.component").alias("a"), F.col("y.component").alias("b")))

    # the components of the first step that the second joins, and their members
    joined = first.join(second.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select(
        "node", F.coalesce("root", "component").alias("component"))
    return joined.unionByName(second.join(first.select("node"), "node", "left_anti"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` (signed) and ``component_id`` of every row."""
    found = written(fingerprints(docs, shingle, seed), "simhash-prints")
    distinct = found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    components = near_components(distinct.select("fingerprint"), max_distance)
    named = distinct.join(components.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component"))
    # written, so that the join below has a shuffle of its own and a component of many fingerprints can be split
    ids = written(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-ids")
    return found.join(named.join(ids, "component").select("fingerprint", "component_id"), "fingerprint").select(
        "doc_id", "text_hash", "fingerprint", "component_id")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42) -> DataFrame:
    """One row of each component: that of the smallest ``doc_id`` (NULL last), all columns kept.
    Repeated rows with that id and text count as one."""
    found = near_duplicates(docs, shingle, max_distance, seed)
    # rows of a component without any id share a NULL component_id: their fingerprint keeps them apart
    winner = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("own")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("w"))
    winner = written(winner.select(F.col("w.doc_id").alias("servelens_id"), F.col("w.text_hash").alias("servelens_hash")).distinct(), "simhash-winners")
    key = "servelens_text_hash"
    hashed = docs.withColumn(key, F.xxhash64("text"))
    kept = hashed.join(winner, F.col("doc_id").cast("long").eqNullSafe(F.col("servelens_id")) & (F.col(key) == F.col("servelens_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", key]).drop(key)
