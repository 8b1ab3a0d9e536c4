"""Versioned tables: every write adds a version, the old ones stay readable (K1-K5).

A table is a folder::

    <root>/data/<write id>/...      files of one write, never changed afterwards
    <root>/_versions/000000001      what version 1 consists of (JSON), written last

A version lists its data folders, so a new version may share folders with the
one before it.  A write first puts its files into a folder of its own and only
then publishes the version under the next free number; a job that fails before
leaves no trace for readers.  Publishing renames a finished file to a name that
must not exist yet: of two writers that started from one version the second fails
(as a rename onto an existing name does on the shared file systems Spark uses).

A table with a key is stored in hash partitions of the key.  An upsert reads and
rewrites the partitions that hold a key of the updates; the new version takes the
others from where they are.

Only file names and partition numbers pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from servelens.operators.core import upsert_last_wins

_PART = "__part"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    fs, p, _ = _files(spark, f"{root}/_versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def exists(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def describe(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """What a version (default: the latest) consists of."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no published version of a table in {root}")
    version = known[-1] if version is None else version
    if version not in known:
        raise FileNotFoundError(f"version {version} of {root} does not exist (there are {known[0]} to {known[-1]})")
    fs, p, jvm = _files(spark, f"{root}/_versions/{version:09d}")
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _publish(spark: SparkSession, root: str, entry: dict) -> None:
    final = f"{root}/_versions/{entry['version']:09d}"
    fs, draft, jvm = _files(spark, f"{root}/_versions/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    target = jvm.org.apache.hadoop.fs.Path(final)
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"version {entry['version']} of {root} was published by another writer")


def _load(spark: SparkSession, root: str, entry: dict, parts: Sequence[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    folders = entry["folders"] if parts is None else [entry["parts"][str(p)] for p in parts if str(p) in entry["parts"]]
    if not folders:
        return spark.createDataFrame([], schema)
    # a column added by a later version is NULL in older folders
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the latest."""
    return _load(spark, root, describe(spark, root, version))


def part_of(keys: Sequence[str], n_parts: int):
    """Hash partition of a key (NULLs have one too)."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n_parts)).cast("int")


def _write_parts(df: DataFrame, root: str, keys: Sequence[str], n_parts: int) -> dict[str, str]:
    """Writes one folder per hash partition and returns partition -> folder."""
    folder = f"data/{uuid.uuid4().hex}"
    df.withColumn(_PART, part_of(keys, n_parts)).repartition(_PART).write.mode("errorifexists").partitionBy(_PART).parquet(f"{root}/{folder}")
    fs, p, _ = _files(df.sparkSession, f"{root}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {n.removeprefix(f"{_PART}="): f"{folder}/{n}" for n in names if n.startswith(f"{_PART}=")}


def publish(df: DataFrame, root: str, keys: Sequence[str] = (), n_parts: int = 16) -> int:
    """Write the whole table as a new version; returns its number.

    ``keys`` stores it in ``n_parts`` hash partitions for :func:`upsert` (choose
    partitions of some hundred MB).  ``df`` may read the table's current version.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    entry = {"version": known[-1] + 1 if known else 1, "schema": df.schema.jsonValue(), "keys": list(keys), "n_parts": n_parts}
    if keys:
        entry["parts"] = _write_parts(df, root, keys, n_parts)
        entry["folders"] = sorted(entry["parts"].values())
    else:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{root}/{folder}")
        entry["folders"] = [folder]
    _publish(spark, root, entry)
    return entry["version"]


def upsert(updates: DataFrame | Sequence[DataFrame], root: str, latest: Sequence[str] = ()) -> int:
    """Update-else-insert into a table published with keys; returns the new version's number.

    Only the hash partitions that hold a key of the updates are read and written
    again.  Columns that the updates lack are kept, new columns are added
    (:func:`servelens.operators.core.upsert_last_wins`).
    """
    updates = [updates] if isinstance(updates, DataFrame) else list(updates)
    spark = updates[0].sparkSession
    entry = describe(spark, root)
    keys, n_parts = entry["keys"], entry["n_parts"]
    if not keys:
        raise ValueError(f"{root} was published without keys")
    found = set()
    for u in updates:
        # at most n_parts numbers
        found |= {r[0] for r in u.select(part_of(keys, n_parts)).distinct().collect()}
    if not found:
        return entry["version"]
    merged = upsert_last_wins(_load(spark, root, entry, sorted(found)), updates, keys, latest)
    parts = {**{p: f for p, f in entry["parts"].items() if int(p) not in found}, **_write_parts(merged, root, keys, n_parts)}
    stored = StructType.fromJson(entry["schema"])
    added = [f for f in merged.schema.fields if f.name not in stored.names]
    entry.update(version=entry["version"] + 1, parts=parts, folders=sorted(parts.values()),
                 schema=StructType(stored.fields + added).jsonValue())
    _publish(spark, root, entry)
    return entry["version"]
