"""Readers and the typed layer.

A model is a set of named tables.  Readers return lazy DataFrames; nothing is
collected.  The typed layer casts the numbers the model stores as text and
turns NaN into NULL, so later operators follow SQL null rules.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servelens import constants as K
from servelens.functions.scalar import period_no
from servelens.sinks import snapshots

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# the monthly transfer files: six text keys and the volume
TRANSFER_FILE_SCHEMA = StructType(
    [StructField(h, StringType()) for h in list(K.TRANSFER_HEADERS)[:-1]]
    + [StructField("Return Volume", DoubleType())])

INPUT_TABLES = ("customers", "periods", "customerdemand", "inventorypolicies", "productionconstraints")
REPORT_TABLES = ("optimizationshipmentsummary", "optimizationfacilitysummary", "optimizationflowsummary",
                 "optimizationwarehousingsummary", "optimizationinventorysummary",
                 "optimizationproductionsummary", "facilities", "customers", "productionconstraints")
#: fact tables of the reports and the column with their period label
PERIOD_LABELS = {
    "optimizationflowsummary": "departingperiodname",
    "optimizationfacilitysummary": "periodname",
    "optimizationwarehousingsummary": "periodname",
    "optimizationinventorysummary": "periodname",
    "optimizationproductionsummary": "startingperiodname",
}
BUNDLE_TABLES = ("customerdemand", "customers", "scenarios", "scenarioitemassignments", "scenarioitems")


def drop_id(df: DataFrame) -> DataFrame:
    """Drop the surrogate ``id`` column when present."""
    return df.drop("id") if "id" in df.columns else df


def load_tables(spark: SparkSession, root: str, names: Iterable[str], fmt: str = "parquet",
                options: dict | None = None) -> dict[str, DataFrame]:
    """Whole-table scan of an allow-list of tables.

    Each table is a folder ``{root}/{name}`` in ``fmt``, or a versioned table of
    that name, whose latest version is read.  A missing table raises (the model
    code fails on a missing name too).  ``id`` is dropped.
    """
    out = {}
    for n in names:
        if snapshots.exists(spark, f"{root}/{n}"):
            out[n] = drop_id(snapshots.read(spark, f"{root}/{n}"))
            continue
        reader = spark.read.format(fmt)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        out[n] = drop_id(reader.load(f"{root}/{n}"))
    return out


def load_jdbc(spark: SparkSession, url: str, names: Iterable[str], properties: dict) -> dict[str, DataFrame]:
    """Same as :func:`load_tables` for a database reachable over JDBC."""
    return {n: drop_id(spark.read.jdbc(url, n, properties=properties)) for n in names}


def read_monthly_files(spark: SparkSession, folder: str, fmt: str = "csv", expected: int | None = K.EXPECTED_MONTHLY_FILES,
                       header_map: dict | None = None, schema=TRANSFER_FILE_SCHEMA) -> DataFrame:
    """Folder scan: read every file of ``folder`` (and folders below) and unite them by column name.

    ``expected`` is the input guard (S2): the number of files must equal it.
    The files are listed through the Hadoop file system, so any shared file
    system will do.

    CSV files are grouped by their header line and each group has a reader of
    its own.  A column that a file lacks is NULL in its rows, columns may stand in
    any order, columns beyond ``schema`` are kept as text.  A header that names a
    column twice raises.  Parquet schemas are merged by name, JSON is by name.
    """
    files = list_files(spark, folder)
    if expected is not None and len(files) != expected:
        raise ValueError(f"{folder} must hold {expected} monthly files, one a month; found {len(files)}")
    if fmt != "csv":
        reader = spark.read.format(fmt)
        df = (reader.option("mergeSchema", "true") if fmt == "parquet" else reader).load(files if files else folder)
        return rename_headers(df, header_map or K.TRANSFER_HEADERS)
    typed = {f.name: f.dataType for f in schema} if schema is not None else {}
    groups: dict[str, list[str]] = {}
    for path in files:
        line = first_line(spark, path)
        if line is not None:  # a file without any line has no rows
            groups.setdefault(line, []).append(path)
    parts = []
    for line, paths in groups.items():
        names = spark.read.option("header", "false").csv(spark.sparkContext.parallelize([line], 1)).first()
        names = ["" if n is None else n.strip() for n in names]
        if len(set(names)) < len(names):
            raise ValueError(f"{paths[0]} names a column twice: {line}")
        own = StructType([StructField(n, typed.get(n, StringType())) for n in names])
        parts.append(spark.read.option("header", "true").schema(own).csv(paths))
    if not parts:
        return rename_headers(spark.createDataFrame([], schema), header_map or K.TRANSFER_HEADERS)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name, kind in typed.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return rename_headers(df, header_map or K.TRANSFER_HEADERS)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all files below ``folder``, hidden files and folders left out, sorted."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, folders = [], [root]
    while folders:
        for status in fs.listStatus(folders.pop()):
            path = status.getPath()
            if path.getName().startswith(("_", ".")):
                continue
            if status.isDirectory():
                folders.append(path)
            else:
                found.append(path.toString())
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file (None: it is empty); only its first block is read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return None if line is None else line.lstrip("\ufeff")


def read_account_list(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Account list (S3): header row, columns renamed to our names."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return rename_headers(reader.load(path), K.ACCOUNT_HEADERS)


def rename_headers(df: DataFrame, mapping: dict) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


# ---------------------------------------------------------------------------
# typed layer
# ---------------------------------------------------------------------------

def to_double(c, strict: bool = True):
    """Text -> DOUBLE.  ``strict`` raises on bad text (as the model does);
    otherwise bad text becomes NULL.  NaN becomes NULL either way."""
    c = F.col(c) if isinstance(c, str) else c
    v = c.cast("double") if strict else c.try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def typed_constraints(df: DataFrame, strict: bool = True) -> DataFrame:
    """``constraintvalue`` as DOUBLE; all 17 key columns present as STRING."""
    out = df
    for c in K.CONSTRAINT_KEYS:
        if c not in out.columns and c != K.ORIGINAL_STATUS_COLUMN:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.withColumn("constraintvalue", to_double("constraintvalue", strict))


def typed_demand(df: DataFrame, strict: bool = True) -> DataFrame:
    return df.withColumn("quantity", to_double("quantity", strict))


def typed_inventory(df: DataFrame, strict: bool = True) -> DataFrame:
    return df.withColumn("initialinventory", to_double("initialinventory", strict))


def by_period(df: DataFrame, label: str, n_parts: int | None = None, name: str = "period_no") -> DataFrame:
    """``df`` with the number of its period label as a column, laid out for writing (F8).

    Rows are dealt in ranges of the period number and sorted by it, so the
    statistics of each file and row group span few periods and a pushed cutoff skips the
    others unread.  A hash of the row breaks ties: a period with a third of all rows
    spreads over as many ranges as its size asks for.
    """
    out = df.withColumn(name, period_no(label))
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, name, F.xxhash64(*df.columns)).sortWithinPartitions(name)


def typed_customers(df: DataFrame) -> DataFrame:
    """Codes are text (Q3): a numeric code column is cast to STRING."""
    return df.withColumn("corpcode", F.col("corpcode").cast("string"))
