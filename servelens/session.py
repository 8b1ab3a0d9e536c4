"""Spark session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are *unset*, so cluster-wide values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness / plan shape.  AQE re-plans joins with
# runtime sizes (its broadcast conversion is the size check for every join
# whose side is not bounded by construction) and splits skewed partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "servelens") -> SparkSession:
    """Create (or fetch) a session for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SERVELENS_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and
    is used as is (it must be set there: a cluster run without it raises).
    Only local runs / tests, where it is unset, get a scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the conf value is all there is
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    master = ""
    try:
        master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    except Exception:
        pass
    if master != "local" and not master.startswith("local["):
        # a machine-local folder is not visible to other executors; an unknown master may have some
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="servelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:
        pass
    if sc is not None:
        sc.setCheckpointDir(local)
    return local
