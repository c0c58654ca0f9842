"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, app: str = "surveyprep",
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    AQE is on (runtime coalescing, skew-join splitting, broadcast
    conversion from measured sizes); the session time zone is UTC because
    the survey timestamps are zone-less; the web UI is off.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # generated methods larger than the JIT's 8000-byte limit run
        # interpreted; fall back to per-operator code for those stages
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is. A session
    without one gets a fresh private folder on a local master only; on a
    cluster, where executors wouldn't see it, that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="surveyprep-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for staging files (CSV hand-off, typed loads) so every executor
    sees the same path; never a machine-local temporary folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/surveyprep-stage/{name}-{uuid.uuid4().hex[:12]}"


#: Estimated input bytes up to which ``widen`` spreads a frame over the session's cores.
SMALL_INPUT = 256 << 20


def widen(df, partitions: int | None = None):
    """Round-robin repartition of a small input that feeds wide CPU-bound projections.

    The size is the optimizer's estimate, so nothing runs to learn it. Larger
    inputs arrive in many splits and pass through without a shuffle.
    """
    spark = df.sparkSession
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > SMALL_INPUT:
        return df
    return df.repartition(partitions or spark.sparkContext.defaultParallelism)


def whole(columns) -> Column:
    """The columns as one struct, which joins and projections copy at once where they copy columns one by one.

    It counts as not deterministic, so that filters stop above it: pushed
    further, each field that they read would become a copy of the struct.
    """
    return F.when(F.rand(0) >= 0, F.struct(*[F.col(f"`{c}`") for c in columns]))


RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_conf(spark) -> None:
    """Session settings the library relies on that can be changed at run time."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
