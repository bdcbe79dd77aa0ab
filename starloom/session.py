"""Session construction and cluster-shared settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. UTC session time keeps from_utc_timestamp
# results readable as local wall-clock time (the conversion rules assume it).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # INT96 timestamps carry no minimum and maximum, so no filter could skip their files
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "starloom",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the base settings applied.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    # checkpoints go when nothing refers to them any more
    conf = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true", **BASE_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Re-apply the SQL-level settings on an existing session (idempotent)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only when it is unset (tests, local runs) is ``default`` installed; with
    no default, a ``_checkpoints`` folder under the SQL warehouse directory
    (shared storage on a cluster, like the tables themselves) is used. Only a
    single-machine session (a ``local`` master) whose warehouse folder cannot
    be written falls back to a temp folder; a cluster never does. Streams that
    must outlive such a session take an explicit checkpoint path.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None)
         or sc.getConf().get("spark.checkpoint.dir", None)
         or sc.getCheckpointDir())
    if not d:
        d = default or (spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
        if not default and sc.master.startswith("local") and not _local_writable(d):
            # single-machine runs only: a cluster always gets the shared folder
            import tempfile
            d = tempfile.mkdtemp(prefix="starloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def _local_writable(path: str) -> bool:
    """For a local filesystem path: can the folder (or its nearest existing
    parent) be written? Non-local URIs are assumed writable."""
    import os
    if "://" in path and not path.startswith("file:"):
        return True
    p = path.removeprefix("file:")
    while p and not os.path.exists(p):
        p = os.path.dirname(p.rstrip("/"))
    return bool(p) and os.access(p, os.W_OK)
