"""Session construction and the shared scratch area.

Operators never hard-code shuffle sizes; they rely on AQE to coalesce and
split partitions at run time.  Anything that has to be materialised (written
tables, versioned-table logs, stream checkpoints, lineage cuts) goes under the
cluster's shared checkpoint directory, read from the session.  Only when that
setting is absent (unit tests, a laptop) do we pick a directory ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours gets.  None of them fixes a partition count.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "tessera",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with our defaults; extra ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for materialised data.

    Uses the directory the cluster names in ``spark.checkpoint.dir`` (or one
    already set on the context).  Only when neither exists and the master is
    local, as in tests, a fresh local directory is set as the checkpoint dir;
    on a cluster that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared root for one materialisation."""
    return "/".join([shared_root(spark).rstrip("/"), "tessera", f"{name}-{uuid.uuid4().hex[:12]}"])
