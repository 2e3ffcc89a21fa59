"""Session construction and the shared scratch folder.

Cluster jobs get their settings from ``spark-submit``; ``get_spark`` only fills
in what is missing, so the same code runs in tests (``local[*]``) and on a
cluster without edits.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting covers a hot
# customer or movie when a dimension is too large to broadcast.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts only from proven sizes: dimensions pass a row count in
    # ``operators.joins``; AQE may still broadcast a side whose *measured*
    # shuffle output is small.  No broadcast from file-size estimates.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8,000 bytecodes; a stage whose
    # whole-stage-codegen method is larger would run interpreted.  With this
    # limit Spark splits such a stage back into separately compiled operators
    # (measured: -23 % over all queries on 5M events, up to 4x on single ones).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    # Python call-site capture on every Column/DataFrame call (only adds line
    # numbers to error messages) costs ~1 ms per call while building plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoints (cut lineage of clean logs, ranged payload rows) are deleted
    # from the shared folder once nothing references them, so nightly runs do
    # not accumulate files there.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The driver keeps the plans of this many past queries (Spark's default is
    # 1,000); a nightly run has hundreds of wide plans and shows none of them.
    "spark.sql.ui.retainedExecutions": "20",
}

# Applied when the session starts (client-side flags are read once).
STARTUP_CONF = (
    "spark.ui.enabled",
    "spark.python.sql.dataFrameDebugging.enabled",
    "spark.ui.showConsoleProgress",
    "spark.cleaner.referenceTracking.cleanCheckpoints",
    "spark.sql.ui.retainedExecutions",
)


def get_spark(
    app: str = "vodlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create the session; explicit ``extra``/``shuffle_partitions`` win.

    The start-up settings (UI and console progress off, checkpoint cleaning)
    are always applied when this call creates the context — the UI is never
    served.  All other package defaults only fill settings that
    ``spark-submit`` left unset."""
    builder = SparkSession.builder.appName(app)
    for k in STARTUP_CONF:
        builder = builder.config(k, DEFAULT_CONF[k])
    if master:
        builder = builder.master(master)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in explicit.items():  # core settings only take effect before start-up
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if k not in STARTUP_CONF and k not in explicit and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    for k, v in explicit.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is; if
    it is unset there we raise rather than use a machine-local folder.  Only a
    local-mode session (tests) without it gets a folder of our own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not path:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return path
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="vodlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/vodlens-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for helpers that need a plain path."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["get_spark", "ensure_checkpoint_dir", "scratch_path", "local_path"]
