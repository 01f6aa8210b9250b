"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session clock, ANSI arithmetic, AQE
# (runtime coalescing, skew-join splitting, size-checked broadcast).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "teampulse", extra: dict | None = None) -> SparkSession:
    """A session with SESSION_CONF. Master and shuffle partitions are those of
    the submitting command unless the caller names them."""
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is used as is.
    Only a local-mode session without the setting (tests, a laptop) gets a
    fresh private folder, which is then recorded in the session.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster is a cluster
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="teampulse-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core setting may be read-only at runtime
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
