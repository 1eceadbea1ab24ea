"""Session settings and the one place that knows where shared files go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the plans rely on. Spark reads sizes at run time, so no join in this
#: package carries a broadcast hint: a side is broadcast only when its measured
#: size is below the threshold, and hot keys of a fact table are split by the
#: skew-join rule.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Recording call sites for error messages is most of the work of building a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Folders made for local sessions that name none, by application.
_local_dirs: dict[str, str] = {}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings above to a session builder."""
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master, where driver and
    executors are one process.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="sparkmart-")
    return _local_dirs[application]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
