"""Session construction and the few session-level settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, app: str = "lakeshift", shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session for local runs and tests. On a cluster the submitter's config wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()  # what spark-submit and spark-defaults set
    settings = {k: v for k, v in DEFAULT_CONF.items() if not submitted.contains(k)}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, honouring the cluster's setting.

    ``spark.checkpoint.dir`` names the shared folder on a cluster; it is only
    invented (under the local temp dir) when nothing is configured, which is
    the unit-test situation.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lakeshift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
