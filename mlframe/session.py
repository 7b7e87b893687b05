"""Session helpers.

Library code never creates its own session; it takes the caller's. These
helpers exist for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults tuned for local runs. On a cluster the submitter's settings win:
# ``getOrCreate`` keeps an existing session and its configuration.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "mlframe", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("MLFRAME_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("MLFRAME_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage and we only read it;
    unset, it is an error there, as executors cannot see each other's or the
    driver's folders. A local session gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf = tempfile.mkdtemp(prefix="mlframe-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[5:]
    path = os.path.join(root, "tables")
    os.makedirs(path, exist_ok=True) if "://" not in root else None
    return tempfile.mkdtemp(prefix=f"{name}-", dir=path) if "://" not in root else f"{path}/{name}-{os.urandom(6).hex()}"
