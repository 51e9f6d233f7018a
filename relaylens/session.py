"""Session settings and the shared scratch location.

Settings the operators rely on:

* ``spark.sql.session.timeZone=UTC`` — epoch, date and hour buckets are UTC.
* ``spark.sql.caseSensitive=false`` — the order SQL mixes the case of the
  same column name.
* AQE on, with partition coalescing and skew-join splitting, so a hot key
  in a join is split at runtime instead of landing in one task.
"""

from __future__ import annotations

import hashlib
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "relaylens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above. ``shuffle_partitions``
    is left to the deployment unless given."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_settings(spark)
    return spark


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.caseSensitive"):
        spark.conf.set(k, DEFAULT_CONF[k])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage and we only read it;
    without it this raises, as executors could not see each other's files. Only
    in local mode (unit tests, a laptop) a private folder is made instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="relaylens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect): the conf suffices
        pass
    return root


def run_folder(spark: SparkSession, name: str, key: str = "") -> str:
    """A new folder for one run of a file-landing flow, under the checkpoint
    root. Nothing is deleted: DataFrames of earlier runs and other sessions may
    still read their folders; their lifetime is the checkpoint folder's."""
    root = checkpoint_root(spark).rstrip("/")
    slot = name + (("-" + hashlib.sha1(key.encode()).hexdigest()[:10]) if key else "")
    return f"{root}/relaylens/{slot}/run-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
