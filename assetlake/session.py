"""Session construction and cluster-shared locations.

On a cluster the session is given to us; ``get_session`` is for local runs and
tests. It never overrides settings that are already present, so a cluster's
``spark.checkpoint.dir`` and shuffle sizing win.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. AQE coalesces small
# shuffle partitions, splits skewed join partitions and switches joins to
# broadcast at run time once the real side sizes are known.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A row can be a whole image: keep Arrow batches small so a Python
    # worker never holds more than a few MB of pixels at once (Spark also
    # caps a batch at spark.sql.execution.arrow.maxBytesPerBatch, 64 MB by
    # default, so a session without this setting stays bounded too).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # Auto-broadcast only genuinely small sides (10 MB is Spark's default;
    # stated here so the bound is explicit).
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "assetlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_DIR_KEY = "assetlake.checkpoint_dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    The configured folder is always used when present. Only when it is
    absent (local tests) a fresh folder is created for this session: it is
    set on the SparkContext (``spark.checkpoint.dir`` itself cannot be
    changed on a running session) and remembered under a package key.
    """
    ship_package(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_DIR_KEY, None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="assetlake-ckpt-")
        spark.conf.set(_OWN_DIR_KEY, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors. Once per application.

    Every entry point passes here: the registered queries, the jobs and ``checkpoint_dir``, which all
    operators with Python stages of their own call first.
    """
    here = os.path.dirname(os.path.abspath(__file__))
    root, app = os.path.dirname(here), spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    path = os.path.join(tempfile.mkdtemp(prefix="assetlake-ship-"), "assetlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
