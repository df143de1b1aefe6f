"""Session construction and the shared scratch folder.

The master is never hard-coded: it comes from the argument, then from
``SPARK_MASTER``, and only falls back to ``local[*]`` when neither is given
(tests, laptops).  Scratch tables (lineage cuts, demo pipelines) live under
the cluster's ``spark.checkpoint.dir``; a temporary folder is created only
when that setting is absent *and* the master is local.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of ours gets.  AQE re-plans joins (broadcast only
# when the runtime size is under the threshold), coalesces small shuffle
# partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when a later operator reuses the
    # join's partitioning (e.g. a distinct count grouped on the join key) and
    # the split costs an extra shuffle: a key holding a third of the rows
    # must not pin one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Size check behind every broadcast: the planner only broadcasts a side
    # whose estimated (or, under AQE, measured) size is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Datasets that run side by side share the executors evenly.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or return) the active session with the base settings."""
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    elif not os.environ.get("PYSPARK_GATEWAY_PORT"):
        # Not launched by spark-submit (which names the master itself).
        builder = builder.master("local[*]")
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if shuffle_partitions is None:
        scale_shuffle_width(spark)
    return spark


def scale_shuffle_width(spark: SparkSession, per_core: int = 4, input_bytes: int | None = None) -> int:
    """Width of shuffles where the user has set none: ``per_core`` partitions per core of
    the cluster, and with ``input_bytes`` at least one per 128 MB of input, so that
    reducers stay small however large the input is.  AQE coalesces what is too
    fine."""
    name = "spark.sql.shuffle.partitions"
    if spark.sparkContext.getConf().contains(name) or spark.conf.get(name) != "200":
        return int(spark.conf.get(name))
    width = max(200, per_core * spark.sparkContext.defaultParallelism, (input_bytes or 0) // (128 << 20))
    spark.conf.set(name, str(width))
    return width


_toggle = threading.Lock()
_held: dict[tuple[str, str], list] = {}  # (session, setting) -> [who hold it, its value before]


@contextmanager
def held_setting(spark: SparkSession, key: str, value: str):
    """A session setting for a while.  Several may hold it side by side in one session: the
    last one that ends restores it."""
    place = (spark._jsparkSession.sessionUUID(), key)
    with _toggle:
        held = _held.setdefault(place, [0, spark.conf.get(key, None)])
        if not held[0]:
            spark.conf.set(key, value)
        held[0] += 1
    try:
        yield
    finally:
        with _toggle:
            held[0] -= 1
            if not held[0]:
                del _held[place]
                if held[1] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, held[1])


def freed_shuffles(spark: SparkSession):
    """While this is held, the shuffle files of a query go when it ends.  Spark otherwise
    keeps them until the driver happens to collect its garbage, so that those of a whole run
    can be on disk at once.  For writes: a frame that is run again makes them anew."""
    return held_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table_codec(spark: SparkSession) -> str:
    """Compression of the Parquet files that tables are kept in: the session's, where one is
    set, else zstd (about a quarter less on disk than Spark's default)."""
    return spark.conf.get("spark.sql.parquet.compression.codec", None) or "zstd"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables this library writes for itself.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    and the master is local (tests) do we create a temporary folder and
    register it as the checkpoint dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    folder = tempfile.mkdtemp(prefix="strata-scratch-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
