"""Session helpers: builder defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Sliding windows and late data need exactly-once state; RocksDB keeps
# large state off the JVM heap. ``transformWithState`` runs on no other store.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only the change log per batch, snapshot in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One memory budget for all RocksDB instances of an executor, however many
    # state partitions it hosts.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}

# Settings ``get_session`` puts on the builder (they override spark-defaults
# for these keys); ``extra`` overrides them. Library functions take any
# session and do not depend on ``get_session``, only on a UTC session time
# zone, which the registered queries pin themselves.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **ROCKSDB,
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "botsieve", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the project defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them ``None`` so the submit-time values are used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors for checkpoints and work tables.

    Taken from ``spark.checkpoint.dir`` as the cluster sets it (or from a
    checkpoint dir already set on the context). Only when neither is set and
    the master is local (tests, local runs) a fresh folder under the system
    temp dir is created and registered as the checkpoint dir; on a cluster
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = None
    try:
        context = spark.sparkContext
    except Exception:  # a Spark Connect session has no context
        pass
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share; "
                               "a machine-local temp folder does not survive a lost executor")
        root = _LOCAL_ROOTS.get(id(spark)) or tempfile.mkdtemp(prefix="botsieve-ckpt-")
        _LOCAL_ROOTS[id(spark)] = root
    if context is not None and not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


_LOCAL_ROOTS: dict[int, str] = {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub folder of the shared root for one job run."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_dir(path: str) -> str:
    if is_local_path(path):
        os.makedirs(path.replace("file://", ""), exist_ok=True)
    return path


def pin_utc(spark: SparkSession) -> None:
    """Windows are epoch aligned; the test tables hold UTC wall-clock times."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def cluster_conf(input_bytes: int, cores: int, shuffle_bytes: int | None = None,
                 split_bytes: int = 512 << 20, partition_bytes: int = 256 << 20,
                 max_partitions: int = 50_000) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on ``cores`` cores.

    * Scan splits of ``split_bytes`` (row groups permitting): 100 TB gives
      ~200k map tasks.
    * Shuffle partitions from the largest shuffle (``shuffle_bytes``; by
      default a tenth of the input, as partial aggregation leaves of the
      detector's input): about ``partition_bytes`` each, at least 2 per core,
      at most ``max_partitions`` (map x reduce blocks grow with both counts).
      AQE coalesces small ones by size (``parallelismFirst=false``) and
      splits skewed join partitions.
    * Streaming state keeps the shuffle partition count of its first start for
      its whole life, so a stream's checkpoint should be started under these
      settings, not under local ones.
    """
    shuffle_bytes = input_bytes // 10 if shuffle_bytes is None else shuffle_bytes
    partitions = min(max_partitions, max(2 * cores, -(-shuffle_bytes // partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
