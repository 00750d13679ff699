"""Session and scratch-space helpers.

Scratch data (state versions, commit rows, streaming checkpoints, lineage
cuts) always lives under the shared folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) do we
create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects.

    AQE on (coalesce + skew join), UTC session time zone, no web UI.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Delete reliable checkpoints once unreferenced.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(made)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - unusual confs
        return 200


def spread(df, partitions: int):
    """Deal rows out evenly over ``partitions`` tasks, for CPU-heavy per-row work
    (JSON encoding/parsing) on a scan of few large splits. One shuffle; leave it out where the scan
    has as many splits as there are slots."""
    return df.repartition(partitions)


def scale_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 << 20,
               large_state: bool = False) -> dict[str, str]:
    """Recommended settings for a job reading ``input_bytes`` on ``total_cores``
    task slots: initial shuffle partitions sized so each holds about
    ``target_partition_bytes`` (AQE coalesces small ones and splits skewed
    ones), scan splits of the same size, and RocksDB state for streaming
    aggregations over large key sets."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
    if large_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return conf


def apply_conf(spark: SparkSession, conf: dict[str, str], *, overwrite: bool = False) -> dict[str, str]:
    """Set runtime SQL confs. Unless ``overwrite``, keys the cluster set
    explicitly (present in the SparkConf) are left alone."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    applied = {}
    for k, v in conf.items():
        if not overwrite and k in explicit:
            continue
        try:
            spark.conf.set(k, v)
            applied[k] = v
        except Exception:  # static confs (e.g. the state store provider) only apply at startup
            pass
    return applied
