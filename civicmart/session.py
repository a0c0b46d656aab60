"""Session helpers: a sane local/cluster session and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. Cluster-specific sizing (shuffle partitions,
# advisory partition size, executor memory) is left to spark-submit.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "civicmart", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the library defaults (caller's ``conf`` wins)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _context(spark: SparkSession):
    """The SparkContext in classic mode; None under Spark Connect (no context there)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect raises for sparkContext
        return None


def application_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and everything runs in one process
    (``local`` masters, as in tests) a folder of our own is created and registered.
    Elsewhere executors would not share such a folder, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if sc is None:  # Spark Connect: the server's configured folder
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if configured:
        sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="civicmart-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def cluster_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.05,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run, to pass to ``build_session(conf=...)`` or spark-submit.

    * Scan splits of ``partition_bytes`` (256 MiB): 100 TB gives ~400k scan tasks,
      about 50 waves on 8,000 cores, each split small enough to decode in memory.
    * Shuffles start from enough partitions that the largest shuffle (the fact
      join, about ``shuffle_fraction`` of the input after column pruning) lands
      near ``partition_bytes`` per reducer; AQE then coalesces the small ones to
      the same advisory size and splits skewed ones.
    * Broadcast stays capped at 64 MiB: dimensions and per-year frames fit, a
      customer-sized table never does, so the big join always sort-merges.
    """
    shuffle_bytes = max(int(input_bytes * shuffle_fraction), 1)
    initial = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


_SCRATCH: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared one, for what its queries write on the way.

    It goes when the driver's process ends, or earlier by ``remove_scratch``.
    """
    root = f"{shared_dir(spark)}/civicmart-{application_id(spark)}"
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(_remove, root)
    return root


def _remove(root: str) -> None:
    from civicmart.sources import store
    if root in _SCRATCH:
        _SCRATCH.discard(root)
        store.remove(root)


def remove_scratch(spark: SparkSession) -> None:
    """Remove all that queries of this application wrote to the shared folder; frames read from it end."""
    from civicmart.sources.mart import forget
    forget(spark)
    _remove(scratch_root(spark))
