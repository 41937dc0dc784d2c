"""Session helpers: recommended configuration and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed around. AQE re-plans joins from runtime
# sizes (a broadcast only happens when the measured side is under the
# threshold), splits skewed join partitions and coalesces small shuffle
# partitions, so the static partition count can stay high for big inputs.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Additional settings for a large shared cluster: coalesce shuffle partitions
# to the advisory size instead of maximising parallelism (which makes many
# tiny tasks on a 1000-executor cluster), split skewed partitions earlier,
# and keep the broadcast threshold explicit.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
}


def build_session(
    master: str | None = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "pacelake",
    extra: dict | None = None,
    cluster: bool = False,
) -> SparkSession:
    """A session with the settings the operators are designed around.

    ``cluster=True`` adds ``CLUSTER_CONF`` (for a large shared cluster;
    ``shuffle_partitions`` is then only a floor — builds size it from the
    input anyway) and leaves the master to ``spark-submit``.
    ``master=None`` never sets a master.
    """
    if cluster:
        master = None if master == "local[*]" else master
        extra = {**CLUSTER_CONF, **(extra or {})}
        shuffle_partitions = max(shuffle_partitions, int(CLUSTER_CONF["spark.sql.shuffle.partitions"]))
    b = SparkSession.builder if master is None else SparkSession.builder.master(master)
    b = (
        b.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        if k != "spark.sql.shuffle.partitions":
            b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``. Only in local mode, when the
    session has none (tests), a fresh private folder is created and set; a
    cluster session without it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set: set it to a folder on shared storage "
                    "(a machine-local folder is lost with its executor)"
                )
            d = tempfile.mkdtemp(prefix="pacelake-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def shared_root(spark: SparkSession) -> str:
    """The configured shared folder itself (``scratch_root`` is a per-application
    subfolder of it), for results that later applications may reuse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or scratch_root(spark).rsplit("/", 1)[0]).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new unique path under the scratch root (never reused between runs)."""
    root = scratch_root(spark)
    return "/".join([root.rstrip("/"), *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    return path[len("file:") :] if path.startswith("file:") else path


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_local_dir(path: str) -> None:
    if is_local(path):
        os.makedirs(local_path(path), exist_ok=True)


# --- shuffle sizing -------------------------------------------------------------------
TARGET_PARTITION_BYTES = 8 * 1024 * 1024
MANY_PARTITIONS = 4000  # beyond these, partitions grow instead
LARGE_PARTITION_BYTES = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under the given paths (one listing call each)."""
    from pacelake.sources.fs import total_bytes

    return total_bytes(spark, *paths)


def shuffle_partitions_for(spark: SparkSession, nbytes: int) -> int:
    """Enough partitions for ~8 MB of (compressed) input each, up to
    ``MANY_PARTITIONS`` of them, then ~128 MB each; at least two per task slot.
    AQE coalesces them down when the shuffled data turns out smaller."""
    slots = spark.sparkContext.defaultParallelism
    want = min(MANY_PARTITIONS, -(-nbytes // TARGET_PARTITION_BYTES))
    return int(max(2 * slots, want, -(-nbytes // LARGE_PARTITION_BYTES)))


def build_conf(nbytes: int) -> dict[str, str]:
    """Task sizes of a build. Its rows are narrow on disk and costly to parse:
    tasks of 64 or 128 MB take most of a minute and leave slots idle in the last
    wave, so they are 16 MB unless that gives too many. The shuffle files of a
    written step go when it ends: Spark's cleaner would keep them until the driver
    collects its garbage, so those of all steps would lie on the disks at once."""
    size = "16m" if nbytes <= MANY_PARTITIONS * TARGET_PARTITION_BYTES else "128m"
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }


_SHUFFLES = "spark.sql.shuffle.partitions"

_SIZING_LOCK = threading.Lock()
_SIZING: dict[str, tuple[int, dict]] = {}  # application id -> (open builds, saved settings)


class sized_shuffles:
    """Context manager: raise ``spark.sql.shuffle.partitions`` to fit the
    input size for the duration of a build (never below the session's own
    setting), and set ``build_conf``. Reference-counted, so concurrent builds
    in one session restore the original settings only when the last one
    finishes."""

    def __init__(self, spark: SparkSession, *paths: str):
        self.spark, self.paths = spark, paths

    def __enter__(self):
        conf = self.spark.conf
        nbytes = input_bytes(self.spark, *self.paths)
        n, sizes = shuffle_partitions_for(self.spark, nbytes), build_conf(nbytes)
        app = self.spark.sparkContext.applicationId
        with _SIZING_LOCK:
            depth, saved = _SIZING.get(app, (0, None))
            if saved is None:
                saved = {k: conf.get(k, None) for k in (_SHUFFLES, *sizes)}
                for k, v in sizes.items():
                    conf.set(k, v)
            conf.set(_SHUFFLES, str(max(n, int(conf.get(_SHUFFLES)))))
            _SIZING[app] = (depth + 1, saved)
        return self

    def __exit__(self, *exc):
        app = self.spark.sparkContext.applicationId
        with _SIZING_LOCK:
            depth, saved = _SIZING[app]
            if depth == 1:
                for k, v in saved.items():
                    self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
                del _SIZING[app]
            else:
                _SIZING[app] = (depth - 1, saved)
        return False
