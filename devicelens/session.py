"""Session helpers: a configured session for scripts/tests, the checkpoint
folder, and lineage cuts for small intermediate results."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "devicelens",
                  extra: dict | None = None) -> SparkSession:
    """Session for scripts and tests.  On a cluster use spark-submit's session
    and only call :func:`prepare_session`."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Dedup state of the ingest stream lives off-heap and is checkpointed
        # incrementally.
        .config(STATE_STORE_CONF, STATE_STORE)
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def cluster_conf(shuffled_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int = 256 << 20, broadcast_bytes: int = 64 << 20,
                 scan_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run, to pass to spark-submit (``--conf k=v``).

    ``shuffled_bytes`` is what the largest shuffle moves, not the input: the
    aggregates combine in the map tasks, so it is about map tasks x groups of a
    task x row width (some 100 bytes), and only the readings of cold groups, a few
    columns wide, where the statistics are too large to broadcast.  A shuffle
    partition holds about ``partition_bytes`` of that (never fewer than two waves
    of tasks); AQE merges small ones and splits skewed ones at run time.  When a
    group counts as hot is a setting of its own (plans.group_join.HOT_GROUPS).
    ``scan_bytes`` sizes the tasks that read; ``broadcast_bytes`` is the most a
    measured statistics frame may weigh to be broadcast (Spark's hash table keeps
    the key beside the row: allow each executor twice that)."""
    slots = max(executors * cores_per_executor, 1)
    partitions = max(-(-int(shuffled_bytes) // int(partition_bytes)), 2 * slots)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.session.timeZone": "UTC",
        STATE_STORE_CONF: STATE_STORE,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin what the library's results depend on: UTC session time zone (epoch
    ms <-> timestamp conversions) and a checkpoint folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, the bench) gets a
    fresh folder under the machine's temp dir; a cluster session without it
    is an error, because a machine-local folder would not survive the loss of
    an executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        conf = spark.conf.get(CHECKPOINT_CONF, None)
        if not conf:
            raise RuntimeError(f"set {CHECKPOINT_CONF} on the Spark Connect server") from None
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a shared folder (HDFS/S3/...) for this cluster session"
            )
        conf = tempfile.mkdtemp(prefix="devicelens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in the
    shared checkpoint folder (survives executor loss; never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
