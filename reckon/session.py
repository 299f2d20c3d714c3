"""Session helpers: a tuned local/test session and lineage cutting.

On a cluster the session comes from the platform; these helpers only read
its settings. ``spark.checkpoint.dir`` must name a shared folder there;
tests set their own because it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key also where that costs one more shuffle (chained lookups on one key)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app: str = "reckon",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session for local runs and tests.

    A checkpoint folder is only created when the session has none.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) or spark.sparkContext.master.startswith("local"):
        # a scratch folder only for local runs; on a cluster the platform names
        # the shared folder (cut_lineage raises if it does not)
        ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any (works on a
    classic session and, through the conf, on a Connect session)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
        if d:
            return d
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the session's ``spark.checkpoint.dir``; only when unset (local
    tests) create a scratch folder."""
    d = checkpoint_dir(spark)
    if not d:
        d = fallback or tempfile.mkdtemp(prefix="reckon-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Cut the lineage of ``df``: write it as a table into the shared
    checkpoint folder and return a frame reading that table back.

    The folder is the session's ``spark.checkpoint.dir``; only a
    local-mode session without one gets a scratch folder, and on a cluster
    an unset folder is an error (a machine-local folder is not shared).
    A written parquet table (rather than an RDD checkpoint) keeps the data
    columnar and gives the planner real size statistics for the rest of
    the job. The write goes through Spark's committer, so a lost executor's
    task is retried and the table is complete once the write returns.
    ``fmt='checkpoint'`` uses ``DataFrame.checkpoint`` instead."""
    spark = df.sparkSession
    if fmt == "checkpoint":
        try:
            sc = spark.sparkContext
        except Exception:  # noqa: BLE001 - Spark Connect: the server's spark.checkpoint.dir applies
            return df.checkpoint(eager=True)
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(shared_dir(spark))
        return df.checkpoint(eager=True)
    import uuid

    path = f"{shared_dir(spark).rstrip('/')}/reckon-cut/{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(path)
    return spark.read.format(fmt).load(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; an error on a cluster that names none."""
    d = checkpoint_dir(spark)
    if d:
        return d
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001
        master = spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder to cut lineage")
    return ensure_checkpoint_dir(spark)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at max(input / target, 3 x cores) so that no
    partition exceeds ~``target_partition_bytes`` even before AQE looks at
    the real sizes; AQE then coalesces small ones towards the same advisory
    size and splits skewed ones (a hot key holding a third of the rows is
    split into advisory-sized pieces on the join side that allows it).
    Scan splits use the same target so each task reads about one
    partition's worth of parquet.

    For 100 TB on 1000 executors x 8 cores that gives ~410k initial shuffle
    partitions and 256 MB scan splits.
    """
    target = int(target_partition_bytes)
    n = max(int(input_bytes // target) + 1, 3 * int(total_cores))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # Broadcast only what is measured small; AQE re-checks at run time.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL confs on an existing session (what spark-submit
    would pass with --conf)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
