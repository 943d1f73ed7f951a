"""Session helpers: configuration defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on.  They are session-scoped and can
# be set on an existing session (e.g. the one a cluster hands us).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Later duplicate column names in a change-feed after-image win.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # partition folder values of keyed tables stay text (log_date, create_date, dt)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str | None = None, app: str = "cartwheel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    Without ``master`` and ``shuffle_partitions`` those of spark-submit or the cluster hold; ``shuffle_partitions``
    should be sized so one partition holds roughly 128-256 MB of shuffle data.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RUNTIME_CONF)
    conf.update({
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) is a folder
    chosen here.  Streaming checkpoints, keyed tables and lineage cuts all
    live below it, so they survive the loss of any executor.
    """
    try:
        sc = spark.sparkContext          # not available on a Spark Connect session
    except Exception:  # noqa: BLE001
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store): streaming "
                               "checkpoints, keyed tables and lineage cuts must survive executor loss")
        d = tempfile.mkdtemp(prefix="cartwheel-ckpt-")   # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
PLAIN_RENAMES = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
SOURCE_CLEANUP = "spark.sql.streaming.fileSource.log.cleanupDelay"


@contextlib.contextmanager
def many_batches(spark: SparkSession, path: str):
    """For queries of many small micro-batches with checkpoints below ``path``: start them inside.  The file source forgets the lists
    of old micro-batches after some seconds, as every micro-batch looks through those that it keeps.  In local folders
    progress is noted through Spark's ``FileSystem`` based file manager: the default one starts some fifteen processes for a file (Hadoop's
    ``stat`` and ``chmod``) and is no safer there, as both look whether the file is there, then rename.  What the session itself sets
    stays, and comes back at the end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    wanted = {SOURCE_CLEANUP: "10s"} | ({CHECKPOINT_FILES: PLAIN_RENAMES} if where == "file" else {})
    set_here = [k for k in wanted if k not in spark.conf.getAll]
    for k in set_here:
        spark.conf.set(k, wanted[k])
    try:
        yield
    finally:
        for k in set_here:
            spark.conf.unset(k)


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh working folder for one run, under the shared folder."""
    return work_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def work_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_root(spark), *parts])
