"""Session construction and lineage cutting."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "riskframe",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workers_import(spark: SparkSession) -> None:
    """Python workers on this machine find the package whatever the working
    folder; a cluster without a shared install gets it by ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when nothing is configured *and* the master is local (tests, the
    single-node driver) a scratch folder is created; on a cluster a missing
    setting is an error, because a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_checkpoint(df: DataFrame) -> None:
    """Deletes the files of a frame from ``cut_lineage``; no frame that reads it may be used after."""
    spark = df.sparkSession
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file.get())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Spark drops a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_writers, _lock, _before = 0, threading.Lock(), "false"


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """The setting holds while any thread writes; the last one sets it back."""
    global _writers, _before
    with _lock:
        if not _writers:
            _before = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _writers += 1
    try:
        yield
    finally:
        with _lock:
            _writers -= 1
            if not _writers:
                spark.conf.set(_CLEANUP, _before)


_open = threading.local()


@contextlib.contextmanager
def scratch_tables():
    """Tables that ``saved`` writes inside, in this thread, are dropped at the
    end, but for those given to the function it yields, which pass to the
    block around it, if any.  No frame that reads a dropped table may be used after."""
    outer, paths = getattr(_open, "paths", None), {}
    _open.paths = paths

    def keep(df: DataFrame) -> DataFrame:
        spark = paths.pop(df._saved_path)
        if outer is not None:
            outer[df._saved_path] = spark
        return df
    try:
        yield keep
    finally:
        _open.paths = outer
        for path, spark in paths.items():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def saved(df: DataFrame, options: dict | None = None) -> DataFrame:
    """Written as Parquet in the session's shared checkpoint folder and read
    again: cuts the lineage, and survives the loss of any executor.  The
    shuffle files of the writing job go when it ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    if getattr(_open, "paths", None) is not None:
        _open.paths[path] = spark
    with _shuffles_dropped(spark):
        df.write.options(**(options or {})).parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets Spark's cleaner drop what other actions left
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out
