"""Session helpers: a configured SparkSession and the shared scratch location.

Every layer assumes timestamps written as UTC text are parsed in a UTC session
(the ``'Z'`` in the feed's format is a quoted literal, so the session zone is
what makes the instant right).  ``ensure_utc`` enforces that once per job.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the toolkit relies on.  Shuffle partition counts are
# left to the caller on a cluster; AQE coalesces small partitions and splits
# skewed ones at run time.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.mergeSchema": "false",
    # Streaming state (latest-per-key) lives in RocksDB on local disk and is
    # checkpointed to the shared folder, not in the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "strata", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the toolkit defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """UTC feed text is only read correctly in a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_for(spark: SparkSession, rows: int, rows_a_partition: int = 1_000_000) -> None:
    """Let shuffles start with a partition for each ``rows_a_partition`` of ``rows``, if
    that is more than they start with now.  AQE joins small ones to its advisory size,
    so a task's rows do not grow with the input however few partitions were set."""
    now = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if rows > now * rows_a_partition:
        spark.conf.set(INITIAL_PARTITIONS, str(-(-rows // rows_a_partition)))


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing(spark: SparkSession, tasks_a_core: int = 4) -> Iterator[None]:
    """File listings made inside take at most ``tasks_a_core`` tasks a core.  Spark
    starts a task for each folder (up to 10,000 a job), and where every document has a
    folder of its own, starting tasks takes longer than listing."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), tasks_a_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


OPEN_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def small_files(spark: SparkSession, open_bytes: int = 64 * 1024) -> Iterator[None]:
    """Scans that run inside count the opening of a file as at most ``open_bytes`` read.
    Spark counts 4 MB, so that 16 to 32 one-page files make a task, which takes longer to
    start (and to write its part file) than to read them.  There are still as many tasks
    as cores at least."""
    before = spark.conf.get(OPEN_COST)
    known = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(OPEN_COST, str(min(known, open_bytes)))
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


def file_names(spark: SparkSession) -> str:
    """The character set in which the JVM spells file names."""
    return spark.sparkContext._jvm.System.getProperty("sun.jnu.encoding") or "UTF-8"


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder in Hadoop's local file system; None if ``path`` is in
    another one, or spelt otherwise there.  On a cluster such a folder is mounted on all
    machines, as Spark's writers need it too."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    plain = fs.makeQualified(at).toUri().getPath()
    return plain if fs.getScheme() == "file" and (plain.isascii() or file_names(spark) == "UTF-8") else None


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a path every executor and
    the driver can reach).  Only a local session without the setting gets a
    private temporary folder, as in tests.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run; Spark
    makes it on the first write."""
    return f"{checkpoint_root(spark)}/strata/{label}-{uuid.uuid4().hex[:12]}"
