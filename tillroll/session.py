"""Session helpers: ``get_spark`` for tests and the bench on one machine, ``submitted_session`` for jobs.

On a cluster the checkpoint directory must be a shared folder named by
``spark.checkpoint.dir``; we only read it.  A private folder is created only
for local-mode sessions (tests, bench) that have none configured.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[8]", app: str = "tillroll",
              shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # MIN/MAX/COUNT without filters are answered from Parquet footers.
        .config("spark.sql.parquet.aggregatePushdown", "true")
        # Checkpoint files of collected DataFrames are removed, not left to grow.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master.startswith("local"):
        # One machine, local disk: listing the date folders on the driver is
        # faster than a listing job.  Clusters keep Spark's parallel listing.
        builder = builder.config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, wiring it into the context.

    Order: directory already set on the context, then the
    ``spark.checkpoint.dir`` setting; a fresh local folder only when the
    master is local and nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    path = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(path)
    return path


def submitted_session(app: str = "tillroll") -> SparkSession:
    """The session of a submitted job: master, partitions and memory are the submitter's."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    checkpoint_dir(spark)
    return spark


def hadoop_path(spark: SparkSession, path: str):
    """(path, its file system) of the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def entry_names(spark: SparkSession, path: str) -> list[str]:
    """The names of a folder's own entries; none where it is missing.  All of them come from the JVM as one text: a few
    calls an entry are seconds for some thousand date folders."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    if not len(paths):
        return []
    folder = paths[0].getParent().toString().rstrip("/") + "/"
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)  # {folder/name,folder/name}
    return text[1:-1].removeprefix(folder).split(f",{folder}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None where there is none."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there; after a crash there may be none."""
    p, fs = hadoop_path(spark, path)
    new, _ = hadoop_path(spark, f"{path}__new-{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(p, False)
    if not fs.rename(new, p):
        raise RuntimeError(f"could not put {path} in place")


ASKED_ONE_BY_ONE = 64  # date folders; of more, those that exist are found by one listing of the root's own entries


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """While a table of many date folders is opened, a listing task takes many folders: Spark's own number is a task a
    folder, up to 10,000, of which the driver starts a few hundred a second."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


CODEC = "zstd"  # of staged and stored tables: about two thirds of snappy's space

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing = threading.Lock(), {}  # session -> (writes under way, the setting before them)
_here = threading.local()


@contextmanager
def freed_shuffles(spark: SparkSession):
    """What is written inside leaves no shuffle files.  Spark's own cleaning waits until the driver happens to collect its
    garbage, so the files of many steps lie on the disks at once."""
    key = spark._jsparkSession.hashCode()
    with _lock:
        n, before = _writing.get(key) or (0, spark.conf.get(_FREE_SHUFFLES, "false"))
        _writing[key] = n + 1, before
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(key)
            if n > 1:
                _writing[key] = n - 1, before
            else:
                spark.conf.set(_FREE_SHUFFLES, before)


def staged(df: DataFrame, tag: str = "stage", by: tuple = ()) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder (shared on a cluster) and read it back: lineage
    is cut, later jobs prune columns, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    for kept, paths in reversed(_scratches()):
        if tag not in kept:
            paths.append(path)
            break
    with freed_shuffles(spark):
        df.write.option("compression", CODEC).partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Remove the files of a frame that ``staged`` returned; nothing may read it afterwards."""
    path, fs = hadoop_path(df.sparkSession, df._staged_at)
    fs.delete(path, True)


def _scratches() -> list:
    return _here.__dict__.setdefault("scratches", [])


@contextmanager
def scratch(spark: SparkSession, kept: tuple = ()):
    """Tables that this thread stages inside are removed at the end; those with a tag of ``kept`` are the caller's."""
    _scratches().append((kept, []))
    try:
        yield
    finally:
        for name in _scratches().pop()[1]:
            path, fs = hadoop_path(spark, name)
            fs.delete(path, True)


ROWS_AT_ONCE, MOST_PARTS = 10_000_000, 16


def in_parts(weights: dict, at_once: int) -> list[list]:
    """Keys in their order, cut into runs that weigh ``at_once`` or, of much data, its MOST_PARTS-th part.  A step that takes
    a run at a time has intermediate tables and shuffles of a run's size, whatever the whole weighs."""
    limit, out, held = max(at_once, sum(weights.values()) / MOST_PARTS), [], 0
    for key in sorted(weights, key=lambda k: (k is not None, k)):
        if not out or held + weights[key] > limit:
            out.append([])
            held = 0
        out[-1].append(key)
        held += weights[key]
    return out
