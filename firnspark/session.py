"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on.  Shuffle sizing is left to AQE:
# it coalesces small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The wide tables have up to 142 columns, their moments 164 sums.
    "spark.sql.codegen.maxFields": "1000",
    # The JVM never compiles a method of more bytecode; such a stage runs as split projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Folders made for local sessions that name none, by application.
_own_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "firnspark", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may run without the setting: driver and executors are then one
    process, and its folder goes when that process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        root = tempfile.mkdtemp(prefix="firnspark-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _own_roots[app] = f"file://{root}"
    return _own_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the application ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


# Where copies were written, for ``discard``.
_copies: WeakKeyDictionary[DataFrame, list[str]] = WeakKeyDictionary()
# Rows that a task writes, and tasks that may write at least, where a bound of the rows is known.
TASK_ROWS, FEWEST_TASKS = 1 << 16, 24
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession, drop: bool) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true" if drop else before)
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, label: str = "stage", drop_shuffles: bool = False, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, as compressed columns, and continue from that copy.

    Lineage ends there, the copy outlives lost executors, and later readers get column
    pruning and pushed filters.  With ``drop_shuffles`` the write's shuffle files go at once.
    ``rows``, a bound of its rows, keeps a small frame from being written by a task for every shuffle
    partition, also where AQE does not coalesce these.
    """
    if rows is not None:
        df = df.coalesce(max(FEWEST_TASKS, -(-rows // TASK_ROWS)))
    path = scratch_path(df.sparkSession, label)
    with _shuffles_dropped(df.sparkSession, drop_shuffles):
        df.write.option("compression", "zstd").parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    _copies[copy] = [path]
    return copy


def gathered(copies: list[DataFrame]) -> DataFrame:
    """Copies of one schema that ``materialise`` has made, as one."""
    paths = [path for copy in copies for path in _copies[copy]]
    whole = copies[0].sparkSession.read.schema(copies[0].schema).parquet(*paths)
    _copies[whole] = paths
    return whole


def discard(*copies: DataFrame) -> None:
    """Delete copies that ``materialise`` has made and nothing reads any more; other frames stay."""
    for copy in copies:
        for path in _copies.pop(copy, []):
            context = copy.sparkSession.sparkContext
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
