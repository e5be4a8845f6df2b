"""Session helpers: the caller owns the SparkSession; we only read settings.

``checkpoint_dir`` follows the cluster: the shared folder named by
``spark.checkpoint.dir``.  Only when that is unset and the master is local
(unit tests, a laptop) do we pick a scratch folder of our own; on a cluster an
unset folder is an error.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Confs the engine is written for (all are public Spark settings).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortflow") -> SparkSession:
    """A local session for tests and the bench (not used by the library)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Scans of the small test files split finely enough to use every core.
    b = b.config("spark.sql.files.maxPartitionBytes", "2m").config("spark.sql.files.openCostInBytes", "256k")
    b = b.config("spark.driver.memory", "8g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder, set from ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # One machine only (tests, a laptop): a fresh scratch folder.
        conf_dir = tempfile.mkdtemp(prefix="cohortflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


class Lazy(Mapping):
    """A mapping whose values are built on first access."""

    def __init__(self, builders: dict[str, Callable]):
        self._builders = builders
        self._built: dict = {}

    def __getitem__(self, key: str):
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def materialize(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared
    checkpoint folder and scanning it back.

    Used for derived tables that several later stages read (role tables,
    cohort, vocabulary, indexed features): a lost executor then re-reads the
    table instead of recomputing it from the raw scans, and the re-read is a
    normal parquet scan with column pruning and filter pushdown (an RDD
    checkpoint would serialise rows and hide them from the optimiser).  ``schema``: what to read
    the table as, where that is not as it was written.
    """
    return materialize_at(df, schema=schema)[0]


def materialize_at(df: DataFrame, *partition_by: str, schema: StructType | None = None) -> tuple[DataFrame, str]:
    """``materialize`` with the table's folder, for ``release_tables`` as soon as it is not read any more."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cohortflow-tables/{uuid.uuid4().hex}"
    track_table(spark, path)
    with _own_shuffles_freed(spark):
        df.write.mode("error").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path), path


#: Spark's own setting: shuffle files go when the statement that wrote them ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _own_shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Free the shuffle files of the writes inside the block as each one ends.

    A stage table cuts the lineage, so nothing reads its shuffles again; otherwise they
    stay on the executors' disks until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


# (path, Hadoop path, its file system): the Java objects outlive the session.
_WRITTEN: list[tuple] = []


def track_table(spark: SparkSession, path: str) -> None:
    """Register a folder this process writes, for deletion by ``release_tables``."""
    if not _WRITTEN:
        atexit.register(release_tables)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _WRITTEN.append((path, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())))


def release_tables(paths: list[str] | None = None) -> None:
    """Delete stage tables this process wrote: the given ones, or all of them.

    Also works after ``spark.stop()`` (the file system objects are kept), so the
    call at exit leaves an empty folder behind.
    """
    wanted = None if paths is None else {p.split(":", 1)[-1].lstrip("/") for p in paths}
    chosen = [w for w in _WRITTEN if wanted is None or w[0].split(":", 1)[-1].lstrip("/") in wanted]
    for w in chosen:
        _WRITTEN.remove(w)
        try:
            w[2].delete(w[1], True)
        except (Py4JError, OSError):  # the JVM is gone: nothing can be deleted from here
            return


@contextmanager
def stage_scope(spark: SparkSession):
    """Free every stage table written inside the block when it ends.

    Results must be written or collected inside the block.
    """
    before = {w[0] for w in _WRITTEN}
    try:
        yield spark
    finally:
        release_tables([w[0] for w in _WRITTEN if w[0] not in before])
