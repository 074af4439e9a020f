"""Spark session and checkpoint-directory helpers.

On a cluster the session is created by the platform and already names a shared
``spark.checkpoint.dir``; nothing here overrides it. Only when the setting is
absent (local runs, tests) is a fresh scratch folder chosen.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one pass of `in_passes` takes, and the most passes there are: each reads the input again.
PASS_ROWS, MOST_PASSES = 16_000_000, 16

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "tableprep", driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and benches (a cluster passes its own)."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables and checkpoints.

    It is the one the session names in ``spark.checkpoint.dir``. Where that is
    unset, a scratch folder is chosen for a single-process master (``local[n]``,
    as in tests); any other master raises, since its executors would not see it.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tableprep-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the checkpoint root for stage tables written by sinks. The
    root keeps its scheme, so every reader resolves it to the same file system."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/" + name


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Spark removes the shuffle files of what is written inside as soon as it is written.
    Otherwise they stay on the executors' disks until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def materialize(df: DataFrame, name: str = 'stage') -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint folder
    and reading it back. Unlike an RDD checkpoint, the re-read table keeps
    column pruning and filter pushdown, so each later fit scans only the
    columns it needs; a lost executor re-reads the files instead of replaying
    the plan that produced them."""
    path = scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    with shuffles_removed(df.sparkSession):
        df.write.mode('overwrite').parquet(path)
    return df.sparkSession.read.parquet(path)


def pass_count(df: DataFrame, rows: int | None = None) -> int:
    """How many passes `in_passes` takes for `df`, which should be cheap to count (a scan)."""
    return max(1, min(MOST_PASSES, -(-df.count() // (rows or PASS_ROWS))))


def in_pass(df: DataFrame, cols, n: int, i: int) -> DataFrame:
    """The rows of pass `i` of `n`: those that are equal on `cols` (NULL == NULL) are in one pass."""
    return df.filter(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(n)) == i)


def write_passes(path: str, n: int, make) -> None:
    """make(i) for every pass, written one after another into the folder `path`, which is
    complete where it has a _SUCCESS file, as any other."""
    for i in range(n):
        df = make(i)
        # the mark of completeness comes with the last pass
        with shuffles_removed(df.sparkSession):
            df.write.mode('append' if i else 'overwrite') \
                .option('mapreduce.fileoutputcommitter.marksuccessfuljobs', str(i == n - 1).lower()).parquet(path)


def in_passes(df: DataFrame, cols, make, name: str, n: int | None = None) -> DataFrame:
    """make(df), where `make` brings together only rows that are equal on `cols`: for a
    large table run pass by pass, each on the rows of some values of `cols` and written
    before the next one starts. All rows take part, once each; a pass shuffles its share of
    them, so the disk holds that share's shuffle files instead of the whole table's.
    `df` is read once in each pass, so it should be a scan with projections."""
    n = n or pass_count(df)
    if n == 1:
        return make(df)
    path = scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    write_passes(path, n, lambda i: make(in_pass(df, cols, n, i)))
    return df.sparkSession.read.parquet(path)
