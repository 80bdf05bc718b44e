"""What the operators share: the shared folder, written intermediates, skew-safe lookups, batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Groups that are looked up by broadcast; every other group then holds at most 1/HOT_GROUPS of the rows.
HOT_GROUPS = 2000
#: Integer ids that may be broadcast at most (some 10 MB).
BROADCAST_IDS = 400_000
#: Rows of an Arrow batch that Python handles at once.
SLICE = 256
#: What takes the JVM's diagnostic commands.
DIAGNOSTICS = "com.sun.management:type=DiagnosticCommand"

_own_dirs: dict[str, str] = {}
_runs: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset on one machine (tests), a folder of our own; executors
    elsewhere would not see such a folder, so then it is an error."""
    given = spark.conf.get("spark.checkpoint.dir", "")
    if given:
        return given.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="pagewright-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return _own_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this run's folder, which goes when the driver ends."""
    run = f"{shared_dir(spark)}/pagewright/{spark.sparkContext.applicationId}"
    if run not in _runs:
        _runs.add(run)
        atexit.register(_removed, spark, run)
    return f"{run}/{name}-{uuid.uuid4().hex}"


def _removed(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped: nothing can reach a shared folder any more
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for what runs meanwhile."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: While a table is written: the driver keeps only the first part of a plan's description (plans with large literals would
#: fill its memory), and shuffle files go with the query that made them.
WRITING = {"spark.sql.maxPlanStringLength": "20000", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # The settings hold for the copy of the plan that is made when it is written.
    with settings(spark, WRITING):
        df.write.parquet(path)
    # Executors keep the blocks of past broadcasts until the driver's heap is swept, which a small driver does rarely.
    trimmed(spark)
    return spark.read.schema(df.schema).parquet(path)


def trimmed(spark: SparkSession) -> None:
    """Collects the garbage of the driver's JVM and gives back what its threads have freed: they are hundreds (broadcasts, query
    stages, blocks), and malloc keeps for each of its arenas what the largest plan or compilation took."""
    java, array = spark._jvm, spark.sparkContext._gateway.new_array
    java.System.gc()
    with contextlib.suppress(Py4JError):  # JVMs without that command
        beans = java.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        values, kinds = array(java.Object, 4), array(java.Class, 4)
        values[0], values[1] = java.javax.management.ObjectName(DIAGNOSTICS), "systemTrimNativeHeap"
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = java.Class.forName(kind)
        # The server's own class isn't open to Py4J, its interface is.
        java.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(beans, values)


def swept(spark: SparkSession) -> None:
    """Collects the executors' garbage, so that their heaps give back what earlier work left: a heap that has grown stays as
    large, and the Python workers of what follows need room beside it. One short task for every core, so each executor
    gets some. The driver's JVM and Python give back their own."""
    released()
    trimmed(spark)
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.call_function("reflect", F.lit("java.lang.System"), F.lit("gc"))).collect()


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table that written() made, when nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/pagewright/" in folder:
            _removed(df.sparkSession, folder)


def lookup(left: DataFrame, key: str, groups: DataFrame, weight: str, spread: Column) -> DataFrame:
    """left LEFT JOIN groups ON key, where one key may hold a third of left's rows.

    groups has one row per key and `weight`, its number of rows in left. The HOT_GROUPS heaviest groups (a fixed
    number of rows) are broadcast; rows that found theirs, or have no key, get a key of their own (from `spread`) in
    the shuffled join for the rest, so that no task receives more than 1/HOT_GROUPS of the rows for one key.
    """
    values = [c for c in groups.columns if c not in (key, weight)]
    groups = groups.where(F.col(key).isNotNull())
    hot = groups.orderBy(F.desc(weight), key).limit(HOT_GROUPS)
    hot = hot.select(F.col(key).alias("__hk"), F.struct(*values).alias("__hv"))
    rest = groups.select(F.col(key).cast("string").alias("__rk"), F.struct(*values).alias("__rv"))
    out = left.join(F.broadcast(hot), F.col(key) == F.col("__hk"), "left")
    own = F.when(F.col("__hk").isNotNull() | F.col(key).isNull(), F.concat(F.lit("\u0000"), spread.cast("string")))
    out = out.withColumn("__lk", F.coalesce(own, F.col(key).cast("string")))
    out = out.join(rest, F.col("__lk") == F.col("__rk"), "left")
    found = F.coalesce(F.col("__hv"), F.col("__rv"))
    return out.select(*left.columns, *[found[c].alias(c) for c in values])


def keyed(df: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    """df semi- or anti-joined with a table of one distinct integer column: by broadcast up to BROADCAST_IDS of them,
    which are counted first, else shuffled."""
    ids = written(ids.toDF("__id"), "ids")
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, F.col(key) == F.col("__id"), how)


def released() -> None:
    """Gives a Python worker's free memory back: it waits for more tasks beside the executor, whose limit it shares."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only in the GNU library
        ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = SLICE, done: Callable[[], None] | None = None) -> DataFrame:
    """df.mapInArrow over slices of at most `rows` rows, so that Python never holds a whole Arrow batch's results. When a
    task has no more rows, done() is called and free memory given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield fn(batch.slice(at, rows))
        if done:
            done()
        released()

    return df.mapInArrow(run, schema)
