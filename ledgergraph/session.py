"""Session construction and lineage cutting.

Lineage is cut with reliable ``DataFrame.checkpoint()`` or with scratch tables in the folder the cluster names in
``spark.checkpoint.dir``. Only a local-mode session (tests, bench) without that setting gets a
scratch folder of its own; a cluster session without it is an error, never a machine-local folder.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import warnings
import zipfile
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[8]", app: str = "ledgergraph", shuffle_partitions: int = 8,
              extra: dict | None = None, driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the library is measured with. ``driver_memory`` is left to the caller:
    in local mode the driver is the whole of Spark."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove checkpoint files of frames that are no longer referenced; compress the rest
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgergraph`` importable in Python workers: the per-partition helpers of
    mapInPandas are pickled by reference to this package.

    Local mode only: the package is zipped and added with ``addPyFile``. On a cluster it is
    shipped with ``spark-submit --py-files ledgergraph.zip`` (no driver-local files are made)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgergraph-pyfiles-"), "ledgergraph.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading ``spark.checkpoint.dir`` from the session.

    Sets a scratch folder only for a local-mode session that has none (as in tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgergraph-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and return a frame reading it back.

    Survives executor loss, unlike a local checkpoint, and keeps rows in the partitions they were in;
    the planner does not know how they are partitioned, though, so a later join or aggregation on the
    same keys shuffles them again. Rows are stored whole: for tables that later plans filter or read in
    part use ``staged``."""
    ensure_checkpoint_dir(df.sparkSession)
    with tidy_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)        # a frame's plan is tidied if it is made in here


# --- scratch tables -------------------------------------------------------------------------------
# What a session has written under the checkpoint folder: (path, table name or ""), by application.
_SCRATCH: dict[str, dict[str, str]] = {}


def _scratch_path(spark: SparkSession, tag: str, table: str = "") -> str:
    path = f"{ensure_checkpoint_dir(spark)}/tables/{table or f'{tag}_{uuid.uuid4().hex[:12]}'}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, {})[path] = table
    return path


#: compression of scratch tables: most of their bytes are hashes as hex text, of which it leaves half
SCRATCH_CODEC = "zstd"


def write_scratch(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet under the checkpoint folder; the path. Deleted by ``release_scratch``."""
    path = _scratch_path(df.sparkSession, tag)
    writer = df.write.option("compression", SCRATCH_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with tidy_shuffles(df.sparkSession):
        writer.parquet(path)
    return path


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A folder of the caller's own under the checkpoint folder. Deleted by ``release_scratch``."""
    return _scratch_path(spark, tag)


def staged(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as a scratch table and read back: later plans prune columns and partitions
    and push filters into it."""
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, tag, partition_by))


def bucketed_table(df: DataFrame, prefix: str, keys: list[str], buckets: int,
                   placed: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` as a table bucketed on ``keys`` under the shared checkpoint folder and
    return (the table, its name). Joins on ``keys`` then read it pre-partitioned, without an
    exchange on this side. One file per bucket: the rows are hash-partitioned the same way first,
    unless they are ``placed`` like that already (then any other rows only make more files).

    A catalog that refuses such tables gets a staged table instead (name ""): same rows, but joins
    shuffle. Any other failure is an error."""
    spark = df.sparkSession
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    path = _scratch_path(spark, prefix, name)
    try:
        rows = df if placed else df.repartition(buckets, *keys)
        with tidy_shuffles(spark):
            (rows.write.option("compression", SCRATCH_CODEC).bucketBy(buckets, *keys).option("path", path).saveAsTable(name))
    except AnalysisException as e:
        warnings.warn(f"bucketed table refused ({str(e).splitlines()[0]}); staging without buckets: "
                      "same result, joins on these keys will shuffle", stacklevel=2)
        _delete(spark, path)
        return staged(df, prefix), ""
    return spark.table(name), name


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch table: its catalog entry and its files (an external table keeps them)."""
    known = _SCRATCH.get(spark.sparkContext.applicationId, {})
    if name := known.pop(path, ""):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table made by ``bucketed_table``, files included."""
    if name:
        _delete(spark, f"{ensure_checkpoint_dir(spark)}/tables/{name}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of ``write_scratch``."""
    _delete(spark, path)


def staged_alone(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """``staged(make(), tag)``, after which the scratch tables that ``make`` has written for it are deleted."""
    before = scratch_tables(spark)
    df = make()
    path = write_scratch(df, tag)
    release_scratch(spark, since=[*before, path])
    return spark.read.schema(df.schema).parquet(path)


def scratch_tables(spark: SparkSession) -> list[str]:
    """Paths of the scratch tables that exist."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, {}))


def release_scratch(spark: SparkSession, since: list[str] = ()) -> None:
    """Delete this session's scratch tables, or those that are not in ``since`` (an earlier
    ``scratch_tables``). Frames that read them must not be used afterwards; the caches of the query
    registry are emptied with ``plans.queries.release``."""
    keep = set(since)
    for path in scratch_tables(spark):
        if path not in keep:
            _delete(spark, path)


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Apply session settings for the duration of a block and restore the previous values."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def tidy_shuffles(spark: SparkSession):
    """For the duration of a block the shuffle files of an execution are deleted when it ends, as what it has
    written is read from then on. Otherwise they stay on the executors' disks until the driver's garbage
    collector happens to find their frames, and a query of many steps holds the shuffles of all of them."""
    return scoped_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def buckets_for(spark: SparkSession, rows: int, rows_per_bucket: int) -> int:
    """Bucket count sized by the data alone: ~``rows_per_bucket`` rows each, at least the default
    parallelism."""
    return max(1, spark.sparkContext.defaultParallelism, math.ceil(rows / rows_per_bucket))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
