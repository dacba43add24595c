"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames.  ``local_session`` exists for tests, the bench and the smoke
entry; on a cluster the application's own session is used as it is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours should carry.  AQE coalesces the many small
# shuffle partitions of the report queries and splits skewed join partitions;
# UTC keeps timestamp text stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No broadcast from file-size estimates (a filtered or pruned fact can look
    # small); AQE still turns a join into a broadcast when the measured
    # runtime size of a side is under its threshold, and explicit hints are
    # only placed on sides with a proven bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "citesight", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (local tests) do we set a scratch folder of our own.
    """
    sc = _context(spark)
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="citesight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


class _Held:
    def __init__(self, value):
        self.value = value


def share(spark: SparkSession, value):
    """A read-only value for tasks: a broadcast variable when the session has
    a SparkContext, else carried with the task closure."""
    sc = _context(spark)
    return sc.broadcast(value) if sc is not None else _Held(value)


def materialize(df, how: str = "parquet", partition_by: list[str] | None = None, to=None):
    """Cut the lineage of ``df`` by writing it to the shared folder named by
    ``spark.checkpoint.dir`` and reading it back.

    The copy survives the loss of executors (unlike a cached or local copy),
    and later stages -- statistics, the forest, several readers of one small
    result -- start from it instead of re-running the upstream joins and
    aggregates.  ``how="parquet"`` (default) writes a Parquet table (columnar,
    with exact size statistics for the planner); ``how="checkpoint"`` uses
    ``DataFrame.checkpoint``.  ``partition_by`` keeps rows apart in folders; ``to`` is the
    session that reads the copy, if it is another than that of ``df``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = scratch_path(spark)
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    read = (to or spark).read
    return read.schema(df.schema).parquet(path) if partition_by else read.parquet(path)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder; ``drop_materialized`` deletes it."""
    import uuid
    ensure_checkpoint_dir(spark)
    return f"{_tables(spark)}/{uuid.uuid4().hex}"


def drop_materialized(spark: SparkSession) -> None:
    """Delete the tables that ``materialize`` has written for this application;
    call it when no result that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_tables(spark)}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _tables(spark: SparkSession) -> str:
    sc = _context(spark)
    app = sc.applicationId if sc is not None else "connect"
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{app}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (for the few Arrow
    functions that run library code inside tasks).  The package is zipped
    once per application and distributed with ``addPyFile`` (or as an
    artifact on a Spark Connect session)."""
    import shutil
    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="citesight-pkg-")
    archive = shutil.make_archive(os.path.join(out, "citesight"), "zip", os.path.dirname(pkg), "citesight")
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(app)
