"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on: UTC wall clock for every timestamp
# rendering, AQE for runtime re-planning (partition coalescing, skew-join
# splitting, broadcast only when runtime statistics prove a side is small).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app_name: str = "marketfold",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session.  On a cluster, submit with the cluster's own
    master and conf; only the settings above are required."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("MARKETFOLD_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Pin the settings whose absence changes results (time zone)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextlib.contextmanager
def conf_scope(spark: SparkSession, settings: dict[str, str]):
    """Temporarily override session settings around an eager action."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Parsing stages with many JSON paths generate very large fused methods;
# without whole-stage fusion every expression is compiled on its own (and
# split into methods as needed) instead of failing compilation and falling
# back to interpretation.
NO_WHOLE_STAGE = {"spark.sql.codegen.wholeStage": "false"}


def cut_lineage(df: DataFrame, name: str = "stage", settings: dict[str, str] | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from that table.

    Used where an intermediate result has several consumers (so it is
    computed once), where planning through a long expression lineage is
    expensive, and where a long lineage should not be replayed after an
    executor loss.  One write job; the read side gets file statistics for
    the planner.  Never a machine-local checkpoint."""
    base = checkpoint_dir(df.sparkSession)
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    with conf_scope(df.sparkSession, settings or {}):
        df.write.mode("overwrite").parquet(path)
    cuts(df.sparkSession).append(path)
    return df.sparkSession.read.parquet(path)


_CUTS: dict[str, list[str]] = {}


def cuts(spark: SparkSession) -> list[str]:
    """Paths of the tables that ``cut_lineage`` has written in this application."""
    return _CUTS.setdefault(spark.sparkContext.applicationId, [])


def drop_cuts(spark: SparkSession, paths: list[str]) -> None:
    """Delete some of them: tables that nothing still to be computed reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    gone = set(paths)
    cuts(spark)[:] = [p for p in cuts(spark) if p not in gone]


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and control tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared folder there).  Only where it is unset on a ``local`` master --
    tests, single-machine runs -- a private scratch folder is created and
    registered; any other master without the setting is an error, since a
    machine-local folder would split the data over node disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return str(current).rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    else:
        require_local_master(sc.master)
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="marketfold-ckpt-"))
    # Spark makes a folder of its own in the one that was named.
    return str(sc.getCheckpointDir()).rstrip("/")


def require_local_master(master: str) -> None:
    """Raise unless driver and executors are one process (``local``, ``local[n]``)."""
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")


def release_cuts(spark: SparkSession) -> None:
    """Delete every table ``cut_lineage`` has written under this session's
    checkpoint folder.  Call it when the results built on them are consumed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/tables")
    path.getFileSystem(conf).delete(path, True)
    cuts(spark).clear()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers once per session, so
    tasks can import it whatever the working directory of the executors."""
    sc = spark.sparkContext
    if getattr(sc, "_marketfold_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # Spark's file server hands the archive out for as long as the session lives.
    target = os.path.join(tempfile.mkdtemp(prefix="marketfold-src-"), "marketfold_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for at, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(at, name)
                z.write(full, os.path.join("marketfold", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._marketfold_shipped = True
