"""Spark session settings used by tests, the bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every hydroframe job relies on. Time is naive UTC throughout (the inputs carry
# timestamp_ntz), AQE re-plans joins and partition counts from runtime statistics, and its
# skew-join split handles hot keys in the pointer-doubling joins of the network operator.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",  # for sinks.read_with_footers
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "hydroframe") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's session."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.driver.memory", os.environ.get("HYDROFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # stage/task times for later reading, without the UI
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session (driver-created sessions)."""
    for k, v in CORE_CONF.items():
        if k.startswith("spark.ui."):
            continue
        if spark.conf.isModifiable(k):  # static settings stay the cluster's
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here. Where it is
    unset, a local master (tests, the bench) gets a fresh scratch folder; any other raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="hydroframe-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: ``df`` written as Parquet below the shared checkpoint folder and read back.

    Unlike a checkpoint the table is columnar, so a later pass reads only the columns it needs.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers import the functions they run by name; on a cluster (or when the driver was
    started elsewhere) the package is not on their path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="hydroframe-code-")) / "hydroframe.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
