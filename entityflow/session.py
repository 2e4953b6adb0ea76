"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Runtime SQL settings. They never override cluster sizing (executors, memory,
# shuffle partitions): those belong to whoever submits the job.
RUNTIME_CONF = {
    # Timestamps are instants; every text rendering is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn measured-small sides into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # page_window keeps the first 2000 rows per category; this lets the
    # optimizer cut each map task to its own first 2000 before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2000",
    # Rows handed to a Python function at once. A page body may be megabytes
    # long, so the usual 10,000 rows per batch could be tens of gigabytes.
    BATCH_ROWS: "256",
    # Map states and timers of the exact TTL stream.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that its Arrow functions run where it isn't installed."""
    context = spark.sparkContext
    if getattr(context, "_entityflow_shipped", False):
        return
    root = Path(__file__).parent
    place = Path(tempfile.mkdtemp(prefix="entityflow-code-")) / "entityflow.zip"
    with zipfile.ZipFile(place, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(place))
    context._entityflow_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session and send it the package."""
    ship(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "entityflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session for local runs and tests; on a cluster use ``configure``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    ``spark.checkpoint.dir`` names it on a cluster. Only when that is unset
    (local tests) a fresh temporary folder is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="entityflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other step uses.

    All paths of one application lie in one folder, which can be dropped when
    the application has ended.
    """
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark).rstrip('/')}/entityflow/{app}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def settle(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write a result once to the shared folder and continue from the written table.

    For results that several later steps read, or whose true size should
    decide a join: the written table has exact statistics, so it is broadcast
    when it is small and shuffled when it is not. It also survives the loss
    of executors without recomputing what led to it. ``batch_rows`` sets how
    many rows Arrow functions get at once, for this write alone.
    """
    spark, place = df.sparkSession, work_path(df.sparkSession, label)
    if batch_rows is None:
        df.write.parquet(place)
    else:
        before = spark.conf.get(BATCH_ROWS)
        spark.conf.set(BATCH_ROWS, str(batch_rows))
        try:
            df.write.parquet(place)
        finally:
            spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(place)
