"""Session settings, input tables and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
# bytes of rows that Python workers get at a time; at Spark's default a worker and its executor hold 10,000 whole texts each
BATCH_BYTES_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8000000"


def build_session(app: str = "weirflow", master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session with the settings the operators expect.

    On a cluster leave ``master`` unset; AQE then sizes the shuffles, and
    ``spark.sql.shuffle.partitions`` should come from the submit command.
    """
    put_on_path()
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.memory", "12g")
            .config("spark.sql.shuffle.partitions", str(cores or 8))
        )
    return ship_package(builder.getOrCreate())


def put_on_path() -> None:
    """Let Python processes that the driver's JVM starts find the package; takes effect for a JVM started after it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, wherever the driver was started; once per application."""
    context = spark.sparkContext
    if not getattr(context, "_weirflow_shipped", False):
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="weirflow-"), "weirflow.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        context._weirflow_shipped = True
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables; time zone pinned so timestamps mean the same everywhere."""
    ship_package(spark)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(BATCH_BYTES_CONF, None) is None:  # not set by the user
        spark.conf.set(BATCH_BYTES_CONF, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    known = getattr(spark.sparkContext, "_weirflow_scratch", None)
    if known is None:
        known = tempfile.mkdtemp(prefix="weirflow-")
        spark.sparkContext._weirflow_scratch = known
        spark.sparkContext.setCheckpointDir(f"{known}/checkpoints")
    return known


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder, never used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
