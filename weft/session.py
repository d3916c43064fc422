"""Session helpers: a local session for tests/bench, and the shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a shared
file system path the cluster names). A scratch folder is chosen only for a local master
with nothing configured; another master without the setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "weft") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WEFT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Java's regex engine recurses on long texts; tasks run in the driver's JVM here
        .config("spark.driver.extraJavaOptions", "-Xss32m")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only if none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="weft-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/weft-tables/" + name


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add this package's code to the Python path of the executors, once per application.

    Spark's own file server carries the archive, which holds code only."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="weft-code-"), "weft_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(_ROOT, "weft")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, _ROOT))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def ship_active() -> None:
    """The same, for the session in use, where only columns are at hand."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)
