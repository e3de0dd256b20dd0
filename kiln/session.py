"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every kiln job relies on.  AQE re-plans joins from runtime sizes
# (this is the size check behind every broadcast), coalesces small shuffle
# partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Whether Spark deletes a query's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "kiln", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with kiln's settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.  ``shuffle_partitions`` should be sized so one shuffle
    partition holds ~128 MB at the target scale; AQE coalesces below that.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("KILN_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the kiln package to the executors, so that they need no copy of their own (once a session)."""
    sc = spark.sparkContext
    if getattr(sc, "_kiln_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="kiln-package-"), "kiln.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("kiln", os.path.relpath(path, package)))
    sc.addPyFile(archive)
    sc._kiln_shipped = True


def partitions_for(input_bytes: int, target_bytes: int = 128 << 20, minimum: int = 1) -> int:
    """Shuffle partitions so that one partition holds about ``target_bytes``.

    e.g. ``partitions_for(100 * 2**40)`` -> 819200 for 100 TB of shuffled input;
    AQE then coalesces partitions that turn out smaller.
    """
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without one
    (tests) gets a fresh scratch folder; on a cluster a missing setting is an
    error, since each machine would write to its own disk.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="kiln-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def write_parquet(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; the shuffle files of the job are deleted when it is done, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back (survives lost executors)."""
    path = f"{checkpoint_dir(df.sparkSession)}/kiln-{name}-{uuid.uuid4().hex}"
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the tables of ``written`` that ``df`` reads; nothing else may read them any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in sorted({file.rpartition("/")[0] for file in df.inputFiles()}):
        table = path(folder)
        if table.getName().startswith("kiln-"):
            table.getFileSystem(spark._jsc.hadoopConfiguration()).delete(table, True)
