"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves (tests, bench). A session handed to us by
# a cluster keeps its own settings; only unset keys are filled in.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "parlance", cpus: int | str = "*", shuffle_partitions: int | None = None,
                driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    n = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    builder = (builder.config("spark.sql.shuffle.partitions", str(n))
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``parlance`` importable in Python workers (UDFs and Arrow functions are
    pickled by module reference): zip the package once and ``addPyFile`` it, which is
    what ``--py-files`` does; Spark distributes the file to every executor."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="parlance-pkg-")
    archive = shutil.make_archive(os.path.join(out, "parlance"), "zip", os.path.dirname(pkg), "parlance")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder that driver and executors share. Only where it is
    unset (a plain local session) a folder below the warehouse is taken, which Spark itself
    treats as shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_parlance_checkpoints"
    return d


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared folder; its files go when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    fs, jpath = _hadoop(spark, path)
    fs.deleteOnExit(jpath)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    df.sparkSession.sparkContext.setCheckpointDir(ensure_checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)
