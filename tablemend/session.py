"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str, cpus: int | str = "*", **conf: str) -> SparkSession:
    """Local session used by the tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_bases: dict[str, str] = {}


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    A local folder is made up only for a local master that names none: other
    executors could not read it.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    if context.applicationId not in _local_bases:
        _local_bases[context.applicationId] = tempfile.mkdtemp(prefix="tablemend-")
    return _local_bases[context.applicationId]


def _scratch_folder(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{checkpoint_base(spark)}/tablemend/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{_scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name in the store it names."""
    folder, store = _store(spark, path)
    return store.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if there is one."""
    folder, store = _store(spark, path)
    store.delete(folder, True)


def release_scratch(spark: SparkSession) -> None:
    """Remove all intermediate files of this application; frames that read them are of no use afterwards."""
    remove(spark, _scratch_folder(spark))


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where two branches of a plan must see the very same rows; the written
    files survive the loss of executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
