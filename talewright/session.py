"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder every iterative job uses to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "talewright",
                  driver_memory: str = "8g") -> SparkSession:
    """Session for tests / bench on one machine. On a cluster, build your own
    session; nothing in the library creates one."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only in local mode (tests, benches), where driver and executors are one
    process, a scratch folder is made when the session names none. On a cluster
    the setting must point at shared storage so that landed tables survive the
    loss of an executor; without one this raises.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="talewright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    machine-local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def land_table(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: the lineage is cut, and later scans prune columns and push filters."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "landed", uuid.uuid4().hex)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_landed(*tables: DataFrame) -> None:
    """Delete what :func:`land_table` wrote for ``tables``, when nothing reads it any more."""
    for df in tables:
        spark = df.sparkSession
        top = os.path.join(ensure_checkpoint_dir(spark), "landed")
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if os.path.basename(os.path.dirname(folder)) == os.path.basename(top):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(top, os.path.basename(folder)))
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
