"""Session settings the library relies on."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "airlattice", master: str | None = None, **conf) -> SparkSession:
    """A session with the UTC clock and adaptive execution on.

    Shuffle partitions are left to the cluster: adaptive execution coalesces small
    ones and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive times are UTC everywhere in this library."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    It is named in ``spark.checkpoint.dir`` or by ``SparkContext.setCheckpointDir``. There is
    no default: a folder of one machine would be wrong on a cluster.
    """
    current = spark.sparkContext.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or current
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if current is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a frame that ``stored`` returned, once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("stored-"):
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For a frame that several later passes read: its plan runs once, the passes read only
    the columns they need, and a lost executor replays a scan instead of the plan.
    """
    path = f"{use_checkpoint_dir(df.sparkSession)}/stored-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
