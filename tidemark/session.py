"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

#: Shuffle files go when their query ends, not when the driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "tidemark", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE, ROCKSDB_PROVIDER)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, from ``spark.checkpoint.dir``.

    Only a session on one machine may do without that setting; it gets a temporary
    folder. On a cluster such a folder would not be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(configured)
        return configured
    current = context._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder for one table or one stream's state."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later passes read only the columns they need, and a lost executor cannot force
    a re-run of what came before. Its shuffle files go once it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "table")
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
