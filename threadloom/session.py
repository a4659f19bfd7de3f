"""Session settings and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Epoch seconds and ISO strings are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts can be long; smaller batches bound what a Python worker holds.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Keeps "first N per group" cut down before the shuffle for large N too.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ensure_work_folder(spark: SparkSession) -> str:
    """The shared folder of the session; only a local session that names none gets a new one.

    For entry points, tests and benchmarks. Operators call ``work_dir``, which never makes one up.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="threadloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one in ``spark.checkpoint.dir``, which must be set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/threadloom/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a new folder of the shared one and read back: computed once."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
