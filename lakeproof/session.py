"""Session defaults and the shared folder used to cut lineage."""
from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

# What a Spark call may raise: analysis and other known errors, and failed jobs as such.
SPARK_ERRORS = (PySparkException, Py4JError)

# Defaults for a session this library builds itself.  A session handed in by the
# caller is used as it is.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int = 8, name: str = "lakeproof", memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(cpus)))
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakeproof-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor cannot lose it."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
