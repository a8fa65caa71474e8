"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "propensity", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the package is tested under.

    On a cluster the session comes from spark-submit; nothing here is needed there
    except UTC time and AQE, which are Spark settings like any other.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        # call sites of every column expression cost milliseconds each; errors still say what failed
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session may run without that setting; it gets a folder of its own,
    because driver and executors are then the same machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if getattr(shared_dir, "_local", None) is None:
        shared_dir._local = tempfile.mkdtemp(prefix="propensity-")
    spark.sparkContext.setCheckpointDir(os.path.join(shared_dir._local, "checkpoints"))
    return shared_dir._local


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses, under a folder of the application.

    That folder can be deleted when the application has ended and its results are copied.
    """
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where several jobs read the same rows (fits, fold loops): the lineage ends
    at a file that outlives a lost executor.
    """
    path = new_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
