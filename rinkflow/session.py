"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, app_name="rinkflow"):
    """A local session for tests and benchmarks.

    A cluster session comes from spark-submit; the only settings the library
    counts on there are Spark's defaults: adaptive execution with partition
    coalescing and skew-join splitting.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # HotSpot never compiles a method beyond this size; smaller ones it does.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Python call sites in error texts cost a call per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def scratch_folder(spark):
    """A new sub-folder of the folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent a session of one process (``local`` or
    ``local[...]``) gets a temporary folder of its own; any other session must
    name a folder that all executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="rinkflow-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/rinkflow-{uuid.uuid4().hex}"


def materialize(df, partition_by=()):
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and several consumers share one evaluation.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
