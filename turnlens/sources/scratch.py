"""Tables written between the stages of a long job, in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names; one of our own only where none is named and all workers run on this machine."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} names no folder; executors on other machines need a shared one")
        named = "file://" + tempfile.mkdtemp(prefix="turnlens-")
        spark.conf.set(_SETTING, named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a
    recomputation.  The files go when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before
        pass
