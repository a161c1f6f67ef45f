"""Keeping the result of a step."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines share.

    Only a local session without that setting gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="toolquarry-")
    return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"


def stored(df: DataFrame, work_path: str, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``work_path`` and go on from those files.

    ``work_path`` is a folder that all machines share. Every call writes a new folder in it.
    """
    path = f"{work_path.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
