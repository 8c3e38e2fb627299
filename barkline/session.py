"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "barkline", **conf: str) -> SparkSession:
    """A session with adaptive execution; anything given overrides it."""
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder(application: str) -> str:
    """A local application's own folder; the setting itself can't be changed while it runs."""
    return "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")


def durable(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of the cluster; survives the loss of executors.

    ``spark.checkpoint.dir`` names the folder. Only a local master gets a folder of its own. Unlike a checkpoint's
    rows, a table has a known size and columns that can be left out, so joins with it are planned by size.
    """
    spark = df.sparkSession
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        given = _own_folder(spark.sparkContext.applicationId)
    path = f"{given.rstrip('/')}/durable/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
