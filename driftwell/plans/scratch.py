"""A shared folder for what a query writes on the way."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below /tmp, which only a local master may use."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        top = f"/tmp/checkpoints/{os.getpid()}"
    return f"{top.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
