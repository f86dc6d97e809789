"""Spark session of the tests."""

import os
import sys
import tempfile

from pyspark.sql import SparkSession

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return spark
