"""Sessions for tests and benchmarks."""

import os

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import surveyloom


def ship(spark: SparkSession) -> SparkSession:
    """Python tasks of this driver get the package with their code, so executors need no installed copy."""
    cloudpickle.register_pickle_by_value(surveyloom)
    return spark


def local_session(cpus: int | None = None, name: str = "surveyloom") -> SparkSession:
    cpus = cpus or min(8, os.cpu_count() or 1)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
