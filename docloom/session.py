"""Session helpers: makes the package importable for Python workers wherever they run."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add this package to the files of the application once, so that executors need no PYTHONPATH of their own."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="docloom-"), "docloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    context.addPyFile(target)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the folder that spark.checkpoint.dir names, read back: what several steps read is made once, and nothing is kept in memory."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_sum(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` up to and with the row in the order of ``key`` (unique; null first). Rows are ranged into partitions, whose sums are
    added up in one row each; no task sees all rows."""
    ranged = written(rows.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = totals.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))
    own = F.sum(value).over(Window.partitionBy("_part").orderBy(key))
    return ranged.withColumn(name, own).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")
