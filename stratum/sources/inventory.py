"""S7 stage listing and S8 cleanup of files that a load has committed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F


def stage_inventory(spark: SparkSession, path_glob: str) -> DataFrame:
    """File name, size and modification time; the content column is pruned, so no bytes are read."""
    return (spark.read.format("binaryFile").load(path_glob)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")))


def remove_files(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete exactly the listed (committed) files -- never files that arrived after the load."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).delete(path, False):
            n += 1
    return n
