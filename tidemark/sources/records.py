"""Records beside data: small JSON tables that are only ever appended to, one file a record set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Times to the microsecond; the default would cut them to milliseconds.
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def append(spark: SparkSession, path: str, ddl: str, rows: list[tuple] | DataFrame) -> None:
    """Append records as one file, which readers see whole or not at all."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, ddl)
    df.coalesce(1).write.mode("append").options(**_TIMES).json(path)


def read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """All records; none where nothing has been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).options(**_TIMES).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
