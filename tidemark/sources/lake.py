"""The lake: declared reads, merges by key, atomic publication with manifests."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from tidemark.operators.dedup import keep_last
from tidemark.operators.sync import schema_signature
from tidemark.sources.files import as_type, content_digests, read_drifted, schema_groups
from tidemark.sources.scratch import scratch


def read_declared(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Files read by a declared schema: missing columns are null, others ignored, nothing is inferred.

    Types may differ from file to file: files that agree are read together, and each value is cast to the declared type, or
    null where it can't be.
    """
    wanted = _parse_datatype_string(ddl)
    sides = []
    for found in schema_groups(spark, [path] if isinstance(path, str) else list(path)):
        have = {f.name: f.dataType for f in found.schema.fields}
        sides.append(found.select(*[
            (as_type(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields]))
    return reduce(DataFrame.unionByName, sides)


def freshest(spark: SparkSession, paths: list[str], keys: list[str]) -> DataFrame:
    """Rows of all files; of one key the row of the newest file, and there the last, stays.

    Columns whose types differ from file to file take the type that holds all: the wider number or time, else text.
    """
    place = (F.col("_metadata.file_modification_time").alias("__time"), F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__index"))
    found = read_drifted(spark, paths, place)
    return keep_last(found, keys, F.col("__time"), F.col("__path"), F.col("__index")).drop("__time", "__path", "__index")


def merge_partitions(spark: SparkSession, table: str, new: DataFrame, keys: list[str], partitions: list[str]) -> None:
    """Merge rows into a partitioned table: only partitions that get rows are read and replaced.

    The merged rows go to a scratch folder first, as a table can't be overwritten while it is read.
    """
    old = spark.read.parquet(table)
    touched = new.select(*partitions).distinct()
    kept = old.join(F.broadcast(touched) if touched.limit(10_001).count() <= 10_000 else touched, partitions, "left_semi").withColumn("__wave", F.lit(0))
    merged = keep_last(kept.unionByName(new.withColumn("__wave", F.lit(1)), allowMissingColumns=True), [*partitions, *keys], F.col("__wave")).drop("__wave")
    at = scratch(spark, "merge")
    merged.write.parquet(at)
    spark.read.parquet(at).repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(table)


def publish(df: DataFrame, root: str, version: str, keys: list[str], builder: str, attestation: dict[str, str] | None = None) -> dict:
    """Write a version and then its manifest: readers that follow manifests see all of it or nothing."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/data/{version}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.parquet(path)
    told = content_digests(written).first()
    if written.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError("keys repeat; nothing is published")
    serial = time.time_ns()
    manifest = {"version": version, "path": path, "rows": told.n_rows, "content": told.digest, "schema": schema_signature(written), "keys": keys, "builder": builder, "built": serial, "attests": attestation or {}}
    spark.createDataFrame([(version, serial, json.dumps(manifest))], MANIFEST).coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/manifests")
    return manifest


MANIFEST = "version string, built long, manifest string"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """version, built, manifest of what was published and not withdrawn."""
    found = spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/manifests")
    gone = found.where("manifest = 'withdrawn'").select("version", "built")
    return found.where("manifest <> 'withdrawn'").join(gone, ["version", "built"], "left_anti")


def published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The data of the newest version (or of ``version``), of equal versions the last build, by manifest."""
    return spark.read.parquet(_newest(spark, root, version)["path"])


def _newest(spark: SparkSession, root: str, version: str | None = None) -> dict:
    from tidemark.operators.sync import semver

    found = manifests(spark, root)
    found = found.where(F.col("version") == version) if version else found
    best = found.orderBy(semver(F.col("version")).desc(), F.col("built").desc()).first()
    if best is None:
        raise FileNotFoundError("no such version is published")
    return json.loads(best["manifest"])


def roll_back(spark: SparkSession, root: str) -> dict:
    """Withdraw the newest publication: readers get the one before.  Nothing is deleted."""
    gone = _newest(spark, root)
    row = [(gone["version"], gone["built"], "withdrawn")]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/manifests")
    return gone


def attested(spark: SparkSession, root: str, sources: dict[str, str], version: str | None = None) -> bool:
    """Whether the newest publication says that it was made of just these sources (name -> path or digest) and still has the content it was published with."""
    manifest = _newest(spark, root, version)
    return manifest["attests"] == sources and content_digests(spark.read.parquet(manifest["path"])).first().digest == manifest["content"]


def write_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV files with headers; times in ISO form."""
    df.write.mode("overwrite").option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def markdown_report(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small result as a Markdown table; more than ``most`` rows are an error, for a report is read by people."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of over {most} rows")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)]) + "\n"


def json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


#: Names of types in a relational database.
_DDL = {"string": "TEXT", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE PRECISION", "float": "REAL", "boolean": "BOOLEAN", "date": "DATE",
        "timestamp": "TIMESTAMPTZ", "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA", "smallint": "SMALLINT"}


def table_ddl(df: DataFrame, table: str, keys: list[str]) -> str:
    """CREATE TABLE of a frame's schema, keys NOT NULL and primary; a type without a counterpart is an error."""
    quote = lambda c: '"' + c.replace('"', '""') + '"'
    lines = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind not in _DDL and not kind.startswith("decimal"):
            raise TypeError(f"{f.name} of type {kind} has no column type")
        lines.append(f"  {quote(f.name)} {_DDL.get(kind, kind.upper().replace('DECIMAL', 'NUMERIC'))}{' NOT NULL' if f.name in keys else ''}")
    return f"CREATE TABLE {table} (\n" + ",\n".join([*lines, f"  PRIMARY KEY ({', '.join(map(quote, keys))})"]) + "\n)"


def bounds_by_partition(df: DataFrame, partitions: list[str], ts: str) -> DataFrame:
    return df.groupBy(*partitions).agg(F.min(ts).alias("low"), F.max(ts).alias("high"), F.count(F.lit(1)).alias("n_rows"))


EXPORT_KEYS = ["exchange", "instrument_type", "symbol", "timeframe", "open_time"]


def combined_export(candles: list[DataFrame], open_interest: DataFrame | None = None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Candles of all sources between ``start`` and ``end`` (both included), by time, the first ``limit`` of them, with open interest.

    Columns that a source lacks are null.  Of one key the open interest that was ingested last counts; without any it is null.
    """
    if limit is not None and limit <= 0:
        raise ValueError("a limit must be positive")
    order = ["open_time", "exchange", "instrument_type", "symbol", "timeframe"]
    rows = candles[0]
    for c in candles[1:]:
        rows = rows.unionByName(c, allowMissingColumns=True)
    rows = rows.where(F.lit(True) if start is None else F.col("open_time") >= start).where(F.lit(True) if end is None else F.col("open_time") <= end)
    rows = rows if limit is None else rows.orderBy(*order).limit(limit)
    values = ["open_interest", "open_interest_value"]
    if open_interest is None:
        return rows.withColumns({v: F.lit(None).cast("double") for v in values}).orderBy(*order)
    last = keep_last(open_interest, EXPORT_KEYS, F.col("ingested_at") if "ingested_at" in open_interest.columns else F.lit(1))
    return rows.join(last.select(*EXPORT_KEYS, *values), EXPORT_KEYS, "left").select(*rows.columns, *values).orderBy(*order)
