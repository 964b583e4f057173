"""What a folder of Parquet files says without its rows: files, partition values, schemas and bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN = ("path", "modificationTime", "length", "content")
#: Spark's name for files whose types differ.
_DRIFT = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def listed(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """path, modificationTime, length of each file, and the partition values of its folders.  No file is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root).drop("content")


def discovered(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """The partitions that exist under ``root``, from the names of folders alone; ``where`` prunes folders."""
    files = listed(spark, root)
    files = files if where is None else files.where(where)
    return files.select(*[c for c in files.columns if c not in _OWN]).distinct()


def fingerprints(files: DataFrame, by: list[str], contract: str) -> DataFrame:
    """``by``, fingerprint: SHA-256 of the contract and of path, size and time of all files of a partition.

    The files' own digests are summed, so a partition of very many files needs no list of them.
    """
    digest = F.sha2(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")), 256)
    return summed_digest(files.groupBy(*by), digest, "n_files", "fingerprint", contract)


def summed_digest(groups, digest: Column, count: str, name: str, seed: str = "") -> DataFrame:
    """The number of rows of each group and a digest that doesn't depend on their order: of the sums of the parts of their SHA-256 (hex) ``digest``."""
    lanes = [F.sum(F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    summed = groups.agg(F.count(F.lit(1)).alias(count), *[s.alias(f"__lane{i}") for i, s in enumerate(lanes)])
    parts = [F.lit(seed), F.col(count).cast("string"), *[F.coalesce(F.col(f"__lane{i}").cast("string"), F.lit("")) for i in range(4)]]
    return summed.withColumn(name, F.sha2(F.concat_ws("|", *parts), 256)).drop(*[f"__lane{i}" for i in range(4)])


def content_digests(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``by``, n_rows, digest of the rows (with names and types, in any order): one row, or one for each partition."""
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    return summed_digest(df.withColumn("__row", row).groupBy(*(by or [])), F.col("__row"), "n_rows", "digest", schema)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Of numbers or of times the wider one, else text."""
    if a == b:
        return a
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    for kinds in ((T.NumericType,), times):
        if isinstance(a, kinds) and isinstance(b, kinds):
            spark = SparkSession.getActiveSession()
            return spark.range(0).select(F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("x")).schema["x"].dataType
    return T.StringType()


def as_type(x: Column, have: T.DataType, want: T.DataType) -> Column:
    """``x`` cast, or null where it can't be; nested values become JSON where text is wanted."""
    if have == want:
        return x
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) and isinstance(want, T.StringType):
        return F.to_json(x)
    try:
        SparkSession.getActiveSession().range(0).select(F.lit(None).cast(have).try_cast(want))
    except AnalysisException:  # no value of the one type has a counterpart in the other
        return F.lit(None).cast(want)
    return x.try_cast(want)


def schema_groups(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Reads that cover all files of ``paths``, each of files whose columns agree in their types.

    Spark merges the schemas of a set of files in a job that reads footers in parallel.  A set that it can't merge is
    halved, in order of time, since drift comes with time; sets that turn out to agree are read together again.
    """
    def read(files: list[str], base: str | None = None) -> DataFrame:
        reader = spark.read.option("mergeSchema", "true")
        return (reader.option("basePath", base) if base else reader).parquet(*files)

    try:
        return [read(paths)]
    except Exception as error:
        if not _drifted(error):
            raise
    sets: dict[str | None, list[str]] = {}
    for root in paths:
        files = listed(spark, root)
        base = root if set(files.columns) - set(_OWN) else None  # folders carry values
        sets.setdefault(base, []).extend(r.path for r in files.orderBy("modificationTime", "path").select("path").collect())
    out = []
    for base, files in sets.items():
        groups: list[tuple[dict[str, T.DataType], list[str]]] = []
        pending = [files]
        while pending:
            some = pending.pop()
            try:
                types = {f.name: f.dataType for f in read(some, base).schema.fields}
            except Exception as error:
                if not _drifted(error) or len(some) == 1:
                    raise
                pending += [some[len(some) // 2 :], some[: len(some) // 2]]
                continue
            for known, group in groups:
                if all(known.get(n, kind) == kind for n, kind in types.items()):
                    known |= types
                    group += some
                    break
            else:
                groups.append((types, list(some)))
        out += [read(group, base) for _, group in groups]
    return out


def _drifted(error: Exception) -> bool:
    return any(name in str(error) for name in _DRIFT)


def read_drifted(spark: SparkSession, paths: list[str], more: tuple[Column, ...] = ()) -> DataFrame:
    """All files as one table: columns of any file, in the types that hold all; ``more``: metadata columns to go along."""
    groups = schema_groups(spark, paths)
    names: dict[str, T.DataType] = {}
    for g in groups:
        for f in g.schema.fields:
            names[f.name] = common_type(names.get(f.name, f.dataType), f.dataType)
    sides = [g.select(*[as_type(F.col(f"`{f.name}`"), f.dataType, names[f.name]).alias(f.name) for f in g.schema.fields], *more) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)


def footer_bounds(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """n_rows and the least and greatest value of each column, from footers alone: the aggregate is pushed into the scan.

    Numbers and dates have bounds there; times are read as the microseconds that they are stored as.  The frame belongs to a
    session of its own, in which Parquet is read by the source that can push aggregates down.  That finds columns by their place, so
    all files must have been written with one flat schema.  Times that were stored as INT96 have no bounds there: an error.
    """
    own = spark.newSession()
    for name, value in (("spark.sql.sources.useV1SourceList", ""), ("spark.sql.parquet.aggregatePushdown", "true"), ("spark.sql.session.timeZone", "UTC")):
        own.conf.set(name, value)
    schema = own.read.parquet(path).schema
    if any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in schema.fields):
        raise TypeError("columns are found in footers by their place, which nested ones shift")
    kinds = {f.name: f.dataType for f in schema.fields}
    times = {c for c in columns if isinstance(kinds[c], (T.TimestampType, T.TimestampNTZType))}
    stored = T.StructType([T.StructField(c, T.LongType() if c in times else kind) for c, kind in kinds.items()])
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    found = own.read.schema(stored).parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *ends)
    return found.select("n_rows", *[
        (F.timestamp_micros(f"{n}_{c}").cast(kinds[c]) if c in times else F.col(f"{n}_{c}")).alias(f"{n}_{c}") for c in columns for n in ("low", "high")])
