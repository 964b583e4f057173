"""Coverage, missing values, availability, inventories, reconciliation, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros, ratio
from tidemark.sources.scratch import scratch


def _long(df: DataFrame, columns: list[str], measures: dict[str, str]) -> DataFrame:
    """One row per column from one wide aggregate row named ``column__measure``."""
    entries = [
        F.struct(F.lit(c).alias("variable"), *[F.col(f"{c}__{m}").cast(kind).alias(m) for m, kind in measures.items()]) for c in columns
    ]
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def descriptive_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, mean, std, min, max: one pass over the data."""
    makers = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}__{m}") for c in columns for m, f in makers.items()])
    return _long(wide, columns, dict.fromkeys(makers, "double"))


def feature_profile(df: DataFrame, columns: list[str], ts: str) -> DataFrame:
    """Nulls, moments and the span of non-null values of each column, in one pass."""
    out: list[Column] = []
    for c in columns:
        x = F.col(c).cast("double")
        seen = F.when(x.isNotNull(), F.col(ts))
        out += [
            F.count_if(x.isNull()).alias(f"{c}__null_count"), F.count(x).alias(f"{c}__value_count"), F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"), F.var_samp(x).alias(f"{c}__variance"), F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"), F.min(seen).alias(f"{c}__first_seen"), F.max(seen).alias(f"{c}__last_seen"),
        ]
    kinds = {"null_count": "long", "value_count": "long"} | dict.fromkeys(("mean", "std", "variance", "min", "max"), "double")
    return _long(df.agg(*out), columns, kinds | dict.fromkeys(("first_seen", "last_seen"), "timestamp_ntz"))


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, missing, total_rows."""
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__missing") for c in columns],
        *[F.count(F.lit(1)).alias(f"{c}__total_rows") for c in columns],
    )
    return _long(wide, columns, {"missing": "long", "total_rows": "long"})


def span_coverage(df: DataFrame, keys: list[str], ts: str, seconds: int = 60) -> DataFrame:
    """Steps expected between the first and the last row, and how many are there."""
    step = seconds * 1_000_000
    found = df.groupBy(*keys).agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"),
        F.count_distinct(F.floor(micros(F.col(ts)) / step)).alias("observed"),
    )
    expected = (F.floor(micros(F.col("last_seen")) / step) - F.floor(micros(F.col("first_seen")) / step) + 1).cast("long")
    return found.withColumn("expected", expected).withColumn("missing", F.col("expected") - F.col("observed")).withColumn(
        "coverage_ratio", ratio(F.col("observed").cast("double"), F.col("expected"))
    )


def source_availability(grid: DataFrame, sources: dict[str, DataFrame], keys: list[str], ts: str) -> DataFrame:
    """For each source: minutes of the grid that it covers, their share, minutes from its last row to the grid's end."""
    total = grid.agg(F.count(F.lit(1)).alias("grid_rows"), F.max(ts).alias("grid_end"))
    parts = []
    for name, df in sources.items():
        covered = grid.join(df.select(*keys, ts).distinct(), [*keys, ts], "left_semi")
        own = covered.agg(F.count(F.lit(1)).alias("covered"), F.max(ts).alias("last_seen"))
        parts.append(own.select(F.lit(name).alias("source"), "*"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # One row joins one row per source.
    return rows.join(F.broadcast(total), F.lit(True)).select(
        "source", "covered", (F.col("covered") / F.col("grid_rows")).alias("coverage_ratio"),
        ((micros(F.col("grid_end")) - micros(F.col("last_seen"))) / 60_000_000).cast("long").alias("minutes_behind"),
    )


def day_inventory(df: DataFrame, series: list[str], ts: str) -> DataFrame:
    """First and last day, observed, expected and missing days of each series."""
    day = F.to_date(ts)
    found = df.groupBy(*series).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("observed_days")
    )
    expected = (F.datediff("last_day", "first_day") + 1).cast("long")
    return found.withColumn("expected_days", expected).withColumn("missing_days", F.col("expected_days") - F.col("observed_days"))


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Counts of keys only in a, only in b, in both, and of those whose values differ by more than ``tolerance``."""
    x = a.select(*keys, F.col(value).alias("__a"), F.lit(True).alias("__in_a"))
    y = b.select(*keys, F.col(value).alias("__b"), F.lit(True).alias("__in_b"))
    both = F.col("__in_a") & F.col("__in_b")
    return x.join(y, keys, "full_outer").agg(
        F.count_if(F.col("__in_b").isNull()).alias("only_a"), F.count_if(F.col("__in_a").isNull()).alias("only_b"),
        F.count_if(both).alias("overlap"), F.count_if(both & (F.abs(F.col("__a") - F.col("__b")) > tolerance)).alias("mismatches"),
    )


def even_sample(df: DataFrame, keys: list[str], order: str, most: int) -> DataFrame:
    """Rows at even steps, at most ``most`` of each key: a sampling operator for plots.

    Rows are dealt out by ranges of (key, order) and written, so that a key fills many tasks; counts of ranges number them.
    """
    spark = df.sparkSession
    at = scratch(spark, "even-sample")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *keys, order).withColumn("__part", F.spark_partition_id()).write.parquet(at)
    rows = spark.read.parquet(at)
    place = F.struct(*keys, "__part")
    counts = rows.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys)
    base = counts.select(
        place.alias("__place"), F.sum("c").over(w).alias("__all"),
        F.coalesce(F.sum("c").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    own = rows.withColumn("__i", F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(order)) - 1).withColumn("__place", place)
    numbered = own.join(base, "__place").withColumn("__n", F.col("__base") + F.col("__i"))
    step = F.greatest(F.lit(1), F.ceil(F.col("__all") / most))
    return numbered.where(F.col("__n") % step == 0).select(*df.columns)
