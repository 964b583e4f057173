"""Complete-state synchronisation: digests, deltas, certification, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _typed(df: DataFrame, name: str) -> Column:
    """A value as text that names its type, so that 1 and '1' differ; a number that isn't finite makes the job fail."""
    x, kind = F.col(f"`{name}`"), df.schema[name].dataType.simpleString()
    text = x.cast("string")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        own = F.concat(F.lit("int:"), text)
    elif kind == "boolean":
        own = F.when(x, "bool:1").otherwise("bool:0")
    elif kind in ("float", "double"):
        bad = F.isnan(x) | (F.abs(x) == float("inf"))
        own = F.concat(F.lit("float:"), F.when(bad, F.raise_error(F.lit(f"{name} isn't finite"))).otherwise(F.when(x == 0, 0.0).otherwise(x).cast("string")))
    elif kind in ("timestamp", "timestamp_ntz"):
        own = F.concat(F.lit("dt:"), F.unix_micros(x.cast("timestamp")).cast("string"))
    elif kind == "binary":
        own = F.concat(F.lit("bytes:"), F.lower(F.hex(x)))
    elif kind in ("date", "string") or kind.startswith("decimal"):
        own = F.concat(F.lit({"date": "date:", "string": "str:"}.get(kind, "decimal:")), text)
    else:
        own = F.concat(F.lit(f"{kind.split('<')[0]}:"), F.to_json(x))
    return F.concat(F.lit(f"column:{name}="), F.when(x.isNull(), "null").otherwise(own), F.lit("\x1f"))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of a row's names, types and values, in order."""
    return F.sha2(F.concat(*[_typed(df, c) for c in columns]), 256)


def delta(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """key, action: insert, update, delete or unchanged.  Only keys and digests are shuffled; a key that repeats on a side is an error."""

    def digests(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(*keys, row_digest(df, columns).alias("d")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d"))
        return rows.select(*keys, F.when(F.col("n") > 1, F.raise_error(F.lit("a key repeats"))).otherwise(F.col("d")).alias(name))

    action = (
        F.when(F.col("__t").isNull(), "insert").when(F.col("__s").isNull(), "delete")
        .when(F.col("__s") == F.col("__t"), "unchanged").otherwise("update")
    )
    return digests(source, "__s").join(digests(target, "__t"), keys, "full_outer").select(*keys, action.alias("action"))


def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """The distinct rows of a that b lacks, nulls being equal.

    Each side is made distinct before they meet: few values in many rows shuffle as a row for each value and task, not as rows of a hot key.
    """
    return a.distinct().subtract(b.distinct())


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """The distinct rows that a and b share, nulls being equal; each side is made distinct first, as in ``only_in``."""
    return a.distinct().intersect(b.distinct())


def tail_after(new: DataFrame, known: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The rows of each series that are later than what is known of it; all rows of an unknown series."""
    last = known.groupBy(*keys).agg(F.max(ts).alias("__last"))  # one row for each series
    return new.join(last, keys, "left").where(F.col("__last").isNull() | (F.col(ts) > F.col("__last"))).drop("__last")


def freshness(df: DataFrame, keys: list[str], ts: str, now: Column, limit_seconds: int) -> DataFrame:
    """Last row of each series, its age at ``now``, and whether that is within the limit."""
    age = ((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_seen").cast("timestamp"))) / 1_000_000).cast("long")
    return df.groupBy(*keys).agg(F.max(ts).alias("last_seen")).withColumn("age_seconds", age).withColumn(
        "status", F.when(F.col("age_seconds") <= limit_seconds, "FRESH").otherwise("STALE"))


def in_month(df: DataFrame, ts: str, month: Column) -> DataFrame:
    """The rows of one month: what a rebuild with earlier months as context gives out."""
    first = F.date_trunc("month", month).cast("timestamp_ntz")
    return df.where((F.col(ts) >= first) & (F.col(ts) < F.add_months(first.cast("date"), 1).cast("timestamp_ntz")))


def certify(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Row count, distinct keys, duplicates, null keys and bounds of a snapshot."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.min(ts).alias("lo"), F.max(ts).alias("hi")).agg(
        F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("c") > 1).alias("duplicate_keys"),
        F.count_if(null_key).alias("null_keys"), F.min("lo").alias("first_seen"), F.max("hi").alias("last_seen"),
    )


def semver(version: Column) -> Column:
    """major, minor, patch as a comparable struct; nulls for malformed ones."""
    part = lambda i: F.nullif(F.regexp_extract(version, r"^v?(\d+)\.(\d+)\.(\d+)$", i), F.lit("")).try_cast("long")
    return F.struct(*[part(i).alias(n) for i, n in ((1, "major"), (2, "minor"), (3, "patch"))])


def latest_version(artifacts: DataFrame, keys: list[str], version: str, built: str) -> DataFrame:
    """The artifact of each key with the highest version, then the latest build."""
    return artifacts.groupBy(*keys).agg(
        F.max_by(version, F.struct(semver(F.col(version)), built)).alias(version),
        F.max(F.struct(semver(F.col(version)).alias("v"), F.col(built).alias("b")))["b"].alias(built),
    )


def retained(artifacts: DataFrame, keys: list[str], version: str, built: str, keep: int) -> DataFrame:
    """The newest ``keep`` artifacts of each key: a retention rule."""
    w = Window.partitionBy(*keys).orderBy(semver(F.col(version)).desc(), F.col(built).desc())
    return artifacts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def schema_signature(df: DataFrame) -> str:
    """SHA-256 of names and types in order."""
    import hashlib

    return hashlib.sha256(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields).encode()).hexdigest()


def version_bump(before: Column, after: Column) -> Column:
    """'major', 'minor', 'patch' or 'none' from two contracts; null parts, or no contract before, make it major.

    A contract is a struct of join_policy, sources and columns (arrays, columns in order) and data_hash.
    """
    parts = ("join_policy", "sources", "columns", "data_hash")
    lacking = before.isNull() | after.isNull()
    for p in parts:
        lacking = lacking | before[p].isNull() | after[p].isNull()
    lost = lambda p: F.size(F.array_except(before[p], after[p])) > 0
    new = lambda p: F.size(F.array_except(after[p], before[p])) > 0
    return (
        F.when(lacking | (before["join_policy"] != after["join_policy"]) | lost("sources"), "major").when(new("sources"), "minor")
        .when(lost("columns"), "major").when(new("columns"), "minor").when(before["columns"] != after["columns"], "major")
        .when(before["data_hash"] != after["data_hash"], "patch").otherwise("none")
    )


def bumped(version: Column, bump: Column) -> Column:
    """The version after a bump; 1.0.0 where there was none."""
    v = semver(version)
    text = lambda *x: F.concat_ws(".", *[c.cast("string") if isinstance(c, Column) else F.lit(str(c)) for c in x])
    next_ = F.when(bump == "major", text(v["major"] + 1, 0, 0)).when(bump == "minor", text(v["major"], v["minor"] + 1, 0)).when(
        bump == "patch", text(v["major"], v["minor"], v["patch"] + 1)).otherwise(version)
    return F.when(v["patch"].isNull(), "1.0.0").otherwise(next_)


def artifact_status(wanted: DataFrame, artifacts: DataFrame, manifests: DataFrame, keys: list[str], path: str, built: str) -> DataFrame:
    """For each wanted key its newest artifact and a status: missing, blocked (it has no manifest) or current."""
    newest = artifacts.groupBy(*keys).agg(F.max(F.struct(built, path)).alias("__newest"))
    told = manifests.select(F.col(path)).distinct().withColumn("__told", F.lit(True))
    found = wanted.select(*keys).distinct().join(newest, keys, "left").select(*keys, F.col(f"__newest.{path}").alias(path), F.col(f"__newest.{built}").alias(built))
    status = F.when(F.col(path).isNull(), "missing").when(F.col("__told"), "current").otherwise("blocked")
    return found.join(told, path, "left").select(*keys, path, built, status.alias("status"))


def dataset_states(found: DataFrame, contracts: DataFrame, legacy: dict[str, str]) -> DataFrame:
    """layer, dataset, state of raw datasets that are there, and of all contracted ones.

    found: layer, dataset.  contracts: layer, dataset; of the layer ``bronze`` they name what has a target.
    Raw: mapped or unmapped.  Others: materialized, legacy_artifact (only its older name, by ``legacy``, is there) or not_materialized.
    """
    there = found.select("layer", "dataset").distinct()
    known = contracts.select("layer", "dataset").distinct().withColumn("__known", F.lit(True))
    raw = there.where("layer = 'bronze'").join(known, ["layer", "dataset"], "left").select(
        "layer", "dataset", F.when(F.col("__known"), "mapped").otherwise("unmapped").alias("state"))
    older = F.lit(None).cast("string")
    for name, old in legacy.items():
        older = F.when(F.col("dataset") == name, old).otherwise(older)
    own = there.withColumn("__own", F.lit(True))
    old = there.select("layer", F.col("dataset").alias("__older"), F.lit(True).alias("__old"))
    made = known.where("layer <> 'bronze'").withColumn("__older", older).join(own, ["layer", "dataset"], "left").join(old, ["layer", "__older"], "left")
    state = F.when(F.col("__own"), "materialized").when(F.col("__old"), "legacy_artifact").otherwise("not_materialized")
    return raw.unionByName(made.select("layer", "dataset", state.alias("state")))
