"""Several artifacts published as one, and attested by their content.

Two phases: every artifact is written to a new folder and checked; then one record
names them all.  Readers follow records, so siblings change together or not at
all, whatever fails between.  A record carries content digests; attestation reads
the data again, so a file that was changed in place is found.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros
from tidemark.operators.sync import schema_signature, semver
from tidemark.sources import records
from tidemark.sources.files import content_digests


@dataclass(frozen=True)
class Artifact:
    name: str
    df: DataFrame
    version: str
    keys: list[str]
    sources: dict[str, str] = field(default_factory=dict)
    #: Columns that have one value in all rows, and which; and the column of time.
    lineage: dict[str, str] = field(default_factory=dict)
    ts: str | None = None


COMMIT = "serial long, state string, artifacts string"


def publish_together(spark: SparkSession, root: str, artifacts: list[Artifact], builder: str, check: Callable[[str, DataFrame], bool] | None = None) -> dict:
    """Publish all artifacts with one commit record, or none.

    Before the record is written every artifact must have keys that are unique and not null, must read back with the schema it was
    written with, and must pass ``check`` (name, data), if one is given.
    """
    names = [a.name for a in artifacts]
    if not artifacts or len(set(names)) != len(names):
        raise ValueError("a publication needs artifacts, each name once")
    root, serial = root.rstrip("/"), time.time_ns()
    entries = [_prepared(spark, f"{root}/data/{a.name}/{a.version}-{serial}-{uuid.uuid4().hex}", a, builder, check) for a in artifacts]
    entry = {"serial": serial, "artifacts": entries}
    records.append(spark, f"{root}/commits", COMMIT, [(serial, "committed", json.dumps(entries))])
    return entry


def _prepared(spark: SparkSession, path: str, a: Artifact, builder: str, check: Callable[[str, DataFrame], bool] | None) -> dict:
    a.df.write.parquet(path)
    written = spark.read.parquet(path)
    if schema_signature(written) != schema_signature(a.df):
        raise ValueError(f"{a.name} reads back with another schema; nothing is published")
    null = F.lit(False)
    for k in a.keys:
        null = null | F.col(f"`{k}`").isNull()
    if written.groupBy(*a.keys).agg(F.count(F.lit(1)).alias("n")).where(null | (F.col("n") > 1)).limit(1).count():
        raise ValueError(f"keys of {a.name} repeat or are null; nothing is published")
    if check and not check(a.name, written):
        raise ValueError(f"{a.name} doesn't pass its check; nothing is published")
    if _strangers(written, a.lineage):
        raise ValueError(f"{a.name} has rows of another lineage; nothing is published")
    told = content_digests(written).first()
    low, high = _bounds(written, a.ts)
    return {"name": a.name, "version": a.version, "path": path, "rows": told.n_rows, "digest": told.digest, "schema": schema_signature(written),
            "keys": a.keys, "builder": builder, "sources": a.sources, "lineage": a.lineage, "ts": a.ts, "low": low, "high": high}


def _strangers(df: DataFrame, lineage: dict[str, str]) -> bool:
    own = F.lit(True)
    for c, value in lineage.items():
        own = own & F.col(f"`{c}`").cast("string").eqNullSafe(F.lit(value))
    return bool(lineage) and not df.where(~own).isEmpty()


def _bounds(df: DataFrame, ts: str | None) -> tuple[int | None, int | None]:
    """The first and last time, in microseconds."""
    return tuple(df.agg(F.min(micros(F.col(ts))), F.max(micros(F.col(ts)))).first()) if ts else (None, None)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """serial, artifacts (JSON) of the commits that weren't withdrawn."""
    found = records.read(spark, f"{root.rstrip('/')}/commits", COMMIT)
    gone = found.where("state = 'withdrawn'").select("serial")
    return found.where("state = 'committed'").join(gone, "serial", "left_anti").select("serial", "artifacts")


ENTRY = ("array<struct<name: string, version: string, path: string, rows: long, digest: string, schema: string, keys: array<string>, builder: string,"
         " sources: map<string, string>, lineage: map<string, string>, ts: string, low: long, high: long>>")


def catalogue(spark: SparkSession, root: str) -> DataFrame:
    """serial and the entry of every artifact that is published."""
    return commits(spark, root).select("serial", F.explode(F.from_json("artifacts", ENTRY)).alias("a")).select("serial", "a.*")


def newest(spark: SparkSession, root: str, name: str, version: str | None = None):
    """The entry of the highest version of an artifact, of equal ones the last commit."""
    found = catalogue(spark, root).where(F.col("name") == name)
    found = found.where(F.col("version") == version) if version else found
    best = found.orderBy(semver(F.col("version")).desc(), F.col("serial").desc()).first()
    if best is None:
        raise FileNotFoundError(f"{name} isn't published")
    return best


def published_artifact(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    return spark.read.parquet(newest(spark, root, name, version).path)


def withdraw(spark: SparkSession, root: str, serial: int) -> None:
    """Withdraw a commit with all its siblings.  Nothing is deleted."""
    records.append(spark, f"{root.rstrip('/')}/commits", COMMIT, [(serial, "withdrawn", "[]")])


def attest(spark: SparkSession, root: str, serial: int | None = None) -> DataFrame:
    """name, version, status of each artifact of a commit (the last one by default): attested, modified or unreadable; the data is read whole."""
    last = commits(spark, root)
    last = last.where(F.col("serial") == serial) if serial is not None else last.orderBy(F.col("serial").desc()).limit(1)
    entries = [e for row in last.collect() for e in json.loads(row.artifacts)]
    if not entries:
        raise FileNotFoundError("no such commit is published")
    rows = []
    for e in entries:
        try:
            data = spark.read.parquet(e["path"])
            told = content_digests(data).first()
            same = (told.n_rows, told.digest, schema_signature(data)) == (e["rows"], e["digest"], e["schema"])
            rows.append((e["name"], e["version"], "attested" if same else "modified"))
        except Exception:  # a file that can't be read is a finding, not a failure of the audit
            rows.append((e["name"], e["version"], "unreadable"))
    return spark.createDataFrame(rows, "name string, version string, status string")


def certify_artifact(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """One row: name, version, n_rows, low, high, status, and the checks that failed, of a published artifact against its entry.

    The checks: content (digest), rows, schema, keys (unique, none null), lineage (no row of another), bounds of time.  ``certified`` needs all.
    """
    entry = newest(spark, root, name, version)
    data = spark.read.parquet(entry.path)
    told, (low, high) = content_digests(data).first(), _bounds(data, entry.ts)
    null = F.lit(False)
    for k in entry["keys"]:
        null = null | F.col(f"`{k}`").isNull()
    unsound = data.groupBy(*entry["keys"]).agg(F.count(F.lit(1)).alias("n")).where(null | (F.col("n") > 1))
    checks = {
        "content": told.digest == entry.digest, "rows": told.n_rows == entry.rows, "schema": schema_signature(data) == entry.schema, "keys": unsound.isEmpty(),
        "lineage": not _strangers(data, entry.lineage or {}), "bounds": (low, high) == (entry.low, entry.high),
    }
    failed = [c for c, passed in checks.items() if not passed]
    row = (entry.name, entry.version, told.n_rows, low, high, "failed" if failed else "certified", failed)
    found = spark.createDataFrame([row], "name string, version string, n_rows long, low long, high long, status string, failed array<string>")
    return found.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in ("low", "high")})
