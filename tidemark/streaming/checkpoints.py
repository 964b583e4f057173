"""Checkpoints that belong to one plan: state of another plan is refused, or left aside."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import records

PLAN = "fingerprint string, folder string"


def plan_fingerprint(df: DataFrame, options: dict[str, str]) -> str:
    """SHA-256 of the analysed plan, without the numbers that every analysis gives anew, of the schema and of the options."""
    plan = re.sub(r"#\d+L?|@[0-9a-f]+|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "", df._jdf.queryExecution().analyzed().toString())
    told = {"plan": plan, "schema": df.schema.json(), "options": {k: str(v) for k, v in options.items()}}
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()


def bound_checkpoint(spark: SparkSession, root: str, df: DataFrame, options: dict[str, str], anew: bool = False) -> str:
    """The folder under ``root`` for the state of this plan and these options.

    Where ``root`` has state of another plan only, that is an error, unless ``anew`` says to start from the beginning beside it; a
    plan that comes back finds its own state again.
    """
    root, own = root.rstrip("/"), plan_fingerprint(df, options)
    known = {r.fingerprint: r.folder for r in records.read(spark, f"{root}/plans", PLAN).collect()}  # a row a plan
    if own in known:
        return f"{root}/{known[own]}"
    if known and not anew:
        raise ValueError(f"the checkpoint at {root} is of another plan")
    records.append(spark, f"{root}/plans", PLAN, [(own, own[:16])])
    return f"{root}/{own[:16]}"
