"""Drifted files, publication of siblings, builds by fingerprint, late data, reconciliation and ledgers, over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.windows import over_rows, rolling
from tidemark.operators import sync as S
from tidemark.plans import incremental, windows_ledger
from tidemark.plans.reconcile import reconcile
from tidemark.plans.registry import query
from tidemark.sources import lake, publication
from tidemark.sources.files import content_digests
from tidemark.sources.scratch import scratch
from tidemark.sources.tables import TICKS_SQL
from tidemark.streaming import bars
from tidemark.streaming.late import follow_late


def _drifted_orders(t) -> str:
    """One folder with files of three schemas: numbers, text, and a column that is missing."""
    at, status = scratch(t.spark, "drift"), F.col("o_orderstatus")
    slim = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    kinds = {"F": slim.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"),
             "O": slim.select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
                              F.round(F.col("o_totalprice") * 100).cast("long").alias("o_totalprice"), "o_orderstatus"),
             "P": slim.select("o_orderkey", "o_orderstatus")}
    for kind, df in kinds.items():
        own = status == kind if kind != "P" else ~status.isin("F", "O")
        df.where(own).drop("o_orderstatus").write.mode("append").parquet(at)
    return at


@query("drifted_types", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_custkey END AS o_custkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN round(o_totalprice * 100) END AS o_totalprice, NULL::VARCHAR AS extra FROM orders", "o_totalprice", places=0)
def drifted_types(t):
    """A declared schema over files whose types differ: each value is cast, or null where it can't be."""
    return lake.read_declared(t.spark, _drifted_orders(t), "o_orderkey bigint, o_custkey bigint, o_totalprice double, extra string")


@query("drifted_freshest", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_custkey::VARCHAR END AS o_custkey FROM orders")
def drifted_freshest(t):
    """The newest rows of such files without a declared schema: columns take the type that holds all."""
    return lake.freshest(t.spark, [_drifted_orders(t)], ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("published_siblings", """SELECT 'day' AS artifact, count(*) AS n_rows, 'attested' AS status FROM (SELECT DISTINCT date_trunc('day', o_orderdate) FROM orders)
  UNION ALL SELECT 'month', count(*), 'attested' FROM (SELECT DISTINCT date_trunc('month', o_orderdate) FROM orders)""")
def published_siblings(t):
    """Daily and monthly totals published as one; a second publication fails in one of them, so readers keep the first, whose content is attested."""
    root = scratch(t.spark, "siblings")

    def totals(unit: str, more: float):
        at = F.date_trunc(unit, "o_orderdate").cast("timestamp_ntz").alias("at")
        return t.orders.groupBy(at).agg(F.count(F.lit(1)).alias("n"), (F.max("o_totalprice") + more).alias("high"))

    made = lambda more: [publication.Artifact(u, totals(u, more), f"1.{int(more)}.0", ["at"]) for u in ("day", "month")]
    publication.publish_together(t.spark, root, made(0.0), "totals")
    try:
        publication.publish_together(t.spark, root, made(1.0), "totals", check=lambda name, df: name != "month")
    except ValueError:
        pass
    told = publication.attest(t.spark, root)
    rows = [content_digests(publication.published_artifact(t.spark, root, u)).select(F.lit(u).alias("artifact"), "n_rows") for u in ("day", "month")]
    return rows[0].unionByName(rows[1]).join(told.select(F.col("name").alias("artifact"), "status"), "artifact")


def _trailing(df):
    """Orders and their prices in cents over 30 days, by day and priority."""
    day = F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day")
    daily = df.groupBy("o_orderpriority", day).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    out = rolling(daily, ["o_orderpriority"], "day", {"__n": F.col("n"), "__cents": F.col("cents")}, {"30d": 30 * 86_400}, moments=False)
    return out.select("o_orderpriority", "day", F.col("__n_30d.total").cast("long").alias("n"), F.col("__cents_30d.total").cast("long").alias("cents"))


@query("late_data_rebuild", """WITH o AS (SELECT o_orderpriority, date_trunc('day', o_orderdate)::TIMESTAMP AS day, CASE WHEN year(o_orderdate) = 1994 AND o_orderkey % 10 = 4 THEN o_totalprice + 1 ELSE o_totalprice END AS x FROM orders),
  d AS (SELECT o_orderpriority, day, count(*) AS n, sum(round(x * 100)) AS cents FROM o GROUP BY 1, 2)
  SELECT o_orderpriority, day, CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(cents) OVER w AS BIGINT) AS cents FROM d
  WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def late_data_rebuild(t):
    """Trailing features by month: late and corrected rows of one year are merged, and only the months that they reach are built again."""
    at = {n: scratch(t.spark, f"late-{n}") for n in ("in", "table", "state", "out")}
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice").withColumn("seen", F.lit(1))
    late = (F.year("o_orderdate") == 1994) & (F.col("o_orderkey") % 10).isin(3, 4)
    first = rows.where(~late | (F.col("o_orderkey") % 10 == 4))
    second = rows.where(late).withColumns({"o_totalprice": F.when(F.col("o_orderkey") % 10 == 4, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")), "seen": F.lit(2)})
    for wave in (first, second):
        wave.write.mode("append").parquet(at["in"])
        follow_late(t.spark, at["in"], at["table"], at["state"], ["o_orderkey", "o_orderdate"], "o_orderdate", ["seen"])
        incremental.build_months(t.spark, at["table"], at["out"], _trailing, "day", "trailing-1", 30)
    return incremental.built(t.spark, at["out"])


@query("reconciled_years", "SELECT year(o_orderdate)::VARCHAR AS year, CASE WHEN year(o_orderdate) = 1994 THEN 'reloaded' ELSE 'kept' END AS action, count(*) AS n_rows, year(o_orderdate) = 1994 AS changed, 'PASS' AS status FROM orders GROUP BY 1, 2, 4")
def reconciled_years(t):
    """A table by years that lacks rows of one: that year is reloaded, all others are shown to have stayed, and the audit is run again."""
    at, backup = scratch(t.spark, "reconciled"), scratch(t.spark, "backup")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    rows.where((F.col("year") != 1994) | (F.col("o_orderkey") % 3 != 0)).repartition("year").write.partitionBy("year").parquet(at)

    def incomplete():
        have = t.spark.read.parquet(at).groupBy("year").agg(F.count(F.lit(1)).alias("have"))
        wanted = rows.groupBy("year").agg(F.count(F.lit(1)).alias("wanted"))
        return [str(r.year) for r in wanted.join(have, "year", "left").where(~F.col("have").eqNullSafe(F.col("wanted"))).collect()]  # a row a year

    report = reconcile(t.spark, at, "year", incomplete(), lambda years: rows.where(F.col("year").cast("string").isin(years)), backup, {"complete": lambda: not incomplete()})
    return report.partitions.withColumn("status", F.lit(report.status))


WINDOW_SQL = f"WITH {TICKS_SQL}, w AS (SELECT symbol, date_trunc('hour', trade_time)::TIMESTAMP AS window_start, count(*) AS n, sum(quantity) AS total FROM ticks GROUP BY 1, 2)"


@query("windows_that_fail_apart", f"{WINDOW_SQL} SELECT symbol, window_start, n, total, CASE WHEN hour(window_start) = 7 THEN 2 ELSE 1 END AS attempt FROM w", "total")
def windows_that_fail_apart(t):
    """Hours of ticks worked off by window: those of one hour of the day fail at first, and are the only ones that the second run takes."""
    ledger, out, keys = scratch(t.spark, "windows-ledger"), scratch(t.spark, "windows-out"), ["symbol"]
    hour = F.date_trunc("hour", "trade_time").cast("timestamp_ntz").alias("window_start")
    rows = t.ticks().select("symbol", hour, "quantity")
    windows = rows.select("symbol", "window_start").distinct().withColumn("window_end", (F.col("window_start") + F.expr("INTERVAL 1 HOUR") - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz"))

    def work(window, own):
        import pandas as pd

        if window["window_start"].hour == 7 and window["attempt"] == 1:
            raise ConnectionError("the provider is closed")
        return pd.DataFrame({"n": [len(own)], "total": [float(own["quantity"].sum())]})

    for _ in range(2):
        windows_ledger.run_windows(t.spark, windows, rows, work, "n long, total double", ledger, out, keys)
    made = windows_ledger.results(t.spark, ledger, out, windows, keys)
    last = windows_ledger.attempts(t.spark, ledger, windows, keys).where("status = 'done'").select("symbol", "window_start", "attempt")
    return made.join(last, ["symbol", "window_start"])


@query("certified_snapshot", "SELECT o_orderstatus AS name, '1.0.0' AS version, count(*) AS n_rows, min(o_orderdate)::TIMESTAMP AS low, max(o_orderdate)::TIMESTAMP AS high, 'certified' AS status, 0 AS n_failed FROM orders GROUP BY 1")
def certified_snapshot(t):
    """Orders of each status published together, then certified: content, rows, schema, keys, lineage (one status) and bounds of time."""
    root = scratch(t.spark, "certified")
    names = [r[0] for r in t.orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]  # a handful
    made = [publication.Artifact(n, t.orders.where(F.col("o_orderstatus") == n), "1.0.0", ["o_orderkey"], lineage={"o_orderstatus": n}, ts="o_orderdate") for n in names]
    publication.publish_together(t.spark, root, made, "orders")
    found = reduce(DataFrame.unionByName, [publication.certify_artifact(t.spark, root, n) for n in names])
    return found.withColumn("n_failed", F.size("failed")).drop("failed")


@query("csv_and_json_sinks", "SELECT o_orderkey, o_orderdate::TIMESTAMP AS o_orderdate, o_orderpriority, o_totalprice FROM orders", "o_totalprice")
def csv_and_json_sinks(t):
    """Orders written as CSV and as JSON and read back: both give the same rows."""
    csv, json = scratch(t.spark, "csv"), scratch(t.spark, "json")
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    lake.write_csv(rows, csv)
    lake.json_report(rows, json)
    ddl = "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double"
    a = t.spark.read.schema(ddl).option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(csv)
    return a.intersectAll(t.spark.read.schema(ddl).json(json))


CONTRACT_SQL = """c AS (SELECT p_partkey, p_size, p_brand, [p_brand, 'z' || p_size % 3] AS sources, CASE WHEN p_size % 7 = 0 THEN ['b', 'a'] WHEN p_size % 7 = 1 THEN ['a'] WHEN p_size % 7 = 2 THEN ['a', 'b', 'c'] ELSE ['a', 'b'] END AS columns,
    CASE WHEN p_size % 11 = 0 THEN 'inner' ELSE 'full_outer_coalesce' END AS policy, (p_size // 2)::VARCHAR AS hash FROM part),
  v AS (SELECT *, lag(p_partkey) OVER w AS before, lag(sources) OVER w AS s, lag(columns) OVER w AS k, lag(policy) OVER w AS j, lag(hash) OVER w AS h FROM c WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey))"""


@query("version_bumps", f"""WITH {CONTRACT_SQL}
  SELECT p_partkey, CASE WHEN before IS NULL OR policy <> j OR NOT list_has_all(sources, s) THEN 'major' WHEN NOT list_has_all(s, sources) THEN 'minor' WHEN NOT list_has_all(columns, k) THEN 'major'
    WHEN NOT list_has_all(k, columns) THEN 'minor' WHEN columns <> k THEN 'major' WHEN hash <> h THEN 'patch' ELSE 'none' END AS bump FROM v""")
def version_bumps(t):
    """The bump that each contract of a series asks for, against the contract before it."""
    size, text = F.col("p_size"), lambda *x: F.array(*[F.lit(c) for c in x])
    columns = F.when(size % 7 == 0, text("b", "a")).when(size % 7 == 1, text("a")).when(size % 7 == 2, text("a", "b", "c")).otherwise(text("a", "b"))
    contract = F.struct(
        F.when(size % 11 == 0, "inner").otherwise("full_outer_coalesce").alias("join_policy"), F.array("p_brand", F.concat(F.lit("z"), (size % 3).cast("string"))).alias("sources"),
        columns.alias("columns"), F.floor(size / 2).cast("string").alias("data_hash"))
    rows = t.part.select("p_brand", "p_partkey", contract.alias("after"), F.timestamp_seconds("p_partkey").alias("at"))
    out = over_rows(rows, ["p_brand"], "at", lambda w: {"before": F.lag("after").over(w)}, back=1)
    return out.select("p_partkey", S.version_bump(F.col("before"), F.col("after")).alias("bump"))


@query("late_bars", """SELECT event_type, date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1, count(*) AS n, max(value) AS high, min(value) AS low, sum(value) AS total, bool_or(event_id % 10 = 3 AND date_trunc('minute', ts) + INTERVAL 1 MINUTE
    <= (SELECT max(ts) FROM events WHERE event_id % 10 <> 3) - INTERVAL 1 DAY) AS revised FROM events GROUP BY 1, 2""", "high low total")
def late_bars(t):
    """Bars of a stream of which a tenth comes late, in a micro-batch of its own: nothing is lost, and what changed closed minutes is marked."""
    at, out, state = (scratch(t.spark, x) for x in ("late-in", "late-bars", "late-bars-state"))
    for part in (F.col("event_id") % 10 != 3, F.col("event_id") % 10 == 3):
        t.events.where(part).write.mode("append").parquet(at)
        bars.partial_bars(t.spark, at, out, state)
    return bars.whole_bars(t.spark, out)
