"""Gaps, completeness, set operations, versions, synchronisation, lake reads, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import dedup as D
from tidemark.operators import gaps as G
from tidemark.operators import sync as S
from tidemark.operators.bars import KEYS
from tidemark.operators.grid import span_grid
from tidemark.plans.registry import query
from tidemark.queries.trades import BARS_SQL, GRID_SQL, bars
from tidemark.sources.files import discovered, footer_bounds
from tidemark.sources.scratch import scratch
from tidemark.sources.tables import PERP_SQL, SPOT_SQL

GAPS_SQL = BARS_SQL + """, gaps AS (
  SELECT symbol, timestamp_m1 + INTERVAL 1 MINUTE AS gap_start, nxt - INTERVAL 1 MINUTE AS gap_end, (epoch_us(nxt) - epoch_us(timestamp_m1)) // 60000000 - 1 AS missing_steps
  FROM (SELECT symbol, timestamp_m1, lead(timestamp_m1) OVER (PARTITION BY symbol ORDER BY timestamp_m1) AS nxt FROM bars) WHERE nxt - timestamp_m1 > INTERVAL 1 MINUTE)"""


def gaps(t):
    return G.missing_ranges(bars(t), ["symbol"], "timestamp_m1", 60)


@query("missing_minute_ranges", f"WITH {GAPS_SQL} SELECT * FROM gaps")
def missing_minute_ranges(t):
    """Runs of missing minutes between bars."""
    return gaps(t)


@query("missing_ranges", """WITH d AS (SELECT DISTINCT o_orderpriority, date_trunc('day', o_orderdate)::TIMESTAMP AS day FROM orders),
  n AS (SELECT *, lead(day) OVER (PARTITION BY o_orderpriority ORDER BY day) AS nxt FROM d)
  SELECT o_orderpriority, day + INTERVAL 1 DAY AS gap_start, nxt - INTERVAL 1 DAY AS gap_end, date_diff('day', day, nxt) - 1 AS missing_steps FROM n WHERE nxt - day > INTERVAL 1 DAY""")
def missing_ranges(t):
    """Runs of missing days of each series."""
    return G.missing_ranges(t.orders, ["o_orderpriority"], "o_orderdate", 86_400)


@query("trade_fetch_windows", f"WITH {GAPS_SQL}, w AS (SELECT symbol, gap_start, gap_end, unnest(range(0, (epoch_us(gap_end) - epoch_us(gap_start)) // 900000000 + 1)) AS i FROM gaps) SELECT symbol, gap_start + i * INTERVAL 15 MINUTE AS window_start, least(gap_end, gap_start + (i + 1) * INTERVAL 15 MINUTE - INTERVAL 1 MICROSECOND) AS window_end FROM w")
def trade_fetch_windows(t):
    """Gaps cut into requests of at most 15 minutes."""
    return G.fetch_windows(gaps(t), ["symbol"], "gap_start", "gap_end", 900)


@query("utc_day_windows", f"WITH {GAPS_SQL}, w AS (SELECT symbol, gap_start, gap_end, unnest(generate_series(date_trunc('day', gap_start)::TIMESTAMP, date_trunc('day', gap_end)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM gaps) SELECT symbol, greatest(gap_start, d) AS window_start, least(gap_end, d + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND) AS window_end FROM w")
def utc_day_windows(t):
    """Ranges cut at UTC midnights."""
    return G.day_windows(gaps(t), ["symbol"], "gap_start", "gap_end")


@query("completeness_intervals", f"""WITH {GRID_SQL}, c AS (SELECT g.symbol, g.timestamp_m1, CASE WHEN b.symbol IS NOT NULL THEN 'observed' WHEN hour(g.timestamp_m1) < 8 THEN 'confirmed_empty'
    WHEN hour(g.timestamp_m1) = 12 THEN 'expected_provider_gap' ELSE 'unverified' END AS label FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.timestamp_m1 = b.timestamp_m1),
  s AS (SELECT *, CASE WHEN label IS DISTINCT FROM lag(label) OVER (PARTITION BY symbol ORDER BY timestamp_m1) THEN 1 ELSE 0 END AS st FROM c),
  r AS (SELECT *, sum(st) OVER (PARTITION BY symbol ORDER BY timestamp_m1) AS run FROM s)
  SELECT symbol, min(timestamp_m1) AS interval_start, max(timestamp_m1) AS interval_end, any_value(label) AS label, count(*) AS steps,
    CASE WHEN any_value(label) = 'unverified' THEN 'RECONCILE_REQUIRED' ELSE 'PASS' END AS status FROM r GROUP BY symbol, run""")
def completeness_intervals(t):
    """Minutes classified by the evidence for them, merged into intervals."""
    own = bars(t).select("symbol", "timestamp_m1").withColumn("seen", F.lit(True))
    at = F.hour("timestamp_m1")
    grid = span_grid(bars(t), KEYS, "timestamp_m1").drop("exchange").join(own, ["symbol", "timestamp_m1"], "left")
    labelled = grid.select("symbol", "timestamp_m1", G.classify(F.col("seen"), at < 8, at == 12).alias("label"))
    return G.islands(labelled, ["symbol"], "timestamp_m1", "label", 60).withColumn("status", G.status_of(F.col("label")))


@query("completeness_status", f"""WITH {GRID_SQL} SELECT g.symbol, count(*) FILTER (b.symbol IS NULL) AS unverified, CASE WHEN count(*) FILTER (b.symbol IS NULL) > 0 THEN 'RECONCILE_REQUIRED' ELSE 'PASS' END AS status
  FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.timestamp_m1 = b.timestamp_m1 GROUP BY 1""")
def completeness_status(t):
    """The status of a series without evidence of empty minutes: fail closed."""
    own = bars(t).select("symbol", "timestamp_m1").withColumn("seen", F.lit(True))
    grid = span_grid(bars(t), KEYS, "timestamp_m1").join(own, ["symbol", "timestamp_m1"], "left")
    label = G.classify(F.col("seen"), F.lit(None).cast("boolean"), F.lit(None).cast("boolean"))
    n = F.count_if(label == "unverified")
    return grid.groupBy("symbol").agg(n.alias("unverified"), F.when(n > 0, "RECONCILE_REQUIRED").otherwise("PASS").alias("status"))


@query("invalidated_months", """WITH c AS (SELECT DISTINCT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS m FROM orders)
  SELECT DISTINCT o_orderpriority, unnest(generate_series(m::TIMESTAMP, date_trunc('month', (m + INTERVAL 1 MONTH - INTERVAL 1 DAY + INTERVAL 30 DAY))::TIMESTAMP, INTERVAL 1 MONTH)) AS rebuild_month FROM c""")
def invalidated_months(t):
    """Months whose features reach back into a changed month."""
    changed = t.orders.select("o_orderpriority", F.trunc("o_orderdate", "month").alias("m")).distinct()
    return G.invalidated_months(changed, ["o_orderpriority"], "m", 30).withColumn("rebuild_month", F.col("rebuild_month").cast("timestamp_ntz"))


@query("partition_bounds", "SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS month, min(l_shipdate) AS low, max(l_shipdate) AS high, count(*) AS n_rows FROM lineitem GROUP BY 1")
def partition_bounds(t):
    """Bounds and rows of each partition, from pruned columns."""
    return t.lineitem.groupBy(F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("month")).agg(
        F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high"), F.count(F.lit(1)).alias("n_rows"))


@query("file_bounds", "SELECT min(o_orderdate) AS low, max(o_orderdate) AS high, count(*) AS n_rows FROM orders")
def file_bounds(t):
    """Bounds and row count of a table, from footers alone."""
    found = footer_bounds(t.spark, f"{t.sf_dir}/orders.parquet", ["o_orderdate"])
    return found.select(F.col("low_o_orderdate").alias("low"), F.col("high_o_orderdate").alias("high"), "n_rows")


@query("topk_export", f"WITH {SPOT_SQL} SELECT * FROM spot ORDER BY volume DESC, day DESC LIMIT 100", "open high low close volume")
def topk_export(t):
    """The hundred busiest days: a top-k, where the limit is the feature."""
    return t.daily("orders").orderBy(F.col("volume").desc(), F.col("day").desc()).limit(100)


@query("time_range_filter", "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31' GROUP BY 1", "total", places=2)
def time_range_filter(t):
    """A time range, both ends included, pushed to the scan."""
    at = F.col("o_orderdate")
    return t.orders.where(at.between(F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz"))).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("partition_selector", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery') GROUP BY 1")
def partition_selector(t):
    """Selection of partitions by name, in any case."""
    return t.customer.where(F.lower("c_mktsegment").isin("building", "machinery")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("union_by_name", f"WITH {SPOT_SQL}, {PERP_SQL} SELECT day, close, volume, NULL::DOUBLE AS high, 'spot' AS source FROM spot UNION ALL SELECT day, close, NULL, high, 'perp' FROM perp", "close volume high")
def union_by_name(t):
    """Union by name: missing columns become nulls."""
    a = t.daily("orders").select("day", "close", "volume").withColumn("source", F.lit("spot"))
    b = t.daily("lineitem").select("day", "high", "close").withColumn("source", F.lit("perp"))
    return a.unionByName(b, allowMissingColumns=True)


@query("union_relaxed", "SELECT n_nationkey::DOUBLE AS key, n_name AS name FROM nation UNION ALL SELECT s_acctbal, s_name FROM supplier", "key")
def union_relaxed(t):
    """Union of equal columns with relaxed types: integers widen."""
    return t.nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).unionByName(t.supplier.select(F.col("s_acctbal").alias("key"), F.col("s_name").alias("name")))


@query("symbol_intersection", "SELECT s_nationkey AS key FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def symbol_intersection(t):
    """Symbols that every source has."""
    return S.in_both(t.supplier.select(F.col("s_nationkey").alias("key")), t.customer.select(F.col("c_nationkey").alias("key")))


@query("month_difference", "SELECT DISTINCT date_trunc('month', l_shipdate)::TIMESTAMP AS month FROM lineitem EXCEPT SELECT date_trunc('month', o_orderdate)::TIMESTAMP FROM orders")
def month_difference(t):
    """Months asked for that aren't there."""
    month = lambda c: F.date_trunc("month", c).cast("timestamp_ntz").alias("month")
    return S.only_in(t.lineitem.select(month("l_shipdate")), t.orders.select(month("o_orderdate")))


@query("series_discovery", "SELECT DISTINCT event_type AS dataset, 'S' || (user_id % 5) AS symbol, strftime(ts, '%Y-%m') AS month FROM events")
def series_discovery(t):
    """The series and months that exist, from the names of a table's folders."""
    at = scratch(t.spark, "series")
    symbol, month = F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")), F.date_format("ts", "yyyy-MM")
    rows = t.events.select("event_id", "value", F.col("event_type").alias("dataset"), symbol.alias("symbol"), month.alias("month"))
    rows.repartition("dataset", "symbol", "month").write.partitionBy("dataset", "symbol", "month").parquet(at)
    return discovered(t.spark, at)


ARTIFACT_SQL = """art AS (SELECT p_brand AS dataset, (1 + p_size % 3) || '.' || (p_size % 12) || '.' || (p_partkey % 15) AS version, p_partkey AS built FROM part)"""


def artifacts(t):
    part = lambda c: c.cast("string")
    size, key = F.col("p_size"), F.col("p_partkey")
    return t.part.select(F.col("p_brand").alias("dataset"), F.concat_ws(".", part(size % 3 + 1), part(size % 12), part(key % 15)).alias("version"), key.alias("built"))


ORDER_SQL = "split_part(version, '.', 1)::INT DESC, split_part(version, '.', 2)::INT DESC, split_part(version, '.', 3)::INT DESC, built DESC"


@query("latest_version", f"WITH {ARTIFACT_SQL} SELECT dataset, version, built FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY {ORDER_SQL}) AS k FROM art) WHERE k = 1")
def latest_version(t):
    """The highest version of each dataset, then the latest build."""
    return S.latest_version(artifacts(t), ["dataset"], "version", "built")


@query("retention_topn", f"WITH {ARTIFACT_SQL} SELECT dataset, version, built, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY {ORDER_SQL}) AS k FROM art) WHERE k <= 3")
def retention_topn(t):
    """The three newest versions of each dataset stay: a retention rule."""
    return S.retained(artifacts(t), ["dataset"], "version", "built", 3).withColumn("rank", F.col("rank").cast("long"))


@query("row_delta_plan", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'insert' WHEN o_orderpriority LIKE '1%' THEN 'update' ELSE 'unchanged' END AS action FROM orders
  UNION ALL SELECT -o_orderkey - 1, 'delete' FROM orders WHERE o_orderstatus = 'P'""")
def row_delta_plan(t):
    """Inserts, updates, deletes and unchanged rows by digest, without a watermark."""
    source = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    old = t.orders.withColumn("o_totalprice", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    target = old.withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "P", -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))).select("o_orderkey", "o_totalprice", "o_orderdate")
    return S.delta(source, target, ["o_orderkey"], ["o_totalprice", "o_orderdate"])


@query("delta_summary", "SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'update' ELSE 'unchanged' END AS action, count(*) AS n FROM orders GROUP BY 1")
def delta_summary(t):
    """How many rows of each action a delta has."""
    changed = t.orders.withColumn("o_totalprice", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return S.delta(t.orders, changed, ["o_orderkey"], ["o_totalprice"]).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_certification", "SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_partkey)) AS n_keys, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)) AS duplicate_keys, count(*) FILTER (l_orderkey IS NULL OR l_partkey IS NULL) AS null_keys, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen FROM lineitem")
def snapshot_certification(t):
    """Counts, key soundness and bounds of a snapshot before it is served: a key that some rows share."""
    return S.certify(t.lineitem, ["l_orderkey", "l_partkey"], "l_shipdate")


@query("row_digests", "SELECT o_orderkey, sha256('column:o_orderstatus=str:' || o_orderstatus || chr(31) || 'column:o_custkey=int:' || o_custkey || chr(31) || 'column:o_orderdate=dt:' || epoch_us(o_orderdate) || chr(31)) AS digest FROM orders")
def row_digests(t):
    """Digests of rows, with the types of their values."""
    return t.orders.select("o_orderkey", S.row_digest(t.orders, ["o_orderstatus", "o_custkey", "o_orderdate"]).alias("digest"))


@query("schema_signature", """WITH d AS (SELECT row_number() OVER () AS i, column_name, CASE WHEN column_type = 'BIGINT' THEN 'bigint' WHEN column_type = 'INTEGER' THEN 'int' WHEN column_type = 'DOUBLE' THEN 'double'
    WHEN column_type = 'VARCHAR' THEN 'string' WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' END AS kind FROM (DESCRIBE orders))
  SELECT (SELECT count(*) FROM orders) AS n_rows, sha256(string_agg(column_name || ':' || kind, ',' ORDER BY i)) AS signature FROM d""")
def schema_signature(t):
    """Rows of a table with the digest of its names and types."""
    return t.orders.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("signature", F.lit(S.schema_signature(t.orders)))


@query("schema_drift_read", "SELECT c_custkey AS key, c_acctbal::DOUBLE AS balance, NULL::VARCHAR AS extra FROM customer", "balance")
def schema_drift_read(t):
    """A declared schema over files: missing columns become nulls, extra ones are ignored."""
    from tidemark.sources.lake import read_declared

    df = read_declared(t.spark, f"{t.sf_dir}/customer.parquet", "c_custkey bigint, c_acctbal double, extra string")
    return df.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), "extra")


@query("freshest_file_wins", "SELECT o_orderkey, o_totalprice FROM orders", "o_totalprice")
def freshest_file_wins(t):
    """Of rows with one key, the one in the newest file, and there the last, stays."""
    from tidemark.sources.lake import freshest

    return freshest(t.spark, [f"{t.sf_dir}/orders.parquet"], ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("merge_upsert", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice FROM orders""", "o_totalprice")
def merge_upsert(t):
    """New rows merged over existing ones by natural key: the new ones win."""
    old = t.orders.select("o_orderkey", "o_totalprice").withColumn("wave", F.lit(0))
    new = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_totalprice") + 10).alias("o_totalprice")).withColumn("wave", F.lit(1))
    return D.keep_last(old.unionByName(new), ["o_orderkey"], F.col("wave")).drop("wave")


@query("closed_minutes", "SELECT date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1, count(*) AS n, sum(value) AS total FROM events WHERE date_trunc('minute', ts) < (SELECT date_trunc('minute', max(ts)) FROM events) GROUP BY 1", "total")
def closed_minutes(t):
    """Only closed minutes: the last one may still grow."""
    last = t.events.agg(X.minute(F.max("ts")).alias("open_minute"))  # one row
    rows = t.events.select(X.minute(F.col("ts")).alias("timestamp_m1"), "value").join(F.broadcast(last), F.col("timestamp_m1") < F.col("open_minute"))
    return rows.groupBy("timestamp_m1").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("streaming_minute_bars", "SELECT event_type, date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1, count(*) AS n, max(value) AS high, min(value) AS low, sum(value) AS total FROM events GROUP BY 1, 2", "high low total")
def streaming_minute_bars(t):
    """The tumbling aggregate as a stream, run to its end over the table: late rows are counted, and noted as late."""
    from tidemark.streaming.bars import run_minute_bars

    return run_minute_bars(t.spark, f"{t.sf_dir}/events.parquet")


@query("streaming_last_wins", "SELECT user_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value, count(*) AS n FROM events GROUP BY 1", "value")
def streaming_last_wins(t):
    """Late rows replace earlier ones: keyed state of the newest row of each key."""
    from tidemark.streaming.bars import run_last_wins

    return run_last_wins(t.spark, f"{t.sf_dir}/events.parquet")
