"""The given tables, and the market concepts that stand on them.

``events`` are trade ticks (symbols from users, sides from event types,
quantities from ``props``), ``orders`` and ``lineitem`` are two daily price
series, ``part`` is an option chain and line items are the levels of books.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import minute


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def ticks(self) -> DataFrame:
        """Raw trade ticks, with their time of arrival."""
        side = F.when(F.col("event_type") == "purchase", "buy").when(F.col("event_type") == "click", "sell").otherwise("unknown")
        return self.events.select(
            F.lit("sim").alias("exchange"),
            F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
            F.col("ts").alias("trade_time"),
            F.col("event_id").alias("trade_id"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").cast("double").alias("quantity"),
            side.alias("side"),
            F.col("ts").alias("ingested_at"),
        )

    def ticks_twice(self) -> DataFrame:
        """Every tick, and every tick again: a minute later, with its price corrected."""
        first = self.ticks()
        again = first.withColumn("price", F.col("price") + 1).withColumn(
            "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 60 SECONDS")
        )
        return first.unionByName(again)

    def quotes(self) -> DataFrame:
        """Observations of a slowly changing state: exchange, symbol, ts, value."""
        return self.events.where("event_type = 'signup'").select(
            F.lit("sim").alias("exchange"),
            F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
            "ts", "event_id", "value",
        )

    def daily(self, table: str) -> DataFrame:
        """Daily bars of orders ('spot') or line items ('perp'): day, open, high, low, close, volume."""
        if table == "orders":
            rows = self.orders.select(
                F.col("o_orderdate").alias("ts"), F.struct("o_orderkey").alias("place"), F.col("o_totalprice").alias("price"),
                F.lit(1.0).alias("size"),
            )
        else:
            rows = self.lineitem.select(
                F.col("l_shipdate").alias("ts"), F.struct("l_orderkey", "l_linenumber").alias("place"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("size"),
            )
        return rows.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
            F.min_by("price", "place").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.max_by("price", "place").alias("close"), F.sum("size").alias("volume"),
        )

    def minute_series(self) -> DataFrame:
        """The last price and the flow of each minute with ticks: exchange, symbol, ts, price, volume."""
        return self.ticks().groupBy("exchange", "symbol", minute(F.col("trade_time")).alias("ts")).agg(
            F.max_by("price", F.struct("trade_time", "trade_id")).alias("price"),
            F.sum("quantity").alias("volume"),
        )


#: SQL of the same views.
TICKS_SQL = r"""ticks AS (
  SELECT 'sim' AS exchange, 'S' || (user_id % 5) AS symbol, ts AS trade_time, event_id AS trade_id, value AS price,
         CAST(nullif(regexp_extract(props, '\d+'), '') AS DOUBLE) AS quantity,
         CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' ELSE 'unknown' END AS side,
         ts AS ingested_at
  FROM events)"""
TWICE_SQL = TICKS_SQL + """, twice AS (
  SELECT * FROM ticks UNION ALL
  SELECT exchange, symbol, trade_time, trade_id, price + 1, quantity, side, ingested_at + INTERVAL 60 SECOND FROM ticks)"""
QUOTES_SQL = """quotes AS (
  SELECT 'sim' AS exchange, 'S' || (user_id % 5) AS symbol, ts, event_id, value FROM events WHERE event_type = 'signup')"""
SPOT_SQL = """spot AS (
  SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS day, arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*)::DOUBLE AS volume
  FROM orders GROUP BY 1)"""
PERP_SQL = """lp AS (
  SELECT date_trunc('day', l_shipdate)::TIMESTAMP AS day, l_orderkey * 100 + l_linenumber AS place,
         l_extendedprice / l_quantity AS price, l_quantity FROM lineitem),
perp AS (
  SELECT day, arg_min(price, place) AS open, max(price) AS high, min(price) AS low, arg_max(price, place) AS close,
         sum(l_quantity) AS volume FROM lp GROUP BY 1)"""
SERIES_SQL = TICKS_SQL + """, series AS (
  SELECT exchange, symbol, date_trunc('minute', trade_time)::TIMESTAMP AS ts,
         arg_max(price, (trade_time, trade_id)) AS price, sum(quantity) AS volume
  FROM ticks GROUP BY ALL)"""
