"""The lake: declared reads, merges, publication."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import lake


def test_declared_read(spark, tmp_path):
    spark.createDataFrame([(1, "5")], "a long, b string").write.parquet(str(tmp_path / "x/one"))
    spark.createDataFrame([(2, "z", 9)], "a long, b string, c long").write.parquet(str(tmp_path / "x/two"))
    df = lake.read_declared(spark, [str(tmp_path / "x/one"), str(tmp_path / "x/two")], "a bigint, b double, c bigint, d string")
    assert sorted(map(tuple, df.collect()), key=str) == [(1, 5.0, None, None), (2, None, 9, None)]


def test_merge_replaces_only_touched_partitions(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.createDataFrame([(1, "old", "jan"), (2, "old", "jan"), (3, "old", "feb")], "id long, v string, month string").write.partitionBy("month").parquet(at)
    untouched = {p.name for p in (tmp_path / "t" / "month=feb").iterdir()}
    new = spark.createDataFrame([(2, "new", "jan"), (4, "new", "mar")], "id long, v string, month string")
    lake.merge_partitions(spark, at, new, ["id"], ["month"])
    got = sorted((r.id, r.v, r.month) for r in spark.read.parquet(at).collect())
    assert got == [(1, "old", "jan"), (2, "new", "jan"), (3, "old", "feb"), (4, "new", "mar")]
    assert untouched == {p.name for p in (tmp_path / "t" / "month=feb").iterdir()}


def test_publication_is_by_manifest(spark, tmp_path):
    root = str(tmp_path / "gold")
    df = spark.range(3).withColumn("v", F.lit(1))
    lake.publish(df, root, "1.2.0", ["id"], "b1")
    lake.publish(df.withColumn("v", F.lit(2)), root, "1.10.0", ["id"], "b1")
    assert {r.v for r in lake.published(spark, root).collect()} == {2}
    assert {r.v for r in lake.published(spark, root, "1.2.0").collect()} == {1}
    with pytest.raises(ValueError):
        lake.publish(df.unionByName(df), root, "2.0.0", ["id"], "b1")
    assert {r.v for r in lake.published(spark, root).collect()} == {2}
    with pytest.raises(FileNotFoundError):
        lake.published(spark, root, "9.9.9")


def test_freshest_row_wins(spark, tmp_path):
    import time

    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string").coalesce(1).write.parquet(a)
    time.sleep(1.1)
    spark.createDataFrame([(2, "newer"), (2, "newest")], "id long, v string").coalesce(1).write.parquet(b)
    assert {r.id: r.v for r in lake.freshest(spark, [a, b], ["id"]).collect()} == {1: "old", 2: "newest"}


def test_the_last_build_of_a_version_counts_and_can_be_withdrawn(spark, tmp_path):
    root = str(tmp_path / "gold")
    for v, version in ((1, "1.0.0"), (2, "1.0.0"), (3, "1.0.20260731"), (4, "1.0.0")):
        lake.publish(spark.range(3).withColumn("v", F.lit(v)), root, version, ["id"], "b", {"source": f"s{v}"})
    value = lambda *a: {r.v for r in lake.published(spark, root, *a).collect()}
    assert value() == {3} and value("1.0.0") == {4}
    assert lake.attested(spark, root, {"source": "s3"}) and not lake.attested(spark, root, {"source": "s4"})
    assert lake.roll_back(spark, root)["version"] == "1.0.20260731"
    assert value() == {4}
    lake.roll_back(spark, root)
    assert value() == {2}


def test_sinks(spark, tmp_path):
    from datetime import datetime

    df = spark.createDataFrame([(1, "a|b", 1.5, datetime(2026, 1, 1, 0, 0, 1))], "id long, s string, x double, at timestamp_ntz")
    lake.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).first().at == "2026-01-01T00:00:01.000000"
    lake.json_report(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first().s == "a|b"
    assert lake.markdown_report(df.select("id", "s"), "T") == "# T\n\n| id | s |\n| --- | --- |\n| 1 | a\\|b |\n"
    with pytest.raises(ValueError):
        lake.markdown_report(spark.range(5), "T", 4)
    assert lake.table_ddl(df, "gold.t", ["id"]) == 'CREATE TABLE gold.t (\n  "id" BIGINT NOT NULL,\n  "s" TEXT,\n  "x" DOUBLE PRECISION,\n  "at" TIMESTAMP,\n  PRIMARY KEY ("id")\n)'
    with pytest.raises(TypeError):
        lake.table_ddl(df.withColumn("a", F.array("id")), "t", ["id"])


def test_minutes_close_once_over_restarts(spark, tmp_path):
    from datetime import datetime

    from tidemark.streaming.bars import follow_minute_bars

    events, out, state = (str(tmp_path / x) for x in ("events", "out", "state"))
    add = lambda *minutes: spark.createDataFrame([("e", datetime(2026, 1, 1, 0, m), float(m)) for m in minutes], "event_type string, ts timestamp_ntz, value double").coalesce(1).write.mode("append").parquet(events)
    closed = lambda: sorted((r.timestamp_m1.minute, r.n) for r in spark.read.parquet(out).collect())
    add(0, 1, 1, 5, 20)
    follow_minute_bars(spark, events, out, state)
    assert closed() == [(0, 1), (1, 2), (5, 1)]
    add(20, 21, 40)
    add(2)  # too late: its minute has closed
    follow_minute_bars(spark, events, out, state)
    assert closed() == [(0, 1), (1, 2), (5, 1), (20, 2), (21, 1)]
