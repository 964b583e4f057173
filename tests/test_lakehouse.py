"""Drifted files, footers, publication of siblings, builds by fingerprint, late data, reconciliation, window ledgers, checkpoints."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental
from tidemark.sources import files, lake, publication


def parts(path):
    return sorted(p for p in path.rglob("*.parquet"))


def test_int_text_and_missing_columns_in_one_folder(spark, tmp_path):
    at = tmp_path / "t"
    for i, (ddl, row) in enumerate((("a long, b string", (1, "x")), ("a int, b int", (2, 7)), ("a string", ("3",)), ("a long, b string", (4, "9")), ("a string, b struct<c: int>", ("z", (1,))))):
        spark.createDataFrame([row], ddl).coalesce(1).write.parquet(str(at / f"m=2024-0{i + 1}"))
    df = lake.read_declared(spark, str(at), "a bigint, b double, m string, d int")
    assert sorted(map(tuple, df.collect()), key=repr) == sorted([(1, None, "2024-01", None), (2, 7.0, "2024-02", None), (3, None, "2024-03", None), (4, 9.0, "2024-04", None), (None, None, "2024-05", None)], key=repr)
    # Files that agree are read together: long and text, int, text (alone and with a struct).
    assert len(files.schema_groups(spark, [str(at)])) == 3
    got = lake.freshest(spark, [str(at)], ["a"])
    assert dict(got.dtypes) == {"a": "string", "b": "string", "m": "string"}
    assert {r.a: r.b for r in got.collect()} == {"1": "x", "2": "7", "3": None, "4": "9", "z": '{"c":1}'}


def test_common_types(spark):
    from pyspark.sql import types as T

    assert files.common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert files.common_type(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert files.common_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert files.common_type(T.BooleanType(), T.LongType()) == T.StringType()


def test_discovery_opens_no_file_and_prunes_folders(spark, tmp_path):
    at = tmp_path / "t"
    df = spark.createDataFrame([("a", "2024-01", 1), ("a", "2024-02", 2), ("b", "2024-01", 3)], "symbol string, month string, x int")
    df.write.partitionBy("symbol", "month").parquet(str(at))
    found = files.discovered(spark, str(at), F.col("symbol") == "a")
    assert sorted(map(tuple, found.collect())) == [("a", "2024-01"), ("a", "2024-02")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "ReadSchema: struct<>" in plan
    for p in parts(at):
        p.write_bytes(b"spoiled")
    assert files.discovered(spark, str(at)).count() == 3


def test_bounds_come_from_footers(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), (F.col("id") / 2).alias("x"))
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    got = files.footer_bounds(spark, str(tmp_path / "t"), ["id", "t", "x"])
    want = df.agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.min("t"), F.max("t"), F.min("x"), F.max("x"))
    assert tuple(got.first()) == tuple(want.first())
    plan = got._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id)" in plan
    df.select(F.struct("id").alias("s"), "x").write.parquet(str(tmp_path / "n"))
    with pytest.raises(TypeError):
        files.footer_bounds(spark, str(tmp_path / "n"), ["x"])


def test_content_digests_ignore_order_and_tell_contents(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0.5), (2, None, 0.5)], "k int, s string, x double")
    digest = lambda d: d.first().digest
    assert digest(files.content_digests(df)) == digest(files.content_digests(df.orderBy(F.desc("k")).repartition(3)))
    for other in (df.dropDuplicates(), df.withColumn("k", F.col("k").cast("long")), df.withColumn("s", F.coalesce("s", F.lit(""))), df.withColumnRenamed("x", "y"), df.limit(0)):
        assert digest(files.content_digests(other)) != digest(files.content_digests(df))
    assert {r.k: r.n_rows for r in files.content_digests(df, ["k"]).collect()} == {1: 1, 2: 2}


def siblings(spark, v, bad=None):
    df = spark.range(3).withColumn("v", F.lit(v))
    return [publication.Artifact(n, df.unionByName(df) if n == bad else df, f"1.0.{v}", ["id"], {"source": f"s{v}"}) for n in ("m1", "m5", "h1")]


def test_siblings_are_published_together_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    value = lambda: {n: {r.v for r in publication.published_artifact(spark, root, n).collect()} for n in ("m1", "m5", "h1")}
    first = publication.publish_together(spark, root, siblings(spark, 1), "b1")
    old = dict.fromkeys(("m1", "m5", "h1"), {1})
    assert value() == old
    for bad in ("m1", "m5", "h1"):  # keys repeat in any one of them
        with pytest.raises(ValueError):
            publication.publish_together(spark, root, siblings(spark, 2, bad), "b1")
        assert value() == old
    with pytest.raises(ValueError):  # a check of the last one fails
        publication.publish_together(spark, root, siblings(spark, 2), "b1", check=lambda name, df: name != "h1")
    assert value() == old

    def broken(*_):
        raise OSError("the disk is full")

    with monkeypatch.context() as m:  # the commit itself fails
        m.setattr(publication.records, "append", broken)
        with pytest.raises(OSError):
            publication.publish_together(spark, root, siblings(spark, 2), "b1")
    assert value() == old
    with pytest.raises(ValueError):
        publication.publish_together(spark, root, siblings(spark, 2)[:1] * 2, "b1")
    second = publication.publish_together(spark, root, siblings(spark, 2), "b1")
    assert value() == dict.fromkeys(("m1", "m5", "h1"), {2})
    assert {r.v for r in publication.published_artifact(spark, root, "m5", "1.0.1").collect()} == {1}
    publication.withdraw(spark, root, second["serial"])
    assert value() == old and {r.status for r in publication.attest(spark, root).collect()} == {"attested"}
    assert publication.catalogue(spark, root).where("name = 'm1'").first().sources == {"source": "s1"} and first["artifacts"][0]["rows"] == 3
    with pytest.raises(FileNotFoundError):
        publication.published_artifact(spark, root, "d1")


def test_a_changed_file_fails_its_attestation(spark, tmp_path):
    root = str(tmp_path / "gold")
    entry = publication.publish_together(spark, root, siblings(spark, 1), "b1")
    path = entry["artifacts"][1]["path"]
    spark.read.parquet(path).withColumn("v", F.lit(9)).write.parquet(path + "-other")  # as many rows, another value
    import os
    import shutil

    for p in os.listdir(path):
        os.remove(f"{path}/{p}")
    for p in os.listdir(path + "-other"):
        shutil.copy(f"{path}-other/{p}", path)
    spark.catalog.refreshByPath(path)
    assert {r.name: r.status for r in publication.attest(spark, root, entry["serial"]).collect()} == {"m1": "attested", "m5": "modified", "h1": "attested"}
    shutil.rmtree(entry["artifacts"][2]["path"])
    assert {r.name: r.status for r in publication.attest(spark, root).collect()}["h1"] == "unreadable"


@pytest.fixture
def monthly(spark, tmp_path):
    at = str(tmp_path / "source")

    def add(*rows):
        df = spark.createDataFrame([(k, datetime.fromisoformat(t), float(x)) for k, t, x in rows], "k string, ts timestamp_ntz, x double")
        df.withColumn("month", F.date_format("ts", "yyyy-MM")).coalesce(1).write.mode("append").partitionBy("month").parquet(at)

    add(("a", "2024-01-10", 1), ("a", "2024-02-05", 2), ("a", "2024-03-05", 4), ("a", "2024-04-20", 8), ("b", "2024-04-21", 16))
    return at, str(tmp_path / "target"), add


def trailing_month(df):
    """Sum of x over 30 days."""
    from tidemark.functions.windows import rolling

    return rolling(df, ["k"], "ts", {"s": F.col("x")}, {"30d": 30 * 86_400}, moments=False).select("k", "ts", F.col("s_30d.total").alias("total"))


def state(spark, target):
    return sorted((r.k, f"{r.ts:%Y-%m-%d}", r.total) for r in incremental.built(spark, target).collect())


def test_unchanged_months_are_left_alone(spark, monthly):
    source, target, add = monthly
    build = lambda contract="v1": incremental.build_months(spark, source, target, trailing_month, "ts", contract, 30)
    assert build() == ["2024-01", "2024-02", "2024-03", "2024-04"]
    first = state(spark, target)
    assert first == [("a", "2024-01-10", 1.0), ("a", "2024-02-05", 3.0), ("a", "2024-03-05", 6.0), ("a", "2024-04-20", 8.0), ("b", "2024-04-21", 16.0)]
    assert build() == [] and state(spark, target) == first
    add(("a", "2024-01-20", 32))  # late: its month, and those whose look-back reaches into it
    assert build() == ["2024-01", "2024-02", "2024-03"]
    assert state(spark, target)[:4] == [("a", "2024-01-10", 1.0), ("a", "2024-01-20", 33.0), ("a", "2024-02-05", 35.0), ("a", "2024-03-05", 6.0)]
    assert build("v2") == ["2024-01", "2024-02", "2024-03", "2024-04"] and build("v2") == []


def test_a_modified_output_is_built_again(spark, monthly, tmp_path):
    source, target, _ = monthly
    build = lambda: incremental.build_months(spark, source, target, trailing_month, "ts", "v1", 0)
    build()
    whole = state(spark, target)
    victim = parts(tmp_path / "target" / "data")[0]
    month = victim.parent.name.partition("=")[2]
    victim.unlink()
    (victim.parent / f".{victim.name}.crc").unlink(missing_ok=True)
    assert build() == [month] and state(spark, target) == whole


def test_a_failed_build_leaves_what_was_there(spark, monthly):
    source, target, add = monthly
    incremental.build_months(spark, source, target, trailing_month, "ts", "v1", 30)
    before = state(spark, target)
    add(("a", "2024-04-25", 1))
    fails = lambda df: df.select("k", "ts", F.raise_error(F.lit("no")).cast("double").alias("total"))
    with pytest.raises(Exception, match="no"):
        incremental.build_months(spark, source, target, fails, "ts", "v1", 30)
    assert state(spark, target) == before
    assert incremental.build_months(spark, source, target, trailing_month, "ts", "v1", 30) == ["2024-04"]
    assert state(spark, target)[4] == ("a", "2024-04-25", 9.0)


def test_late_rows_change_their_months_and_a_replay_changes_nothing(spark, tmp_path):
    from tidemark.streaming.late import follow_late, merge_batch

    source, table, state_at, target = (str(tmp_path / x) for x in ("in", "table", "state", "out"))

    def come(*rows):
        spark.createDataFrame([(k, datetime.fromisoformat(t), float(x), n) for k, t, x, n in rows], "k string, ts timestamp_ntz, x double, seen int").coalesce(1).write.mode("append").parquet(source)

    def follow():
        before = {p: p.stat().st_mtime_ns for p in parts(tmp_path / "table")} if (tmp_path / "table").exists() else {}
        follow_late(spark, source, table, state_at, ["k", "ts"], "ts", ["seen"])
        after = {p: p.stat().st_mtime_ns for p in parts(tmp_path / "table")}
        return sorted({p.parent.name.partition("=")[2] for p, t in after.items() if before.get(p) != t}), incremental.build_months(spark, table, target, trailing_month, "ts", "v1", 10)

    come(("a", "2024-01-30", 1, 1), ("a", "2024-02-05", 2, 1), ("a", "2024-03-20", 4, 1), ("a", "2024-05-20", 8, 1))
    assert follow() == (["2024-01", "2024-02", "2024-03", "2024-05"],) * 2
    assert follow() == ([], [])
    come(("a", "2024-02-05", 3, 2), ("a", "2024-02-06", 16, 2))  # a correction and a late row
    assert follow() == (["2024-02"], ["2024-02", "2024-03"])
    assert state(spark, target) == [("a", "2024-01-30", 1.0), ("a", "2024-02-05", 4.0), ("a", "2024-02-06", 20.0), ("a", "2024-03-20", 4.0), ("a", "2024-05-20", 8.0)]
    come(("a", "2024-02-05", 9, 1), ("a", "2024-02-06", 16, 2))  # older, and the same again
    assert follow() == ([], [])
    # A batch that failed between plan and rewriting is completed by its replay; one that was done isn't merged again.
    batch = spark.createDataFrame([("b", datetime(2024, 3, 1), 5.0, 1)], "k string, ts timestamp_ntz, x double, seen int")
    from tidemark.sources import records
    from tidemark.streaming import late

    ledger = str(tmp_path / "ledger")
    records.append(spark, ledger, late.LEDGER, [(7, "planned", "2024-03", 1)])
    assert merge_batch(batch, 7, table, ledger, ["k", "ts"], "ts", ["seen"]) == ["2024-03"]
    assert spark.read.parquet(table).where("k = 'b'").count() == 1
    again = {p: p.stat().st_mtime_ns for p in parts(tmp_path / "table")}
    assert merge_batch(batch.withColumn("x", F.lit(6.0)).withColumn("seen", F.lit(2)), 7, table, ledger, ["k", "ts"], "ts", ["seen"]) == ["2024-03"]
    assert again == {p: p.stat().st_mtime_ns for p in parts(tmp_path / "table")}
    with pytest.raises(ValueError):
        merge_batch(batch, 8, table, ledger, ["k"], "ts", ["seen"])


@pytest.fixture
def by_month(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"2024-0{i % 3 + 1}") for i in range(30)], "id long, month string")
    df.write.partitionBy("month").parquet(at)
    return at, df, str(tmp_path / "backup")


def reconciled(spark, by_month, targets=("2024-02",), reload=None, checks=None, **more):
    from tidemark.plans.reconcile import reconcile

    at, df, backup = by_month
    reload = reload or (lambda months: df.where(F.col("month").isin(months)).withColumn("id", F.col("id") + 100))
    return reconcile(spark, at, "month", list(targets), reload, backup, checks if checks is not None else {"complete": lambda: True, "fresh": lambda: True}, **more)


def test_a_targeted_reload_leaves_the_rest_alone(spark, by_month):
    report = reconciled(spark, by_month, rebuild=lambda months: months == ["2024-02"])
    assert (report.status, report.mode, report.blockers) == ("PASS", "targeted_reload", [])
    assert sorted(map(tuple, report.partitions.collect())) == [("2024-01", "kept", 10, False), ("2024-02", "reloaded", 10, True), ("2024-03", "kept", 10, False)]
    assert spark.read.parquet(by_month[2]).count() == 10
    assert sorted(r.id for r in spark.read.parquet(by_month[0]).where("month = '2024-02'").collect()) == [101 + 3 * i for i in range(10)]


def test_without_targets_nothing_is_written(spark, by_month):
    def never(_):
        raise AssertionError

    report = reconciled(spark, by_month, (), never)
    assert (report.status, report.mode) == ("PASS", "no_op_certification")
    assert {r.action for r in report.partitions.collect()} == {"kept"}


def test_reconciliation_fails_closed(spark, by_month, tmp_path):
    at, df, _ = by_month
    fail = lambda **x: reconciled(spark, (at, df, str(tmp_path / f"b{len(list(tmp_path.iterdir()))}")), **x)
    assert fail(checks={"complete": lambda: False, "fresh": lambda: True}).blockers == ["complete"]
    assert fail(rebuild=lambda months: False).blockers == ["lookback_unverified"]
    outside = fail(reload=lambda months: df)
    assert outside.blockers == ["reload_outside_targets"] and outside.checks == {"complete": "NOT_RUN", "fresh": "NOT_RUN"} and outside.status == "FAIL"

    def breaks(*_):
        raise OSError("gone")

    assert fail(reload=breaks).blockers == ["reconciliation_operation_failed"]
    late = fail(rebuild=breaks)
    assert late.status == "FAIL" and set(late.checks.values()) == {"NOT_RUN"}

    def meddles(months):  # another partition changes meanwhile
        df.where("month = '2024-03'").limit(3).write.mode("append").partitionBy("month").parquet(at)
        return df.where("month = '2024-02'")

    assert "unaffected_partitions_changed" in fail(reload=meddles).blockers


def test_windows_fail_apart_and_only_open_ones_run_again(spark, tmp_path):
    from tidemark.plans.windows_ledger import results, run_windows

    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    at = datetime(2024, 1, 1)
    windows = spark.createDataFrame([(s, at + timedelta(hours=h), at + timedelta(hours=h + 1, microseconds=-1)) for s in "ab" for h in range(3)], "symbol string, window_start timestamp_ntz, window_end timestamp_ntz")
    rows = spark.createDataFrame([("a", at, 1.0), ("a", at, 2.0), ("b", at + timedelta(hours=1), 4.0)], "symbol string, window_start timestamp_ntz, x double")

    def work(w, own):
        import pandas as pd

        if w["symbol"] == "a" and w["window_start"].hour == 1 and w["attempt"] == 1:
            raise ConnectionError("try again")
        return pd.DataFrame({"n": [len(own)], "total": [float(own["x"].sum())]})

    go = lambda w=work: run_windows(spark, windows, rows, w, "n long, total double", ledger, out, ["symbol"])
    first = go().collect()
    assert len(first) == 6 and [(r.symbol, r.window_start.hour, r.error) for r in first if r.status == "failed"] == [("a", 1, "ConnectionError: try again")]
    read = lambda: sorted((r.symbol, r.window_start.hour, r.n, r.total) for r in results(spark, ledger, out, windows, ["symbol"]).collect())
    assert read() == [("a", 0, 2, 3.0), ("a", 2, 0, 0.0), ("b", 0, 0, 0.0), ("b", 1, 1, 4.0), ("b", 2, 0, 0.0)]
    second = go().collect()
    assert [(r.symbol, r.window_start.hour, r.attempt, r.status) for r in second] == [("a", 1, 2, "done")]
    assert len(read()) == 6 and go().count() == 0

    def never(w, own):
        raise ConnectionError("down")

    other = str(tmp_path / "other")
    with pytest.raises(RuntimeError, match="all windows failed"):
        run_windows(spark, windows, rows, never, "n long, total double", other, str(tmp_path / "o2"), ["symbol"])
    assert spark.read.json(other).where("status = 'failed'").count() == 6  # the ledger was written all the same


def test_checkpoints_belong_to_their_plan(spark, tmp_path):
    from tidemark.streaming.checkpoints import bound_checkpoint

    spark.range(3).write.parquet(str(tmp_path / "s"))
    stream = lambda: spark.readStream.schema("id long").parquet(str(tmp_path / "s"))
    root = str(tmp_path / "state")
    first = bound_checkpoint(spark, root, stream().where("id > 1"), {"delay": "1 day"})
    assert bound_checkpoint(spark, root, stream().where("id > 1"), {"delay": "1 day"}) == first
    for df, options in ((stream().where("id > 2"), {"delay": "1 day"}), (stream().where("id > 1"), {"delay": "2 days"}), (stream().selectExpr("id AS k"), {"delay": "1 day"})):
        with pytest.raises(ValueError, match="another plan"):
            bound_checkpoint(spark, root, df, options)
    second = bound_checkpoint(spark, root, stream().where("id > 2"), {"delay": "1 day"}, anew=True)
    assert second != first and bound_checkpoint(spark, root, stream().where("id > 1"), {"delay": "1 day"}) == first


def test_a_gold_chain_over_buckets_shuffles_nothing(spark, tmp_path):
    from tidemark.plans import bucketed, contracts, gold

    def side(name, n):
        rows = [(e, s, datetime(2024, 1, 1) + timedelta(hours=h), float(h + n)) for e in "xy" for s in "ab" for h in range(n, 60)]
        return spark.createDataFrame(rows, "exchange string, symbol string, timestamp_m1 timestamp_ntz, value double").withColumn("instrument_name", F.lit("i")).withColumnRenamed("value", {"spot_ohlcv": "close_price", "perps_ohlcv": "close_price"}.get(name, "spread"))

    required, optional = contracts.GOLD["market.regime_features"]
    sources = {n: side(n, i) for i, n in enumerate((*required, *optional[:2]))}
    tables = bucketed.store_sources("market.regime_features", sources, "shuffle_free", str(tmp_path / "b"), 8)
    out = bucketed.build(spark, "market.regime_features", tables)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == len(sources) and "Bucketed: true" in plan
    plain = gold.build("market.regime_features", sources)
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(KeyError):
        bucketed.build(spark, "market.regime_features", {"grid": tables["grid"]})


def test_a_gold_chain_over_buckets_sorts_nothing_and_keeps_its_rows(spark, tmp_path):
    """Files are sorted as the joins need them; blocks, minutes of several days and a lacking time among them."""
    from tidemark.plans import bucketed, contracts, gold

    rows = [("x", s, datetime(2024, 1, 30) + timedelta(hours=7 * h), float(h)) for s in "ab" for h in range(30)] + [("x", "a", None, 1.0)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, timestamp_m1 timestamp_ntz, close_price double")
    sources = {n: df.where(F.col("close_price") % (i + 2) != 0) for i, n in enumerate(contracts.GOLD["market.regime_features"][0])}
    tables = bucketed.store_sources("market.regime_features", sources, "sort_free", str(tmp_path / "b"), bucketed.buckets_for(df.count()))
    out = bucketed.build(spark, "market.regime_features", tables)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == len(sources) and "Sort [" not in plan and "Exchange" not in plan
    plain = gold.build("market.regime_features", sources)
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_buckets_grow_with_the_rows():
    from tidemark.plans import bucketed

    assert [bucketed.buckets_for(n) for n in (0, 1_600_000, 1_600_001, 30_000_000)] == [16, 16, 17, 300]


@pytest.mark.parametrize("name", ["gold_regime_bucketed", "gold_regime_features"])
def test_regime_sources_are_read_from_bars_saved_once(spark, monkeypatch, name):
    from tidemark.plans import bucketed, gold
    from tidemark.queries import QUERIES

    class Seen(Exception):
        pass

    def seen(dataset, sources, *_):
        assert not [f for df in sources.values() for f in df.inputFiles() if "events" in f]
        raise Seen

    monkeypatch.setattr(bucketed, "store_sources", seen)
    monkeypatch.setattr(gold, "build", seen)
    with pytest.raises(Seen):
        QUERIES[name](spark, "/root/testdata/sf0.001")


def test_certification_holds_rows_against_their_entry(spark, tmp_path):
    import shutil

    root = str(tmp_path / "gold")
    df = spark.createDataFrame([("x", "a", datetime(2024, 1, 1, 0, m), 1.0) for m in range(5)], "exchange string, symbol string, timestamp_m1 timestamp_ntz, v double")
    keys = ["exchange", "symbol", "timestamp_m1"]
    artifact = lambda d: publication.Artifact("m1", d, "1.0.0", keys, lineage={"exchange": "x", "symbol": "a"}, ts="timestamp_m1")
    with pytest.raises(ValueError, match="lineage"):
        publication.publish_together(spark, root, [artifact(df.unionByName(df.withColumn("symbol", F.lit("b"))))], "b")
    with pytest.raises(ValueError, match="keys"):
        publication.publish_together(spark, root, [artifact(df.withColumn("symbol", F.lit(None).cast("string")))], "b")
    path = publication.publish_together(spark, root, [artifact(df)], "b")["artifacts"][0]["path"]
    told = publication.certify_artifact(spark, root, "m1").first()
    assert (told.status, told.n_rows, told.low, told.high, told.failed) == ("certified", 5, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 4), [])
    for change, failed in ((lambda d: d.where("minute(timestamp_m1) > 0"), ["content", "rows", "bounds"]), (lambda d: d.withColumn("symbol", F.lit("b")), ["content", "lineage"]),
                           (lambda d: d.unionByName(d), ["content", "rows", "keys"]), (lambda d: d.withColumn("v", F.col("v").cast("float")), ["content", "schema"])):
        shutil.rmtree(path)
        change(df).write.parquet(path)
        spark.catalog.refreshByPath(path)
        assert publication.certify_artifact(spark, root, "m1").first().failed == failed


def test_no_order_of_batches_loses_a_row(spark, tmp_path):
    from tidemark.streaming import bars

    source, out, state_at = (str(tmp_path / x) for x in ("in", "out", "state"))
    day = datetime(2024, 1, 31)
    for hours in (100, 3, 50, 0, 100):  # each file in a micro-batch of its own, not by time
        spark.createDataFrame([("e", day + timedelta(hours=hours, seconds=s), float(s)) for s in (0, 30, 90)], "event_type string, ts timestamp_ntz, value double").coalesce(1).write.mode("append").parquet(source)
    bars.partial_bars(spark, source, out, state_at, files_a_batch=1)
    got = bars.whole_bars(spark, out).orderBy("timestamp_m1").collect()
    assert [((r.timestamp_m1 - day).total_seconds() / 3600, r.n, r.high, r.low, r.total) for r in got][::2] == [(0, 2, 30, 0, 30), (3, 2, 30, 0, 30), (50, 2, 30, 0, 30), (100, 4, 30, 0, 60)]
    assert {r.timestamp_m1.day for r in got if r.revised} <= {31, 2} and sum(r.revised for r in got) >= 4
    months = {r.month: r.n for r in bars.late_months(spark, out).collect()}
    assert months.get("2024-01", 0) in (3, 6) and sum(months.values()) <= 9
    bars.partial_bars(spark, source, out, state_at, files_a_batch=1)  # nothing new
    assert sum(r.n for r in bars.whole_bars(spark, out).collect()) == 15
