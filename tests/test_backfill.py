"""History backfill: only what is missing is built, and again gives the same."""

from pyspark.sql import functions as F

from tapeline.plans import backfill as B
from tapeline.session import work_path
from tapeline.sources import driver_tables as D


def test_backfill_fills_gaps_once_and_goes_on_after_a_stop(spark, sf_dir):
    spot, pools, store = D.spot(spark, sf_dir).withColumn("provider", F.lit("east")), D.pools(spark, sf_dir), work_path(spark, "history")
    sessions = sorted(r.session for r in spot.select("session").distinct().collect())[:6]
    targets = spark.createDataFrame([(s,) for s in sessions], "session date")
    run = lambda t, need=1: B.backfill(spark, spot, pools, t, store, F.lit(need), F.lit("now"), 6).first()
    assert B.gaps(spark, targets, store).count() == 6
    assert run(targets.where(F.col("session") < F.lit(sessions[2]))).written_days == 2
    first = run(targets)
    assert (first.target_days, first.complete_days, first.missing_days, first.written_days, first.status) == (6, 6, 0, 4, "complete")
    before = sorted(map(str, spark.read.parquet(store).collect()))
    files = sorted(r.f for r in spark.read.parquet(store).select(F.input_file_name().alias("f")).distinct().collect())
    assert run(targets).written_days == 0 and sorted(r.f for r in spark.read.parquet(store).select(F.input_file_name().alias("f")).distinct().collect()) == files
    B.write_documents(B.historical_documents(spot, pools, targets, F.lit(1), F.lit("now"), 6), store)
    assert sorted(map(str, spark.read.parquet(store).collect())) == before


def test_sessions_with_too_few_stocks_stay_open(spark, sf_dir):
    spot, pools, store = D.spot(spark, sf_dir).withColumn("provider", F.lit(None).cast("string")), D.pools(spark, sf_dir), work_path(spark, "history")
    targets = spark.createDataFrame(sorted(tuple(r) for r in spot.select("session").distinct().collect())[:3], "session date")
    status = B.backfill(spark, spot, pools, targets, store, F.lit(10_000), F.lit("now"), 3).first()
    assert (status.complete_days, status.missing_days, status.status) == (0, 3, "partial")
    B.backfill(spark, spot, pools, targets, store, F.lit(1), F.lit("now"), 3)
    assert {r.source for r in spark.read.parquet(store).collect()} == {"objective_qfq_daily_history"}


def test_fillings_read_bars_that_are_stored_once(spark, sf_dir, monkeypatch):
    from tapeline.queries import all_queries

    read = []

    def noted(spark, spot, pools, targets, store, required, *more):
        read.append([*spot.inputFiles(), *targets.inputFiles(), *spark.range(1).select(required).inputFiles()])
        return spark.range(1)

    monkeypatch.setattr(B, "backfill", noted)
    all_queries()["c13_backfill_status"](spark, sf_dir)
    assert len(read) == 2 and not [f for files in read for f in files if "lineitem" in f]
