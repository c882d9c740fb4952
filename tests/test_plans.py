"""Plan shapes that the jobs rely on at scale, checked on final (adaptive) plans."""
import pytest

from tickweave.plans import registry
from tickweave.session import release

from paths import SF001

Q = registry.queries()

# jobs whose series key is a real column (multi-series tape)
MULTI_SERIES = ["rolling_mean", "adapt_binance", "adapt_kraken_trades", "candle_preview"]


def executed(spark, key):
    release()
    spark.catalog.clearCache()
    df = Q[key](spark, SF001)
    df.collect()  # runs this frame's own execution, so its adaptive plan becomes the final one
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in plan
    return plan


@pytest.mark.parametrize("key", sorted(k for k in Q if k not in {
    "cv_accuracy", "model_roundtrip", "scaled_features", "rf_predictions", "confusion_matrix",
    "classification_report", "train_accuracy", "feature_importance", "proba_histogram", "cv_node_accuracy"}))
def test_no_cartesian_and_hash_aggregates(spark, key):
    plan = executed(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan, key


def test_pair_jobs_push_the_venue_filter(spark):
    plan = executed(spark, "threshold_ladder")
    assert "PushedFilters: [IsNotNull(ts), In(event_type, [click,view])]" in plan or \
        "In(event_type" in plan
    # only the columns the job uses are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]


@pytest.mark.parametrize("key", MULTI_SERIES)
def test_no_single_partition_with_real_series_keys(spark, key):
    assert "SinglePartition" not in executed(spark, key)


def test_gap_fill_reads_the_trades_once_and_deals_out_the_pieces(spark):
    plan = executed(spark, "ohlc_gapfill").split("Initial Plan")[0]
    assert plan.count("FileScan") == plan.count("InMemoryRelation")  # every scan is the kept candles' one
    assert "REPARTITION_BY_COL" in plan


def test_trade_window_pushes_both_bounds(spark):
    plan = executed(spark, "trade_window")
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_chart_series_is_a_filter(spark):
    plan = executed(spark, "chart_series").split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1  # the candles' own
