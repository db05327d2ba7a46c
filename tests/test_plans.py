"""Plan-level checks: pushdown and pruning reach the scan, hot keys are merged map-side,
bounded broadcasts only, no cross products."""
import __spark_entry__ as E

from conftest import SF01


def executed(spark, name):
    spark.catalog.clearCache()  # plans are checked against the files, not frames other tests cached
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df = E.queries()[name](spark, SF01)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_cleaning_rules_reach_the_lineitem_scan(spark):
    plan = executed(spark, "clean_trips")
    for pushed in ("GreaterThan(l_extendedprice,0.0)", "LessThan(l_extendedprice,100000.0)",
                   "LessThan(l_quantity,50.0)", "GreaterThanOrEqual(l_linenumber,1)"):
        assert pushed in plan, pushed


def test_scans_read_only_needed_columns(spark):
    plan = executed(spark, "rate_by_hour")
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_grouped_aggregates_merge_map_side(spark):
    for name in ("rows_per_month", "ratio_histogram", "class_histogram", "confusion", "class_balance"):
        plan = executed(spark, name)
        assert "partial_count" in plan, name


def test_no_cross_products_anywhere(spark):
    for name in ("metric_record", "leaderboard", "class_histogram", "correlation", "class_weights"):
        plan = executed(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
