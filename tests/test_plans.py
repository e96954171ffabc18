"""Physical-plan properties the scale design relies on."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quarry.operators.indexing import dense_index


def _plan(df):
    df.collect()   # the plan of this frame is final only once this frame has run
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    return plan.partition("== Initial Plan ==")[0]


def test_filter_and_columns_reach_the_scan(spark):
    plan = _plan(E.queries()["purchase_stats"](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans and all("EqualTo(event_type,purchase)" in ln for ln in scans)
    for ln in scans:
        schema = re.search(r"ReadSchema: struct<([^>]*)>", ln).group(1)
        assert "ts:" not in schema and "event_id" not in schema


def test_top_n_per_group_limits_before_the_shuffle(spark):
    plan = _plan(E.queries()["cluster_nearest_items"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dense_index_has_no_unpartitioned_window_over_keys(spark):
    keys = spark.range(0, 10000).select((F.col("id") % 3001).alias("k"))
    plan = _plan(dense_index(keys, "k", "i", num_partitions=4))
    # rows and offsets come from the written ranges; the only window runs over the per-partition counts
    assert "ranged-" in plan and len(re.findall(r"\bWindow \[", plan)) == 1
    assert re.search(r"Window \[[^\n]*_n#", plan)


def test_one_row_sides_are_the_only_literal_broadcasts(spark):
    plan = _plan(E.queries()["rating_summary"](spark, SF_SMALL))
    for ln in plan.splitlines():
        if "BroadcastNestedLoopJoin" in ln:
            assert "LeftOuter" in ln   # attach_row: one-row right side
