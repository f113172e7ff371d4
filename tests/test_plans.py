"""Physical plans: JVM-side operators only, pruned scans, bounded shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from eventide.operators import clean, reports
from eventide.operators import windows as win
from eventide.plans import catalog
from eventide.sources import testdata as data

SF = "/root/testdata/sf0.001"
STREAMS_AND_WRITERS = {
    "stream_window_aggregate",
    "stream_closed_windows",
    "stream_late_events",
    "stream_decode_split",
    "stream_drain_once",
    "cycles_in_turn",
    "cycle_summary",
    "window_rollup",
    "windows_roundtrip",
    "windows_union_schemas",
}
LAZY = sorted(set(catalog.queries()) - STREAMS_AND_WRITERS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def schemas_read(text):
    return [re.findall(r"(\w+):", s) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in text, node


def test_each_measure_reads_its_own_columns(spark):
    assigned = win.assign_windows(data.user_events(spark, SF), "1 hour")
    assert schemas_read(plan(win.window_totals(assigned))) == [["ts"]]
    assert schemas_read(plan(win.event_counts(assigned))) == [["ts", "event_type"]]
    assert schemas_read(plan(win.totals(assigned))) == [["ts", "user_id", "value"]]


def test_distinct_users_are_spread_before_the_window_is_folded(spark):
    assigned = win.assign_windows(data.user_events(spark, SF), "1 hour")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(win.totals(assigned)))
    assert len(exchanges) == 2
    assert any("user_id" in e for e in exchanges)


def test_rank_limits_apply_before_the_shuffle(spark):
    assigned = win.assign_windows(data.user_events(spark, SF), "1 hour")
    top = plan(win.top_pages(win.page_counts(assigned)))
    assert re.search(r"WindowGroupLimit .* 5, Partial", top)
    dedup = plan(clean.dedup(clean.load_columns(data.windows_dirty(spark, SF))))
    assert re.search(r"WindowGroupLimit .* 1, Partial", dedup)


def test_parts_join_without_another_shuffle(spark):
    """Six shuffles: two levels for users, two for types, two for pages, none for joins."""
    text = plan(win.window_aggregate(data.user_events(spark, SF), "1 hour"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 6


def test_audit_is_one_pass(spark, tmp_path):
    data.windows_dirty(spark, SF).write.parquet(str(tmp_path / "w"))
    text = plan(clean.cleaning_audit(spark.read.parquet(str(tmp_path / "w"))))
    assert text.count("FileScan") == 1
    assert "SortAggregate" not in text


def test_small_reports_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "w")
    data.windows_at_rest(spark, SF).write.parquet(path)
    stored = spark.read.parquet(path)
    assert schemas_read(plan(reports.events_timeseries(stored))) == [
        ["window_start", "total_events"]
    ]
    assert schemas_read(plan(reports.event_distribution_json(stored))) == [["event_counts"]]
    assert plan(reports.event_distribution_json(stored)).count("from_json") == 1
    assert plan(reports.page_totals(stored)).count("from_json") == 1
    text = plan(reports.hourly_totals(stored))
    assert "GreaterThan(total_events,0)" in text
    assert "TakeOrderedAndProject" in plan(reports.top_pages(stored))
    assert "TakeOrderedAndProject" in plan(reports.peak_window(stored))


def test_sql_and_frame_forms_have_the_same_plan(spark, tmp_path):
    path = str(tmp_path / "w")
    data.windows_at_rest(spark, SF).write.parquet(path)
    stored = spark.read.parquet(path)
    a = reports.hourly_totals(stored)
    b = reports.hourly_totals_sql(spark, stored)
    assert a.sameSemantics(b)


def test_verdict_filter_does_not_copy_the_parse(spark):
    from eventide.operators.validate import validate_json_events

    good = validate_json_events(data.events_json(spark, SF)).filter(F.col("is_valid"))
    # One parse for objects, one for the rest.
    assert plan(good).count("from_json") == 2


def test_a_batch_is_parsed_once_as_objects_and_once_otherwise(spark):
    from eventide.operators.validate import validate_batch

    text = plan(validate_batch(data.event_batches(spark, SF)))
    assert text.count("from_json") <= 2
