"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import re

import pytest

from rillstone.plans import CATALOG, load_all

load_all()

QUERIES = {key: query.run for key, query in CATALOG.items()}
# User functions in Python, there to be one.
PYTHON = {"partition_setup_map", "udtf_split_user", "reduce_function_surface", "aggregate_function_surface",
          "udaf_surface", "table_aggregate_surface"}
EAGER = {k for k in QUERIES if k.endswith("_stream")} | {
    "retract_changelog", "job_sensor_table", "job_mail_quarantine", "topn_list_state_timer", "stream_word_count", "assign_watermark", "late_side_output", "job_mail_ingest",
    "rising_temp_alert_repeated", "process_context", "checkpointed_run", "trigger_interval", "end_of_stream_flush",
    "subtask_counter_rescaled", "job_sensor_alerts_rows"}
LAZY = sorted(set(QUERIES) - EAGER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", LAZY)
def test_no_unwanted_operators(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # only the bounded list of keys to cut is sent to all executors
    for line in text.splitlines():
        assert "BroadcastExchange" not in line or "__heavy" in text, line
    if key not in PYTHON:
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|InPandas|InArrow|PythonUDTF", text)
    # Ordered work over raw rows is split by block; windows without a key see block summaries only.
    for line in text.splitlines():
        if re.search(r"Window \[", line) and "windowspecdefinition" in line:
            partitioned = re.search(r"\], \[[a-zA-Z_]", line)
            assert partitioned or "__block" in line, line


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["select_where_eq"](spark, sf))
    assert re.search(r"ReadSchema: struct<user_id:bigint,value:double>", text)
    text = plan(QUERIES["hot_items_topn"](spark, sf))
    assert "EqualTo(event_type,view)" in text or "event_type" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text


def test_top_n_limits_before_the_shuffle(spark, sf):
    for key in ("hot_items_topn", "hot_items_sql", "udtaf_top2"):
        text = plan(QUERIES[key](spark, sf))
        before = text.index("Exchange", text.index("WindowGroupLimit"))
        assert text.index("WindowGroupLimit") < before
        assert ", Partial" in text


def test_aggregates_combine_before_the_shuffle(spark, sf):
    for key in ("word_count", "group_avg", "tumble_event_agg", "hop_count_panes", "tumble_event_min_by"):
        assert "partial_" in plan(QUERIES[key](spark, sf))
