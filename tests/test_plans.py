"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
WRITERS = {"warehouse_upsert", "warehouse_append", "csv_round_trip", "ndjson_round_trip", "incremental_upsert"}
WRITERS |= {"latest_landed_file", "files_of_a_window", "last_landed_row", "json_documents", "warehouse_csv_load"}
WRITERS |= {"warehouse_append_partial_columns", "warehouse_steps", "incremental_upsert_out_of_order", "weekly_update_two_weeks"}
WRITERS |= {"incremental_upsert_bad_lines", "incremental_rejects"}
MODELS = {"lr_predict", "lr_predict_films", "lr_predict_numbers", "rf_predict", "forecast_predict", "line_over_budget", "model_checks", "parameters"}
MODELS |= {"rf_out_of_fold", "forecast_out_of_fold", "conformal_interval"}
#: those of the corpus operators have tests of their own
CORPUS = {name for name in QUERIES if re.match(r"op\d+_|pipeline$", name)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS - MODELS - CORPUS))
def test_plan(name, spark):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"Window \[.*windowspecdefinition\(([^,]*)", text):
        assert "ASC" not in window and "DESC" not in window, "window without partition"


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(QUERIES["genre_revenue_weekly"](spark, FOLDER))
    for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", text):
        assert len(columns.split(",")) <= 4
    assert "PushedFilters: [IsNotNull(l_partkey)]" in text


def test_resolution_reads_the_chart_once(spark):
    text = plan(QUERIES["weekly_performance"](spark, FOLDER))
    assert text.count("lineitem.parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_small_batch_leaves_the_target_in_place(spark):
    text = plan(QUERIES["upsert_orders"](spark, FOLDER))
    assert "SortMergeJoin" not in text


def test_grid_reads_its_series_once(spark):
    """Weeks, genres and values all come from the written series."""
    text = plan(QUERIES["genre_week_grid"](spark, FOLDER))
    assert "lineitem.parquet" not in text and text.count("genre-series") >= 3


def test_top_films_reads_the_films_once(spark):
    text = plan(QUERIES["top5_films"](spark, FOLDER))
    assert text.count("lineitem.parquet") == 1 and "TakeOrderedAndProject" in text
