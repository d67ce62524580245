"""Every registered query against its SQL counterpart; plan rules for all of them."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import compare
from tablewright.registry import REGISTRY

# plans that hold a Python stage by design: small solves, neighbour search, trees, tables of pages
REGISTERED = set(REGISTRY)
RANKED = {"seasonal_growth", "growth_ranking", "trend_ranking", "arima_ranking", "forest_ranking", "outlook_by_growth", "cross_validate", "rank_summary",
          "outlook_lines_by_growth", "arima_lines_ranking", "forest_season_ranking"}
PYTHON_STAGE = {"knn_impute_saturated", "ols_summary_tests", "energy_normal_equations", "economy_normal_equations",
                "ols_group_normal_equations", "tree_steps", "forest_impute_steps", "future_score_rows", "arima_zero_series",
                "arima_ar1", "seasonal_continuation", "recursive_forest_calendar", "calendar_features", "life_projection",
                "predict_output", "forest_impute", "catalogue_cleanup", "recursive_forest", "forest_holdout",
                "forest_ranking", "boosted_early_stop", "outlook_by_growth", "outlook_sector_growth", "outlook_stability",
                "first_predictions", "ols_two_features", "ols_no_intercept", "ols_coefficients", "ols_summary", "ols_summary_by_group", "ols_summary_per_kind",
                "cross_validate", "tree_models", "future_scores", "knn_impute", "energy_regression", "energy_scores",
                "economy_regression", "arima_order_search", "arima_ranking", "seasonal_arima", "seasonal_holdout",
                # likelihoods, forests and networks, tables by a tag scan
                "arima_ma1", "arima_lines_ranking", "seasonal_holdout_exact", "outlook_lines_by_growth", "outlook_lines_sector_growth",
                "outlook_lines_stability", "forest_season_holdout", "forest_season_ranking", "joint_forest", "joint_forest_pure",
                "joint_forest_stump", "joint_forest_calendar", "network_early_stop", "network_without_layers", "ols_near_collinear",
                "catalogue_cells", "html_table_rows", "html_rejects", "storm_merge"}


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(REGISTERED & set(entry.oracle_sql())))
def test_matches_sql(spark, sf, con, name):
    verdict, _ = compare(spark, con, name, sf)
    assert verdict == "ok"


@pytest.mark.parametrize("name", sorted(REGISTERED - set(entry.oracle_sql())))
def test_runs(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    assert df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_plan(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a window in one partition is allowed over a ranked top-n, whose rows are limited before, and over a panel of one series
    if name not in RANKED:
        assert not re.search(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    if name not in PYTHON_STAGE:
        assert not re.search(r"(BatchEvalPython|ArrowEvalPython|InPandas)", plan)


def test_entry_has_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["series", "recent_avg", "mean_growth", "mean_yoy", "mean_share", "growth_rate", "rank"]
    assert 0 < df.count() <= 15
