"""Spark results equal the independent DuckDB SQL (a representative subset;
tests/oracle_compare.py runs every key)."""

import pytest

from conftest import SF001
from oracle_compare import compare, duck

SUBSET = ["clean_dedup", "time_split_rows", "topk_grouped", "topk_global_k", "topk_global_quantile",
          "missing_report", "describe_features", "impute_monthwise", "scale_robust", "auc",
          "average_precision", "roc_points", "calibration_table", "downsample", "smote_knn",
          "pd_1d", "bootstrap_threshold_ci", "permutation_importance"]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", SUBSET)
def test_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, name, SF001, con)
    assert ok, msg
