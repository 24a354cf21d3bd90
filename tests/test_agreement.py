"""A spread of registered queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry

from .agreement import compare, connect

FOLDER = "/root/testdata/sf0.001"
KEYS = ("scan_columnar parse_day_month_year healthy_control_flag compare_full_outer missing_zero_rates bh_adjust holm_adjust "
        "group_center_median outlier_iqr_cap cohort_flowchart strata_concat subject_auc stratified_splits "
        "logit_by_feature_binary auroc auprc random_undersample feature_corr_matrix").split()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, key):
    df = entry.queries()[key](spark, FOLDER)
    assert compare(connect(FOLDER), df, entry.oracle_sql()[key]) is None


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
