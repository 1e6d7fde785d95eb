"""A cross section of the registered queries against their SQL twins on the smallest tables: one at least of every module and plan."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402
from check_queries import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["s1_csv_readings", "s1_csv_mixed_headers", "a12_rule_winner", "d5_label_distribution", "q2_time_continuity_by_type", "q3_missing_slots_by_type", "f6_enhanced_features",
         "f12_supervised_lags_by_type", "f15_around_middle_flag_by_type", "p3_sequence_split", "m6_tuning_bundle",
         "a1_isolation_forest_by_type", "a2_forest_scored_rows", "a5_density_euclidean", "a6_ensembles", "a8_best_threshold", "a13_profile_flags", "c1_interpolate_edges_by_type",
         "c2_legacy_profile", "c3_compare_artefacts", "t1_seasonal_naive_by_type", "t3_additive_forecast", "t4_boosted_by_level_jobs", "t5_split_ledger", "t6_window_regression_short",
         "e11_segment_table", "e12_enhanced_splits", "d7_densities", "d8_boxes_by_hour", "x1_detect_clean_forecast"]


@pytest.mark.skipif(not Path(SF).exists(), reason="shared tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, name):
    got = entry_point.queries()[name](spark, SF).toPandas()
    assert compare(got, connect(SF).execute(entry_point.oracle_sql()[name]).df()) is None


def test_names_and_entry(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    if Path(SF).exists():
        assert entry_point.entry(spark).count() == 1
