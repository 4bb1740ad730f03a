"""Registered queries against their check SQL. All of them run with TAPELINE_ALL_CHECKS=1; otherwise one per area."""

import os

import pytest

from tapeline.queries import all_checks, all_queries
from tests.compare import connect, differences

SOME = (
    "a01_market_summary k01_ranked_lists c01_objective_features w12_compression w16_percentile_ranks k02_channel_top3 a12_outcome_summary c07_pin_scan "
    "u04_calendar_set_algebra c09_normalized_news c08_enriched_news c10_dedup_merge c26_keyword_analysis c03_overnight_scores w21_intraday_changes "
    "w24_failure_streaks c15_journal_violations a05_manifest a16_day_coverage s02_news_store_save s11_roll_news c14_social_signals r06_collector_health_state"
).split()
NAMES = sorted(all_checks()) if os.environ.get("TAPELINE_ALL_CHECKS") else SOME


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(name, spark, sf_dir, duck):
    assert not differences(all_queries()[name](spark, sf_dir), all_checks()[name], duck)


def test_every_query_with_sql_is_registered():
    assert set(all_checks()) <= set(all_queries())


def test_plans_have_no_cartesian_products(spark, sf_dir):
    for name in ("k02_channel_top3", "j05_visible_messages", "j06_name_mentions", "c03_overnight_scores", "c16_review_context", "j17_missing_slots"):
        plan = all_queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
