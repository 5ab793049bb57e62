"""Every query against its SQL in DuckDB, and the ordered ones again with all groups split."""

import pytest
from conftest import SF_DIR
from oracle import compare, connect

from weirflow.plans import ORACLES, QUERIES

ORDERED = [
    "running_count_by_key", "retract_changelog", "bitmap_rank_select", "count_window_keyed", "count_window_all", "count_window_sliding",
    "count_window_sliding_all", "session_window_all", "session_window_members", "session_window_keyed", "event_time_window_count",
    "punctuated_watermark", "per_partition_watermark", "allowed_lateness_refire", "late_side_output", "speed_jump_alert",
    "trajectory_list", "running_sum_state", "state_ttl_counter", "dedup_with_dup_count", "dedup_first_seen_ttl",
    "lookup_config_stream", "lookup_connected", "versioned_collapsing",
]


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    assert compare(spark, duck, key, SF_DIR) is None


@pytest.mark.parametrize("key", ORDERED)
def test_query_with_split_groups(spark, duck, split_rows, key):
    split_rows(10)
    assert compare(spark, duck, key, SF_DIR) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
