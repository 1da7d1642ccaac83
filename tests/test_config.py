from __future__ import annotations

import datetime as dt

import pytest

from zonepulse.config import RunConfig, fixture_config
from zonepulse.plans.oracle_sql import oracle_sql


def test_default_window_is_seven_days_ending_five_days_ago():
    cfg = RunConfig.default_window(today=dt.date(2025, 1, 20))
    assert (cfg.start, cfg.end) == (dt.date(2025, 1, 9), dt.date(2025, 1, 15))
    assert cfg.min_group_size == 100 and cfg.window_label == "2025-01-09_to_2025-01-15"


def test_query_parameters_are_the_same_at_every_scale():
    assert fixture_config().min_group_size == 10
    assert oracle_sql() == oracle_sql()


def test_validation():
    with pytest.raises(ValueError):
        RunConfig(start="2025-01-01", end="2025-01-02", density_pct=1.5)
    with pytest.raises(ValueError):
        RunConfig(start="2025-01-01", end="2025-01-02", min_group_size=0)
    assert RunConfig(start="2025-01-01", end="2025-01-02").start == dt.date(2025, 1, 1)
