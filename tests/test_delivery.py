"""A delivery replaces the one before as a whole; one scan of the raw files per staging."""

from __future__ import annotations

import os
import time

import pytest

from conftest import D
from test_run_window import _day, _paths, _staged
from zonepulse.config import RunConfig
from zonepulse.operators.ingest import clean_orders, rejected_orders
from zonepulse.plans.run import redelivered_days, stage_orders, staging
from zonepulse.sources import manifest, readers

D6, D7 = D(2025, 1, 6), D(2025, 1, 7)
BOTH = RunConfig(start=D6, end=D7)


def _both_days(spark, root):
    paths = _paths(root)
    _day(paths.orders_src, D6, [("a", D6, 8, 5.0), ("L", D7, 9, 2.0)])
    _day(paths.orders_src, D7, [("b", D7, 9, 1.0)])
    assert stage_orders(spark, BOTH, paths).late_rows == 1
    assert _staged(spark, paths, BOTH) == [("L", D7, 2.0), ("a", D6, 5.0), ("b", D7, 1.0)]
    return paths


def test_a_late_row_that_is_gone_goes(spark, scratch):
    paths = _both_days(spark, scratch)
    _day(paths.orders_src, D6, [("a", D6, 8, 6.0)])
    assert stage_orders(spark, BOTH, paths, restage=[D6]).late_rows == 0
    assert _staged(spark, paths, BOTH) == [("a", D6, 6.0), ("b", D7, 1.0)]


def test_a_delivery_without_valid_rows_leaves_none(spark, scratch):
    paths = _both_days(spark, scratch)
    _day(paths.orders_src, D6, [("a", D6, 8, -5.0), ("L", D7, 9, "x")])
    _day(paths.orders_src, D7, [])
    result = stage_orders(spark, BOTH, paths, restage=[D6, D7])
    assert result.staged_days == [D6, D7] and result.rejected["rows"] == 2
    assert _staged(spark, paths, BOTH) == []
    assert stage_orders(spark, BOTH, paths).staged_days == []  # an empty day is staged all the same


def test_loading_again_changes_nothing(spark, scratch):
    paths = _both_days(spark, scratch)
    before = _staged(spark, paths, BOTH)
    for days in ([D6], [D7], [D6, D7]):
        stage_orders(spark, BOTH, paths, restage=days)
        assert _staged(spark, paths, BOTH) == before
    folders = [e.folder(paths.interim) for e in manifest.current(spark, paths.interim)]
    assert len(folders) == 3 and all(os.path.isdir(f) for f in folders)


def test_rows_of_a_failed_staging_are_not_read(spark, scratch, monkeypatch):
    paths = _both_days(spark, scratch)
    before = _staged(spark, paths, BOTH)
    _day(paths.orders_src, D6, [("z", D6, 8, 9.0)])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(manifest, "publish", fail)
        with pytest.raises(OSError, match="lost"):
            stage_orders(spark, BOTH, paths, restage=[D6])
    assert _staged(spark, paths, BOTH) == before
    stage_orders(spark, BOTH, paths, restage=[D6])
    assert _staged(spark, paths, BOTH) == [("b", D7, 1.0), ("z", D6, 9.0)]


def test_a_changed_file_is_found(spark, scratch):
    paths = _both_days(spark, scratch)
    assert redelivered_days(spark, BOTH, paths) == []
    time.sleep(0.05)
    _day(paths.orders_src, D7, [("b", D7, 9, 1.0), ("c", D7, 9, 3.0)])
    assert redelivered_days(spark, BOTH, paths) == [D7]
    stage_orders(spark, BOTH, paths, restage=redelivered_days(spark, BOTH, paths))
    assert redelivered_days(spark, BOTH, paths) == [] and ("c", D7, 3.0) in _staged(spark, paths, BOTH)


def test_one_scan_and_the_same_counters(spark, scratch):
    paths = _both_days(spark, scratch)
    raw = readers.read_delivered_days(spark, paths.orders_src, [D6, D7])
    plan = staging(raw, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    again = stage_orders(spark, BOTH, paths, restage=[D6, D7])
    assert again.rejected == rejected_orders(raw).first().asDict()


def test_only_named_folders_are_read(spark, scratch):
    paths = _both_days(spark, scratch)
    stage_orders(spark, BOTH, paths, restage=[D7])
    files = readers.read_interim(spark, paths.interim, D6, D6).inputFiles()
    assert files and all("event_date=2025-01-06" in f for f in files)
    plan = readers.read_interim(spark, paths.interim, D6, D6)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan  # no late row, nothing to reconcile


def test_a_root_without_manifest_is_refused(spark, scratch):
    paths = _paths(scratch)
    _day(paths.orders_src, D6, [("a", D6, 8, 5.0)])
    raw = readers.read_delivered_days(spark, paths.orders_src, [D6])
    clean_orders(raw).write.partitionBy("event_date").parquet(paths.interim)
    with pytest.raises(ValueError, match="without a manifest"):
        stage_orders(spark, BOTH, paths, restage=[D6])
