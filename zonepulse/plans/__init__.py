"""Composed runs: named queries, the windowed run, sinks, SQL oracle."""
