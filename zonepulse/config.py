"""Run configuration: one dataclass whose every field is read by some step."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Fixed values that define the reference behaviour (defaults of the weekly run).
DEFAULT_MIN_GROUP_SIZE = 100          # protected query: groups below this are suppressed
DEFAULT_DENSITY_PCT = 0.75            # underserved: density at or above this percentile
DEFAULT_RATIO_PCT = 0.5               # underserved: coverage ratio below this percentile
DEFAULT_WINDOW_DAYS = 7               # run window length, inclusive
DEFAULT_WINDOW_LAG_DAYS = 5           # window ends this many days before "today"


def _as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one run window.

    start / end            inclusive event_date bounds of the window
    min_group_size         k of the protected zone x day aggregate (HAVING count >= k)
    min_cell_size          smallest grid cell that is published (1 = publish all)
    density_pct, ratio_pct percentiles of the underserved flag
    top_n                  zones per city in the hotspot report
    approx_distinct        use HyperLogLog++ distinct counts instead of exact ones
    approx_quantiles       use percentile_approx (bounded sketch) instead of exact
                           percentile_disc for the flag thresholds
    """

    start: dt.date
    end: dt.date
    min_group_size: int = DEFAULT_MIN_GROUP_SIZE
    min_cell_size: int = 1
    density_pct: float = DEFAULT_DENSITY_PCT
    ratio_pct: float = DEFAULT_RATIO_PCT
    top_n: int = 3
    approx_distinct: bool = False
    approx_quantiles: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.min_group_size < 1 or self.min_cell_size < 1:
            raise ValueError("group sizes must be >= 1")
        for p in (self.density_pct, self.ratio_pct):
            if not 0.0 <= p <= 1.0:
                raise ValueError(f"percentile {p} outside [0, 1]")

    @property
    def window_label(self) -> str:
        return f"{self.start.isoformat()}_to_{self.end.isoformat()}"

    def with_(self, **changes) -> "RunConfig":
        return replace(self, **changes)

    @classmethod
    def default_window(cls, today: dt.date | None = None, **kw) -> "RunConfig":
        """Weekly default: end = today - 5 days, start = end - 6 days."""
        today = today or dt.date.today()
        end = today - dt.timedelta(days=DEFAULT_WINDOW_LAG_DAYS)
        start = end - dt.timedelta(days=DEFAULT_WINDOW_DAYS - 1)
        return cls(start=start, end=end, **kw)


# --- parameters for the driver's test tables -------------------------------------
# Fixed values, the same at every scale: the events table spans 2024-01-01 .. 2024-01-30 and
# the run window is all of it (the adapter fails on an event outside, so none is lost in
# silence); k is small enough to leave zone-days at the smallest scale.
FIXTURE_WINDOW = (dt.date(2024, 1, 1), dt.date(2024, 1, 30))
FIXTURE_SPINE = (dt.date(2023, 12, 28), dt.date(2024, 2, 3))
FIXTURE_MIN_GROUP_SIZE = 10


def fixture_config() -> RunConfig:
    """RunConfig of the registered queries."""
    return RunConfig(start=FIXTURE_WINDOW[0], end=FIXTURE_WINDOW[1], min_group_size=FIXTURE_MIN_GROUP_SIZE)
