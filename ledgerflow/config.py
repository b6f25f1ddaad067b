"""Business parameters, as keyword defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    calendar_start: dt.date = dt.date(2015, 1, 1)
    calendar_end: dt.date = dt.date(2030, 12, 31)
    incremental_lookback_hours: int = 3
    fx_forward_fill_days: int = 7
    fx_max_staleness_days: int = 4
    structuring_floor_eur: float = 9000
    structuring_ceiling_eur: float = 10000
    structuring_min_count: int = 3
    structuring_window_minutes: int = 24 * 60
    velocity_window_minutes: int = 60
    velocity_min_count: int = 10
    outlier_history: int = 50
    outlier_min_history: int = 20
    outlier_min_zscore: float = 5.0
    outlier_min_amount_eur: float = 1000
    large_txn_amount: float = 10000
