"""Run-time parameters (the reference's model variables and script constants)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # Anomaly thresholds: flag when the day's peak exceeds the day's mean by this factor.
    temp_ratio: str = "1.15"
    vib_ratio: str = "1.50"
    # At-risk rule: OEE over the last window fell by more than this versus the prior window.
    oee_drop: str = "0.03"
    # Trend windows: "last 7 days" is [anchor-7, anchor], prior is [anchor-14, anchor-7).
    window_days: int = 7
    # Incremental models recompute this many trailing days (plus the as-of day).
    lookback_days: int = 3
    # Reference date standing in for CURRENT_DATE, so runs are repeatable.
    as_of: dt.date = dt.date(2024, 1, 31)
    # Similar-failure retrieval depth.
    top_k: int = 3
    # Minimum gap between two emitted downtime events of one machine, in seconds (strict >).
    cooldown_s: int = 7200
    # Urgency tier upper bounds in hours: CRITICAL <= 8 < HIGH <= 24 < MEDIUM <= 72 < LOW.
    critical_hours: int = 8
    high_hours: int = 24
    medium_hours: int = 72
    # OEE bands used by the overview report.
    world_class_oee: str = "0.85"
    at_risk_oee: str = "0.60"
    # Fallback OEE for failure events without an OEE row that day.
    default_event_oee: str = "0.70"
    # Estimated hours are kept in [min_hours, max_hours].
    min_hours: str = "1"
    max_hours: str = "720"
    # Fallback estimate when no similar failure exists.
    fallback_hours: str = "24.0"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
