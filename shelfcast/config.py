"""Planning parameters, checked on the driver before any Spark job starts."""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class PlanningConfig:
    window_days: int = 28
    lead_time_days: int = 7
    review_days: int = 7
    z_score: float = 1.65

    def __post_init__(self) -> None:
        self._require_days("window_days", minimum=2)
        self._require_days("lead_time_days", minimum=1)
        self._require_days("review_days", minimum=1)
        z = self.z_score
        if isinstance(z, bool) or not isinstance(z, (int, float)):
            raise ValueError("z_score must be a number")
        if not (math.isfinite(z) and z >= 0):
            raise ValueError("z_score must be finite and nonnegative")

    def _require_days(self, field: str, minimum: int) -> None:
        value = getattr(self, field)
        # bool is an int subclass, so compare the exact type.
        if type(value) is not int or value < minimum:
            raise ValueError(f"{field} must be a whole number of days, at least {minimum}")

    def as_dict(self) -> dict:
        return {
            "window_days": self.window_days,
            "lead_time_days": self.lead_time_days,
            "review_days": self.review_days,
            "z_score": float(self.z_score),
        }
