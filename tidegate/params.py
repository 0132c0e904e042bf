"""Checks of a run's parameters, made before anything else is touched."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, timedelta

from tidegate import schema


@dataclass(frozen=True)
class Params:
    chunk_days: int = schema.CHUNK_DAYS
    backfill_days: int = schema.BACKFILL_DAYS
    max_reject_rate: float = schema.MAX_REJECT_RATE
    max_lookback_days: int = schema.MAX_LOOKBACK_DAYS
    trust_lag_days: int = schema.TRUST_LAG_DAYS

    def __post_init__(self) -> None:
        for name in ("chunk_days", "backfill_days", "max_lookback_days", "trust_lag_days"):
            value = getattr(self, name)
            if type(value) is not int or value < 1:
                raise ValueError(f"{name} must be a whole number of at least 1, not {value!r}")
        rate = self.max_reject_rate
        # NaN would let every comparison through in one engine and none in the other
        if isinstance(rate, bool) or not isinstance(rate, (int, float)) or not math.isfinite(rate) or not 0 <= rate <= 1:
            raise ValueError(f"max_reject_rate must be a number from 0 to 1, not {rate!r}")


@dataclass(frozen=True)
class Days:
    """The dates that a run's day implies."""

    today: date
    end: date
    floor: date
    trust_line: date

    @classmethod
    def of(cls, today: date, p: Params) -> Days:
        end = today - timedelta(days=schema.PUBLICATION_LAG_DAYS)
        return cls(today, end, end - timedelta(days=p.max_lookback_days - 1), today - timedelta(days=p.trust_lag_days))
