"""Thresholds of the evaluation, as one frozen value with a hash."""

from __future__ import annotations

import dataclasses
import hashlib
import json


@dataclasses.dataclass(frozen=True)
class Config:
    surface_min: float = 1000.0
    surface_max: float = 3000.0
    surface_tolerance: float = 0.05
    penalty_step: int = 5
    penalty_max: int = 15
    min_days: int = 20
    urgent_days: int = 35
    max_price_per_net_sqm: float = 2500.0
    anomalous_price: float = 10_000.0
    efficiency: float = 0.68
    capex_base: float = 525.0
    capex_mezzanine: float = 185.0
    capex_seismic: float = 140.0
    capex_strip_out: float = 55.0
    capex_asbestos: float = 47.5
    charges: float = 0.06
    tariffs: tuple[float, ...] = (261.0, 320.0, 380.0)
    occupancy: float = 0.82
    margin: float = 0.58
    hurdle_a: float = 0.09
    hurdle_b: float = 0.11
    hurdle_c: float = 0.14
    max_range: float = 15.0
    slots: int = 10
    price_drop: float = -0.03
    price_anomaly: float = -0.50
    vote_gain: int = 5
    range_gain: float = 10.0
    low_height: float = 3.0
    fresh_days: float = 7.0
    stale_days: float = 14.0
    stale_streak: int = 3
    excluded_towns: tuple[str, ...] = ("roma", "cagliari", "ancona")

    def digest(self) -> str:
        """Hash over the canonical JSON of all values."""
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True).encode()).hexdigest()[:16]
