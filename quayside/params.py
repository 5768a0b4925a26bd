"""Plan-time parameters: analysis settings, yard layout and tariff.

These are small, bounded objects (one terminal's configuration) that are bound
into plans as literals; nothing here grows with the visit data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

OPEN_ENDED_DAY = 9999  # upper day of a tier without an end
DEFAULT_FREE_DAYS = 3  # movement types the tariff does not name
DEFAULT_THROUGHPUT_RATE = 85.0


@dataclass(frozen=True)
class AnalysisParams:
    overstay_threshold_days: float = 7
    utilization_warning_pct: float = 80
    forecast_horizon_days: int = 14
    num_segments: int | None = None  # none: chosen by the metrics
    random_seed: int = 42
    analysis_date_start: str | None = None
    analysis_date_end: str | None = None
    container_types_focus: tuple[str, ...] | None = None
    target_blocks: tuple[str, ...] | None = None
    teu_for_45ft: float = 2

    @classmethod
    def from_json(cls, text: str) -> "AnalysisParams":
        known = {f.name for f in fields(cls)}
        given = {k: v for k, v in json.loads(text or "{}").items() if k in known}
        for name in ("container_types_focus", "target_blocks"):
            value = given.get(name)
            if value == "all":
                given[name] = None
            elif value is not None:
                given[name] = tuple(value)
        return cls(**given)


@dataclass(frozen=True)
class Block:
    block_id: str
    teu_capacity: int | None = None
    reefer_plug_count: int | None = None
    has_reefer_plugs: bool = False
    rows: int | None = None
    bays: int | None = None
    max_tier: int | None = None
    accepts_types: tuple[str, ...] = ()


@dataclass(frozen=True)
class YardConfig:
    blocks: tuple[Block, ...] = ()
    terminal_name: str | None = None
    gate_count_in: int | None = None
    gate_count_out: int | None = None

    @property
    def total_capacity(self) -> int:
        return sum(b.teu_capacity or 0 for b in self.blocks)


@dataclass(frozen=True)
class Tier:
    from_day: int
    to_day: int | None
    rate_per_teu_per_day: float

    @property
    def width(self) -> int:
        """Days the tier spans; an absent (or zero) end means open-ended."""
        return max(0, (self.to_day or OPEN_ENDED_DAY) - self.from_day + 1)


@dataclass(frozen=True)
class TariffConfig:
    free_days: dict[str, int] = field(default_factory=dict)
    storage_tiers: tuple[Tier, ...] = ()
    reefer_surcharge_per_day: float = 0.0
    hazardous_surcharge_per_day: float = 0.0
    avg_throughput_revenue_per_teu: float = DEFAULT_THROUGHPUT_RATE
    currency: str = "USD"


# --- fixed values: the sample terminal used by the registered queries --------
SAMPLE_YARD = YardConfig(
    terminal_name="Sample terminal",
    blocks=(
        Block("A01", 1600, rows=8, bays=40, max_tier=5, accepts_types=("dry", "empty")),
        Block("A02", 1600, rows=8, bays=40, max_tier=5, accepts_types=("dry", "empty")),
        Block("B01", 1400, rows=8, bays=35, max_tier=5, accepts_types=("dry", "special")),
        Block("R01", 720, 180, True, rows=6, bays=25, max_tier=4, accepts_types=("reefer",)),
        Block("R02", 480, 100, True, rows=5, bays=20, max_tier=4, accepts_types=("reefer",)),
        Block("H01", 270, rows=4, bays=15, max_tier=3, accepts_types=("hazardous",)),
        Block("E01", 2160, rows=8, bays=45, max_tier=6, accepts_types=("empty",)),
    ),
    gate_count_in=6,
    gate_count_out=4,
)
SAMPLE_TARIFF = TariffConfig(
    currency="USD",
    free_days={"import": 3, "export": 5, "transhipment": 7},
    storage_tiers=(
        Tier(1, 4, 15.0), Tier(5, 10, 30.0), Tier(11, 21, 55.0), Tier(22, None, 85.0),
    ),
    reefer_surcharge_per_day=25.0,
    hazardous_surcharge_per_day=18.0,
    avg_throughput_revenue_per_teu=85.0,
)
# -----------------------------------------------------------------------------
