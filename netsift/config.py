"""Settings with the defaults of a standard deployment."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class GeoSettings:
    # Origin of the derived coordinates, also used for unreadable addresses.
    latitude: float = 33.5731
    longitude: float = -7.5898
    # Largest number of pieces of ranges that is held in memory and sent to every executor.
    broadcast_rows: int = 500_000
    # An address holding more than 1/hot_fraction of the rows is joined through a broadcast of hot addresses.
    hot_fraction: int = 1_000


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 25
    depth: int = 8
    impurity: str = "gini"
    subset: str = "auto"
    seed: int = 42
    min_rows: int = 100
    holdout_percent: int = 20


@dataclass(frozen=True)
class StreamSettings:
    trigger: str = "10 seconds"
    max_offsets_per_trigger: int = 5_000
    starting_offsets: str = "latest"
    # False goes on without a word when offsets have expired before they were read.
    fail_on_data_loss: bool = True
    # Every n-th batch goes to the training lake, which bounds the rows that a retraining reads.
    training_every: int = 5
    # Tables of a micro-batch that are written at the same time.
    writers: int = 8
    # Records whose event time lies further from the ingest time than this are rejected.
    future_minutes: int = 60
    past_days: int = 3_650


@dataclass(frozen=True)
class ReportSettings:
    # Fixed values: (threshold, level), highest first; a value must exceed the threshold.
    risk_levels: tuple = ((35, "Critical"), (25, "High"), (15, "Medium"))
    type_risk: tuple = ((200_000, "Critical"), (100_000, "High"), (50_000, "Medium"), (10_000, "Low"))
    dominant_type: int = 100_000
    attack_share: int = 30
    volatility: int = 5
    benign_ratio: int = 2
    attack_bands: tuple = (15, 30)
    alert_bands: tuple = (500, 1_000)


@dataclass(frozen=True)
class Settings:
    geo: GeoSettings = field(default_factory=GeoSettings)
    forest: ForestSettings = field(default_factory=ForestSettings)
    stream: StreamSettings = field(default_factory=StreamSettings)
    report: ReportSettings = field(default_factory=ReportSettings)


DEFAULTS = Settings()
